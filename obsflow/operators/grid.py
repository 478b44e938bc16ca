"""Two-dimensional grid aggregate and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_cell(col: Column, size: float = 1.0) -> Column:
    """Lower edge of the cell, rounding toward minus infinity."""
    return F.floor(col / size).cast("double") * size


def grid_aggregate(
    df: DataFrame,
    x: str,
    y: str,
    weight: str,
    size: float = 1.0,
    names: tuple[str, str, str, str] = ("ra_bin", "dec_bin", "nb_obs", "total_exptime"),
) -> DataFrame:
    """A2: row count and weight total per grid cell; rows without a place are left out.

    NaN has no place either: its floor would put it into cell 0.
    """
    x_bin, y_bin, count, total = names
    placed = df.filter(
        F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    )
    return (
        placed.groupBy(
            grid_cell(F.col(x), size).alias(x_bin), grid_cell(F.col(y), size).alias(y_bin)
        )
        .agg(
            F.count(F.lit(1)).alias(count),
            F.coalesce(F.sum(weight), F.lit(0.0)).alias(total),
        )
    )


def empty_cells(
    cells: DataFrame,
    x_bin: str,
    y_bin: str,
    x_range: tuple[float, float],
    y_range: tuple[float, float],
    size: float = 1.0,
) -> DataFrame:
    """Cells of the grid ``[low, high)`` x ``[low, high)`` that hold no row.

    The grid is numbered cell by cell, so its rows spread over all tasks; its
    size follows from the ranges, not from the data.
    """

    # Edges are compared as whole numbers of cells: the same edge may differ in its last bit.
    def first(low: float) -> int:
        return round(low / size)

    wide, high = (round((r[1] - r[0]) / size) for r in (x_range, y_range))
    number = F.col("id")
    grid = cells.sparkSession.range(wide * high).select(
        (F.floor(number / high) + first(x_range[0])).alias("_x"), (number % high + first(y_range[0])).alias("_y")
    )
    held = cells.select(F.round(F.col(x_bin) / size).cast("bigint").alias("_x"), F.round(F.col(y_bin) / size).cast("bigint").alias("_y"))
    return grid.join(held, ["_x", "_y"], "left_anti").select(
        (F.col("_x").cast("double") * size).alias(x_bin), (F.col("_y").cast("double") * size).alias(y_bin)
    )


def busiest_cells(cells: DataFrame, n: int, count: str = "nb_obs") -> DataFrame:
    """The ``n`` cells with the most rows, ties by cell."""
    rest = [F.col(c).asc() for c in cells.columns if c.endswith("_bin")]
    return cells.orderBy(F.col(count).desc(), *rest).limit(n)
