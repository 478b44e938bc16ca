"""Pages of result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.functions.predicates import in_range
from obsflow.schemas import DEFAULT_PAGE, LARGEST_PAGE


@dataclass(frozen=True)
class Page:
    """O1: limit and offset as asked for, brought into their bounds."""

    limit: int
    offset: int

    def __post_init__(self):
        if not 1 <= self.limit <= LARGEST_PAGE or self.offset < 0:
            raise ValueError(f"a page has 1 to {LARGEST_PAGE} rows from an offset of at least 0")

    @classmethod
    def of(cls, limit: object = None, offset: object = None) -> Page:
        def whole(value: object, default: int) -> int:
            try:
                return int(value)  # type: ignore[call-overload]
            except (TypeError, ValueError):
                return default

        return cls(
            limit=min(max(1, whole(limit, DEFAULT_PAGE)), LARGEST_PAGE),
            offset=max(0, whole(offset, 0)),
        )


@dataclass(frozen=True)
class Key:
    """A column of a page order."""

    name: str
    descending: bool = False
    nulls_last: bool = False

    def order(self) -> Column:
        column = F.col(self.name)
        if self.descending:
            return column.desc_nulls_last() if self.nulls_last else column.desc_nulls_first()
        return column.asc_nulls_last() if self.nulls_last else column.asc_nulls_first()

    def beyond(self, value: object) -> Column:
        """Whether a row stands behind the value in this column."""
        column = F.col(self.name)
        if value is None:
            return F.lit(False) if self.nulls_last else column.isNotNull()
        further = F.coalesce(column < F.lit(value) if self.descending else column > F.lit(value), F.lit(False))
        return further | column.isNull() if self.nulls_last else further


def page_of(df: DataFrame, order: Sequence[Column], page: Page) -> DataFrame:
    """Rows of one page; give a total order for stable pages.

    Spark keeps ``offset + limit`` rows in one task. For pages far into a large
    table use ``page_after``.
    """
    return df.orderBy(*order).offset(page.offset).limit(page.limit)


def page_after(df: DataFrame, keys: Sequence[Key], last: Mapping[str, object] | None, limit: int) -> DataFrame:
    """The page behind the last row of the one before, or the first page.

    Every page costs a filtered scan and ``limit`` rows per task, however far
    into the table it lies. ``keys`` have to be a total order.
    """
    if last is not None:
        behind = F.lit(False)
        for key in reversed(keys):
            same = F.col(key.name).eqNullSafe(F.lit(last[key.name]))
            behind = key.beyond(last[key.name]) | (same & behind)
        df = df.filter(behind)
    return df.orderBy(*(key.order() for key in keys)).limit(Page(limit, 0).limit)


#: The page order of each gold table, with its grain as tie-break.
PAGE_KEYS = {
    "contaminated_obs": (Key("t_start", nulls_last=True), Key("obs_id")),
    "narrow_band_targets": (Key("nb_obs", descending=True), Key("target_name"), Key("filter"), Key("emission_line")),
    "instrument_calibration": (Key("instrument", nulls_last=True), Key("year_month", nulls_last=True)),
    "sky_coverage": (Key("nb_obs", descending=True), Key("ra_bin"), Key("dec_bin")),
}


def _ordered(name: str) -> list[Column]:
    return [key.order() for key in PAGE_KEYS[name]]


def _filtered(gold: DataFrame, name: str, first: str | None, last: str | None) -> DataFrame:
    """The rows of a gold table within a time range, where it has a time column."""
    if name == "contaminated_obs":
        return gold.filter(in_range(F.col("t_start"), first, last, "timestamp"))
    if name == "instrument_calibration":
        return gold.filter(in_range(F.col("year_month"), first, last, "date"))
    return gold


def gold_page(
    gold: DataFrame, name: str, page: Page, first: str | None = None, last: str | None = None
) -> DataFrame:
    """One page of a gold table.

    contaminated_obs by start; instrument_calibration by instrument and month,
    a missing instrument last; the other two by observations, most first.
    """
    return page_of(_filtered(gold, name, first, last), _ordered(name), page)


def gold_page_after(
    gold: DataFrame, name: str, limit: int, row: Mapping[str, object] | None,
    first: str | None = None, last: str | None = None,
) -> DataFrame:
    """The page of ``gold_page`` that follows the given row, at the same cost wherever it lies."""
    return page_after(_filtered(gold, name, first, last), PAGE_KEYS[name], row, limit)


def _json_value(name: str, kind: str) -> Column:
    col = F.col(name)
    if kind == "decimal":
        return col.cast("double").alias(name)
    if kind in ("timestamp", "timestamp_ntz"):
        # The fraction appears only where there is one, then with six digits.
        whole = F.date_trunc("second", col) == col
        seconds = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(whole, seconds).otherwise(micros).alias(name)
    return col


def json_rows(rows: DataFrame) -> DataFrame:
    """K6: one JSON text per row; times in ISO form, decimals as numbers, nulls kept."""
    columns = [_json_value(f.name, f.dataType.typeName()) for f in rows.schema.fields]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.select(text.alias("row"))


def json_page(rows: DataFrame, order: Sequence[Column], page: Page) -> DataFrame:
    """K6: one row with one JSON text ``{count, limit, offset, rows}``.

    Only a page is gathered, which O1 keeps to 10,000 rows.
    """
    texts = json_rows(page_of(rows, order, page)).withColumn(
        "position", F.monotonically_increasing_id()
    )
    gathered = F.array_sort(F.collect_list(F.struct("position", "row")))
    body = F.array_join(F.transform(gathered, lambda r: r["row"]), ",")
    return texts.agg(F.count("row").alias("n"), body.alias("body")).select(
        F.format_string(
            '{"count":%d,"limit":%d,"offset":%d,"rows":[%s]}',
            F.col("n"),
            F.lit(page.limit),
            F.lit(page.offset),
            F.col("body"),
        ).alias("page")
    )


def gold_json_page(
    gold: DataFrame, name: str, page: Page, first: str | None = None, last: str | None = None
) -> DataFrame:
    """K6 over O2-O5: one page of a gold table as one JSON text."""
    return json_page(_filtered(gold, name, first, last), _ordered(name), page)
