"""Connected components, and the pairs within the cells of a candidate index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import int64, staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    ``edges`` has the columns ``a`` and ``b`` in any order and any number of
    times. Rounds of large-star and small-star joins (Kiveris et al., 2014)
    shorten all paths to the smallest node; each round is a table in the shared
    folder. An edge list without rows gives no rows.
    """
    links = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    while not _is_star(links):
        links = staged(_small_star(_large_star(links)), "links")
    tops = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )


def _is_star(links: DataFrame) -> bool:
    """Every node points to one node, which points nowhere."""
    inner = links.join(links.select(F.col("u").alias("v")), "v", "left_semi")
    return inner.isEmpty() and links.groupBy("u").count().filter("count > 1").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def cells(rows: DataFrame, key: Column, member: Column, limit: int) -> DataFrame:
    """``rows`` dealt to cells of at most about twice ``limit`` rows, in each of which pairs may be formed.

    Rows of one key meet in a cell. A key of more than ``limit`` rows is split
    into parts by a hash of ``member``, and each two parts meet in a cell of
    their own, so no task holds more, whatever a key has. Adds ``cell`` and
    ``part``; in a cell of two parts only pairs between them count.
    """
    keyed = rows.withColumn("cell_key", key)
    crowded = staged(
        keyed.groupBy("cell_key").count().filter(F.col("count") > limit)
        .select("cell_key", F.ceil(F.col("count") / limit).cast("int").alias("parts")),
        "crowded",
    )
    parted = keyed.join(crowded, "cell_key", "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(member), F.col("parts")).cast("int"))
    )
    other = F.explode(F.expr("CASE WHEN parts IS NULL THEN array(0) ELSE sequence(0, parts - 1) END"))
    cell = F.xxhash64("cell_key", F.least("part", "other"), F.greatest("part", "other"))
    dealt = parted.withColumn("other", other).withColumn("cell", cell).drop("other", "parts", "cell_key")
    return dealt.repartition("cell").sortWithinPartitions("cell")


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by ``cell``, cut so that each holds its cells whole.

    What is carried over is one cell, which ``cells`` has bounded.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = int64(batch.column("cell"))
        cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if cell[0] != cell[-1] else 0
        if cut or (held and held[-1].column("cell")[0].as_py() != cell[0]):
            done = [*held, batch.slice(0, cut)] if cut else held
            held = []
            yield pa.Table.from_batches(done)
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def pairs_within(cell: np.ndarray, part: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one cell, a distance in the sorted rows at a time.

    In a cell of two parts the pairs of one part are left out; they meet in the
    cell of that part alone.
    """
    first = np.r_[True, cell[1:] != cell[:-1]]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.r_[starts, len(cell)])
    low, high = np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts)
    mixed_cell = np.repeat(low != high, sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(cell))  # rows from here to the end of the cell
    rows = np.flatnonzero(left > 1)
    for step in range(1, int(sizes.max(initial=0))):
        rows = rows[left[rows] > step]
        i, j = rows, rows + step
        keep = ~mixed_cell[i] | (part[i] != part[j])
        yield (i, j) if keep.all() else (i[keep], j[keep])


class Forest:
    """Joins rows to trees and remembers only the joining edges."""

    def __init__(self, rows: int):
        self.parent = np.arange(rows)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        self._flatten()
        apart = self.parent[i] != self.parent[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist()):
            x, y = self._root(x), self._root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def _root(self, x: int) -> int:
        while self.parent[x] != x:
            x = self.parent[x]
        return int(x)

    def _flatten(self) -> None:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return
            self.parent = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each row that is no root, with its root."""
        self._flatten()
        below = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return below, self.parent[below]
