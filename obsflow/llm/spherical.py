"""Embedding near-duplicates by spherical-cap filters (operator 1).

Each vector is assigned to the caps of the unit sphere that contain it: all
filter directions with which its inner product exceeds a height, which is a share
of its largest one. A height common to all vectors would put some into very many
caps and others into none. Two vectors of cosine ``threshold`` share some cap with probability ``recall`` or more; pairs
that share one are compared in double precision.

The directions form a random product code (Becker, Ducas, Gama and Laarhoven,
2016): the rotated space is cut into two blocks (below 16 dimensions it is one),
each with random words, and a direction is one word from each block. A vector's
inner products with all ``words ** 2`` directions are sums over blocks, so those
above the height are listed block by block without looking at the others. The height depends on
the dimension and these parameters alone: seeded pairs at exactly the threshold
are drawn, and the height is the one at which ``recall`` of them share a cap.

More words make smaller caps: in 64 dimensions a vector lies in some 20 caps with
256 words and in some 90 with 4,096, 256 times as many directions, and the share
of all vectors that it is compared with, about a hundredth with 256 words, falls
accordingly. So directions are in proportion to the
vectors (``words_for``), and a vector is compared with about as many others in a
large table as in a small one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import arrow_map, int64, record_batch, staged
from obsflow.llm.components import Forest, cells, components, pairs_within, whole_cells
from obsflow.llm.registry import query

THRESHOLD = 0.9
RECALL = 0.995
#: Words per block for so many vectors; directions, their square, grow in proportion.
WORDS, WORDS_VECTORS = 256, 100_000
CELL_ROWS = 2048
_SEED = 20161
_TRIALS = 400
_VECTORS_AT_ONCE = 2048
_SCORES_AT_ONCE = _PRODUCTS_AT_ONCE = 1 << 20
_COLUMNS = 1024
#: Cells of up to so many rows are compared together, larger ones as blocks.
_FEW = 64
#: Products of blocks of vectors are as near to the plain sums as this; close calls are summed plainly.
_ROUNDING = 1e-9


@dataclass(frozen=True)
class ProductCode:
    """Filter directions for one dimension."""

    rotation: np.ndarray
    blocks: tuple[np.ndarray, ...]  # words by block
    edges: tuple[int, ...]

    @classmethod
    def of(cls, dimension: int, words: int) -> "ProductCode":
        draw = np.random.default_rng((_SEED, dimension, words))
        count = 1 if dimension < 16 else 2
        edges = tuple(round(i * dimension / count) for i in range(count + 1))
        some = [draw.standard_normal((words, high - low)) for low, high in zip(edges, edges[1:])]
        rotation, _ = np.linalg.qr(draw.standard_normal((dimension, dimension)))
        return cls(rotation, tuple(b / np.linalg.norm(b, axis=1, keepdims=True) for b in some), edges)

    def scores(self, unit: np.ndarray) -> list[np.ndarray]:
        """Inner products with the words of each block, as shares of the vector's best direction."""
        turned = unit @ self.rotation
        own = [turned[:, low:high] @ words.T for low, high, words in zip(self.edges, self.edges[1:], self.blocks)]
        best = sum(s.max(axis=1) for s in own)
        return [s / np.maximum(best, 1e-300)[:, None] for s in own]

    def decode(self, unit: np.ndarray, height: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of all directions above the height; the next block is opened only where it can get there."""
        scores = self.scores(unit)
        best_rest = np.cumsum([s.max(axis=1) for s in reversed(scores)], axis=0)[::-1]
        rows, codes, sums = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for number, score in enumerate(scores):
            total = sums[:, None] + score[rows]
            rest = best_rest[number + 1][rows][:, None] if number + 1 < len(scores) else 0.0
            at, word = np.nonzero(total + rest >= height)
            rows, codes, sums = rows[at], codes[at] * score.shape[1] + word, total[at, word]
        return rows, codes

    def sums(self, unit: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the directions listed with their rows give, as shares of the vector's best one."""
        total, codes = np.zeros(len(rows)), codes.copy()
        for score in reversed(self.scores(unit)):
            total += score[rows, codes % score.shape[1]]
            codes //= score.shape[1]
        return total


@lru_cache
def caps(dimension: int, words: int, threshold: float, recall: float) -> tuple[ProductCode, float]:
    """The filter directions, and the height at which the given share of random pairs at the threshold share a cap."""
    draw = np.random.default_rng((_SEED, dimension, 1))
    x = draw.standard_normal((_TRIALS, dimension))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = draw.standard_normal((_TRIALS, dimension))
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * away
    code = ProductCode.of(dimension, words)
    for floor in np.arange(0.95, -1.0, -0.05):
        rows, codes = code.decode(x, float(floor))
        best = np.full(_TRIALS, -1.0)
        np.maximum.at(best, rows, np.minimum(code.sums(x, rows, codes), code.sums(y, rows, codes)))
        height = float(np.quantile(best, 1 - recall, method="lower"))
        if height >= floor:
            break
    return code, height


def words_for(vectors: int) -> int:
    """Words per block, so that directions are in proportion to the vectors; for less than a hundred thousand as for these."""
    return max(WORDS, math.ceil(WORDS * math.sqrt(vectors / WORDS_VECTORS)))


def _vectors(batch: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
    column = batch.column("embedding")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = int64(column.value_lengths())
    return np.split(values, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _by_dimension(vectors: list[np.ndarray]):
    """Rows and unit vectors of each dimension."""
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        some = np.stack([vectors[r] for r in rows])
        some /= np.abs(some).max(axis=1, keepdims=True)  # squares of very small or large numbers would vanish or overflow
        yield int(size), rows, some / np.linalg.norm(some, axis=1, keepdims=True)


def _filters(words: int, threshold: float, recall: float, kind: str):
    numbers = pa.list_(pa.float32() if kind == "float" else pa.float64())
    schema = pa.schema([
        ("key", pa.int64()), ("nth", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()),
        ("filters", pa.list_(pa.int64())), ("embedding", numbers),
    ])
    at_once = max(1, min(_VECTORS_AT_ONCE, _SCORES_AT_ONCE // words))

    def step(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, at_once):
                batch = whole.slice(begin, at_once)
                for size, rows, unit in _by_dimension(_vectors(batch)):
                    directions, height = caps(size, words, threshold, recall)
                    row, key = directions.decode(unit, height)
                    key = key * 65536 + size  # dimensions do not mix
                    order = np.lexsort((key, row))
                    row, key = row[order], key[order]
                    starts = np.searchsorted(row, np.arange(len(rows) + 1))
                    nth = np.arange(len(row)) - starts[row]
                    lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(key))
                    take = pa.array(rows[row])
                    yield record_batch(
                        schema, key, nth, batch.column("node").take(take), batch.column("copies").take(take),
                        lists.take(pa.array(row)), batch.column("embedding").cast(numbers).take(take),
                    )

    return step


def _earlier(lists: np.ndarray, nth: np.ndarray) -> list[np.ndarray]:
    """The filters that rows have before the present one, as columns of ones and zeros, some columns at a time.

    Columns of a single row are left out. Lists are sorted, so a filter before
    the present one is so for every row that has it, and two rows share one if
    their rows of some block have a product.
    """
    before = np.arange(lists.shape[1]) < nth[:, None]
    row, at = np.nonzero(before)
    key, column, often = np.unique(lists[row, at], return_inverse=True, return_counts=True)
    place = np.cumsum(often > 1) - 1
    shared = often[column] > 1
    row, column = row[shared], place[column[shared]]
    blocks = []
    for low in range(0, int((often > 1).sum()), _COLUMNS):
        some = (column >= low) & (column < low + _COLUMNS)
        ones = np.zeros((len(lists), min(_COLUMNS, int((often > 1).sum()) - low)), np.float32)
        ones[row[some], column[some] - low] = 1
        blocks.append(ones)
    return blocks


def _links_of_cell(
    part: np.ndarray, unit: np.ndarray, sizes: np.ndarray, copies: np.ndarray, lists: np.ndarray, nth: np.ndarray, threshold: float
) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The links that are counted in one cell, by row, and the roots of the trees they make.

    Blocks of rows are multiplied with all rows behind them. A pair that shares
    a filter before the present one is counted there. In a cell of two parts the
    pairs of one part are left out; they meet in the cell of that part alone.
    """
    count = len(part)
    links, forest = np.zeros(count), Forest(count)
    two_parts = part.min() != part.max()
    earlier = None
    step = max(1, _PRODUCTS_AT_ONCE // count)
    for begin in range(0, count - 1, step):
        stop = min(begin + step, count)
        own, behind = slice(begin, stop), slice(begin + 1, count)
        cosines = unit[own] @ unit[behind].T
        near = cosines >= threshold - _ROUNDING
        near &= np.arange(begin + 1, count) > np.arange(begin, stop)[:, None]
        if two_parts:
            near &= part[own, None] != part[behind]
        if not near.any():
            continue
        near &= sizes[own, None] == sizes[behind]
        i, j = np.nonzero(near & (cosines < threshold + _ROUNDING))
        near[i, j] = np.einsum("ij,ij->i", unit[own][i], unit[behind][j]) >= threshold
        earlier = _earlier(lists, nth) if earlier is None else earlier
        for ones in earlier:
            near &= ones[own] @ ones[behind].T == 0
        links[own] += near @ copies[behind]
        links[behind] += copies[own] @ near
        i, j = np.nonzero(near)
        forest.join(i + begin, j + begin + 1)
    return links.astype(np.int64), forest.edges()


def _shared_earlier(lists: np.ndarray, nth: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether two rows share a filter before the present one; then their pair is counted there."""
    found = np.zeros(len(i), bool)
    for a in range(int(nth[i].max(initial=0))):
        mine = lists[i, a]
        found |= (a < nth[i]) & ((lists[j] == mine[:, None]) & (np.arange(lists.shape[1]) < nth[j][:, None])).any(axis=1)
    return found


def _links_of_small_cells(
    cell: np.ndarray, part: np.ndarray, unit: np.ndarray, sizes: np.ndarray, copies: np.ndarray, lists: np.ndarray,
    nth: np.ndarray, threshold: float,
) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The same for many cells of a few rows each, a distance in the sorted rows at a time."""
    links, forest = np.zeros(len(cell)), Forest(len(cell))
    for i, j in pairs_within(cell, part):
        near = (np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold) & (sizes[i] == sizes[j])
        i, j = i[near], j[near]
        first = ~_shared_earlier(lists, nth, i, j)
        i, j = i[first], j[first]
        forest.join(i, j)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
    return links.astype(np.int64), forest.edges()


def _verified(threshold: float):
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def step(batches):
        for rows in whole_cells(batches):
            cell, part, node, copies, nth = (
                int64(rows.column(c).combine_chunks()) for c in ("cell", "part", "node", "copies", "nth")
            )
            filters = rows.column("filters").combine_chunks()
            counts = int64(filters.value_lengths())
            lists = np.full((len(cell), int(counts.max(initial=1))), -1, np.int64)
            lists[np.arange(lists.shape[1]) < counts[:, None]] = int64(filters.flatten())
            vectors = _vectors(rows)
            sizes = np.array([len(v) for v in vectors])
            unit = np.zeros((len(cell), int(sizes.max(initial=1))))
            for size, at, found in _by_dimension(vectors):
                unit[at, :size] = found
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            lengths = np.diff(np.r_[starts, len(cell)])
            few = np.flatnonzero(np.repeat((lengths > 1) & (lengths <= _FEW), lengths))
            facts = (part, unit, sizes, copies.astype(np.float64), lists, nth)
            parts = [(few, _links_of_small_cells(cell[few], *(f[few] for f in facts), threshold))] if len(few) else []
            for start, length in zip(starts, lengths):
                if length > _FEW:
                    own = np.arange(start, start + length)
                    parts.append((own, _links_of_cell(*(f[own] for f in facts), threshold)))
            for own, (links, (below, root)) in parts:
                roots = np.arange(len(own))
                roots[below] = root
                kept = np.flatnonzero((links > 0) | (roots != np.arange(len(own))))
                if len(kept):
                    yield record_batch(schema, node[own[kept]], node[own[roots[kept]]], links[kept])

    return step


def comparable(embedding: str) -> Column:
    """Whether a vector has a direction: not null, empty or zero, all components finite numbers."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, words: int | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``vectors`` (vec_id, embedding; other columns are not looked at).

    Links have cosine ``threshold`` or more; those at exactly the threshold are
    found with probability ``recall``, closer ones more surely. Equal vectors
    are one node with a number of copies, so a group of copies costs one row.

    Components count as they come, single or double precision; cosines are in
    double precision. Without ``words`` their number follows the table's size.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing and are their own component; so do vectors without id,
    whose component is null. Vectors of different dimensions do not link. A
    repeated row is another vector with the same id. An empty table gives no
    rows.
    """
    # Components stay as exact as they come: single precision for such a column, double for any other.
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    usable = rows.filter(comparable("embedding") & F.col("vec_id").isNotNull())
    nodes = staged(
        usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    # Different vectors of one id share a node; that links them as one id must.
    filtered = arrow_map(
        nodes, _filters(words or words_for(nodes.count()), threshold, recall, kind),
        f"key bigint, nth int, node bigint, copies bigint, filters array<bigint>, embedding array<{kind}>",
    )
    dealt = cells(filtered, F.col("key"), F.hash("embedding"), CELL_ROWS)
    found = staged(arrow_map(dealt, _verified(threshold), "node bigint, root bigint, links bigint"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = nodes.join(links, "node", "left").join(groups, "node", "left").select(
        "embedding", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    known = usable.join(joined, "embedding").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.filter(~(comparable("embedding") & F.col("vec_id").isNotNull())).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return known.union(alone)


_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e,
    vec_id IS NOT NULL AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0, FALSE) AS usable
  FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reached AS (
  SELECT vec_id AS id, vec_id AS other FROM rows
  UNION
  SELECT links.b, other FROM reached JOIN links ON links.a = id
), found AS (
  SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
    (SELECT min(other) FROM reached WHERE id = vec_id) AS component_id
  FROM rows
)
SELECT *, coalesce(vec_id = component_id, FALSE) AS kept FROM found
"""


@query("op1_embedding_near_dedup", _SQL)
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
