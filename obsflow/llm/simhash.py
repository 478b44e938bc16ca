"""SimHash near-duplicates by pivot distance tables (operator 4).

Fingerprints are 64-bit SimHashes of word shingles. A table holds each
fingerprint's Hamming distances to reference fingerprints, the pivots. By the
triangle inequality two fingerprints within ``max_bits`` differ by at most that
much in every column, so a pair with a larger difference in any column is
discarded without being compared; what survives is verified bit by bit.

Distances to whole pivots are nearly alike for unrelated fingerprints (32, give
or take 4), so they discard pairs but cannot find them. Pairs are found by the
same tables over parts of the bits: with the bits cut into ``segments`` parts, a
pair within ``max_bits`` agrees wholly in at least ``segments - max_bits`` of
them, so the distances to the pivots within those parts have difference 0. One
table per choice of parts, keyed by its row of distances, therefore meets every
linked pair. More segments make longer keys and more tables: 5 suit up to some
100 million distinct fingerprints, 6 or 7 more than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.common import arrow_map, documents, int64, mixed, record_batch, staged
from obsflow.llm.components import Forest, cells, components, pairs_within, whole_cells
from obsflow.llm.registry import query

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 5
PIVOTS = 16
SEGMENT_PIVOTS = 8
CELL_ROWS = 4096
_WORDS_AT_ONCE = 1 << 16


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of the lower-cased text, repeats included, some at a time."""
    words = text.lower().split()
    if not words:
        return
    if len(words) < shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
        return
    for begin in range(0, len(words) - shingle + 1, _WORDS_AT_ONCE):
        some = words[begin : begin + _WORDS_AT_ONCE + shingle - 1]
        joined = zip(*(some[i:] for i in range(shingle)))
        yield np.array([xxhash.xxh64_intdigest(b" ".join(s), 42) for s in joined], np.uint64)


def simhash(text: bytes | None, shingle: int) -> int:
    """The signed 64-bit fingerprint; zero without words."""
    votes, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or b"", shingle):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(votes * 2 > total).view(">i8")[0])


def fingerprint_column(text, shingle: int = SHINGLE):
    """The fingerprint of a text column as a signed 64-bit column."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(F.col(text).cast("binary"))


@lru_cache
def pivots() -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random 64-bit numbers."""
    return mixed(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def choices(segments: int, max_bits: int) -> list[int]:
    """The bit masks of each choice of ``segments - max_bits`` of the segments."""
    if segments <= max_bits:
        raise ValueError("as many segments as differing bits leave no segment equal")
    edges = [round(i * 64 / segments) for i in range(segments + 1)]
    parts = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, segments - max_bits)]


def _segment_tables(segments: int, max_bits: int):
    masks = choices(segments, max_bits)
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("fp", pa.int64())])

    def step(batches):
        for batch in batches:
            node, fp = int64(batch.column("node")), int64(batch.column("fp")).view(np.uint64)
            for number, mask in enumerate(masks):
                key = np.full(len(fp), number, np.uint64)
                for pivot in pivots()[:SEGMENT_PIVOTS]:
                    distance = np.bitwise_count((fp ^ pivot) & np.uint64(mask)).astype(np.uint64)
                    key = key << np.uint64(7) | distance
                yield record_batch(schema, key.view(np.int64), node, fp.view(np.int64))

    return step


def linked(fps: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs lie within ``max_bits``: pivot columns first, then the bits of the survivors."""
    alive = np.arange(len(i))
    for column in table:
        alive = alive[np.abs(column[i[alive]] - column[j[alive]]) <= max_bits]
    return alive[np.bitwise_count(fps[i[alive]] ^ fps[j[alive]]) <= max_bits]


def _verified_edges(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def step(batches):
        for rows in whole_cells(batches):
            rows = rows.combine_chunks()
            cell, part, node, fp = (int64(rows.column(c).combine_chunks()) for c in ("cell", "part", "node", "fp"))
            fps = fp.view(np.uint64)
            table = np.stack([np.bitwise_count(fps ^ p).astype(np.int8) for p in pivots()])
            forest = Forest(len(fps))
            for i, j in pairs_within(cell, part):
                near = linked(fps, i, j, table, max_bits)
                forest.join(i[near], j[near])
            below, root = forest.edges()
            yield record_batch(schema, node[below], node[root])

    return step


def fingerprint_components(fingerprints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(fp, component) of each distinct fingerprint of (doc_id, fp).

    Equal fingerprints are one node, named by its smallest doc_id, so copies
    cost nothing here. A fingerprint whose rows all lack a doc_id has no
    component and links with nothing.
    """
    nodes = staged(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprints")
    named = nodes.filter("node IS NOT NULL")
    tables = arrow_map(named, _segment_tables(segments, max_bits), "key bigint, node bigint, fp bigint")
    dealt = cells(tables, F.col("key"), F.col("node"), CELL_ROWS)
    edges = arrow_map(dealt, _verified_edges(max_bits), "a bigint, b bigint")
    joined = nodes.join(components(edges), "node", "left")
    return joined.select("fp", F.coalesce("component", "node").alias("component"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text; other columns are not looked at).

    Null and empty texts have fingerprint zero and link like any other. A
    repeated row gives a row each time; rows of one doc_id with different texts
    are judged text by text. A row without doc_id belongs to the component of
    its fingerprint, null if no document with an id has that. An empty table
    gives no rows. Texts are read whole, however long.
    """
    prints = staged(docs.select("doc_id", fingerprint_column("text", shingle).alias("fp")), "simhash")
    groups = fingerprint_components(prints, max_bits, segments)
    return prints.join(groups, "fp").select("doc_id", "fp", F.col("component").alias("component_id"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one document of each group: its smallest doc_id.

    Rows without a doc_id stay: they cannot be told apart from another document.
    """
    found = near_duplicates(docs, shingle, max_bits).filter("doc_id <> component_id")
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one row of each group: that of its smallest doc_id, then of the least hash.

    Rows are judged text by text, also where a doc_id has several. A row without
    doc_id belongs to the group of its fingerprint and stays if no row of that
    has an id; of several such rows one stays.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    prints = staged(docs.select("doc_id", key.alias("row_key"), fingerprint_column("text", shingle).alias("fp")), "simhash")
    groups = fingerprint_components(prints.select("doc_id", "fp"), max_bits, segments)
    alone = F.when(F.col("component").isNull(), F.col("fp"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = prints.join(groups, "fp").groupBy("component", alone.alias("alone")).agg(F.min(order).alias("first"))
    # Repeated rows are cut to one per task before they are dealt.
    repeats = Window.partitionBy("row_key").orderBy(F.xxhash64("row"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("row_key")).withColumn("nth", F.row_number().over(repeats))
    return rows.filter("nth = 1").join(first.select("first.row_key"), "row_key", "left_semi").select("row.*")


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
