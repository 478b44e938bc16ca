"""Document fingerprints by closed syncmers (operator 5).

A k-mer of code points is an anchor if its least inner substring of ``INNER``
code points, by hash, lies at one of its two ends. That depends on the k-mer
alone, so a passage has the same anchors wherever it stands. A fingerprint keeps
all anchors with their first places, so it grows with the text. Two fingerprints
are matched by position: of the anchors they share, those count that stand in
the same order in both texts.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.common import arrow_map, documents, groups_of, int64, mixed, record_batch, staged
from obsflow.llm.registry import query

KMER = 12
INNER = 4
#: How many anchors a fingerprint keeps, the end of a slice: all of them.
ANCHORS = None
_CHARS_AT_ONCE = 1 << 18
_BYTES_AT_ONCE = 1 << 22
_ANCHOR = np.dtype([("hash", ">u4"), ("place", ">u4")])


def _window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(max(len(codes) - size + 1, 0), np.uint64)
    for i in range(size):
        total = total * np.uint64(0x100000001B3) + codes[i : i + len(total)]
    return mixed(total)


def closed_syncmers(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of an array of code points."""
    if len(codes) < KMER:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner, span = _window_hashes(codes, INNER), KMER - INNER + 1
    least, width = inner, 1
    while width < span:  # least hash of twice as many windows, the last time of as many as are missing
        step = min(width, span - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    count = len(least)
    places = np.flatnonzero((inner[:count] == least) | (inner[span - 1 : span - 1 + count] == least))
    return places, _window_hashes(codes, KMER)[places]


def _first_places(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The different anchors with their first places, sorted by hash."""
    kept, first = np.unique(hashes >> np.uint64(32), return_index=True)
    found = np.zeros(len(kept), _ANCHOR)
    found["hash"], found["place"] = kept, places[first]
    return found


def anchors(texts: Sequence[str]) -> list[np.ndarray]:
    """The fingerprint of each text as an array of (hash, place).

    A text without an anchor is one anchor itself; an empty one has none.
    """
    found = []
    for begin, end in groups_of((len(t) for t in texts), _CHARS_AT_ONCE):
        some = texts[begin:end]
        if end - begin == 1:
            parts = [_long(some[0])]
        else:
            # One array for all; k-mers across the borders of texts are dropped.
            codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
            places, hashes = closed_syncmers(codes)
            starts = np.cumsum([0, *(len(t) for t in some)])
            ends = np.searchsorted(places, np.maximum(starts[1:] - KMER + 1, starts[:-1]))
            begins = np.searchsorted(places, starts[:-1])
            parts = [(places[b:e] - s, hashes[b:e]) for b, e, s in zip(begins, ends, starts)]
        for text, (places, hashes) in zip(some, parts):
            if not len(places) and text:
                places = np.zeros(1, np.int64)
                hashes = np.frombuffer(hashlib.blake2b(text.encode(), digest_size=8).digest(), np.uint64)
            found.append(_first_places(hashes, places))
    return found


def _long(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of one text, in pieces that overlap by a k-mer less one."""
    parts = []
    for begin in range(0, max(len(text), 1), _CHARS_AT_ONCE):
        some = text[begin : begin + _CHARS_AT_ONCE + KMER - 1]
        places, hashes = closed_syncmers(np.frombuffer(some.encode("utf-32-le"), np.uint32))
        parts.append((places + begin, hashes))
    return tuple(np.concatenate(c) for c in zip(*parts))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of the anchors that stand in the same order in both texts, 0 to 1; two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    _, in_a, in_b = np.intersect1d(a["hash"], b["hash"], assume_unique=True, return_indices=True)
    order = np.argsort(a["place"][in_a], kind="stable")
    tails: list[int] = []  # the longest run of places that grows in both texts
    for place in b["place"][in_b][order].tolist():
        if not tails or place > tails[-1]:
            tails.append(place)
        else:
            tails[bisect_left(tails, place)] = place
    return 2 * len(tails) / (len(a) + len(b))


def printed(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), _ANCHOR)


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the beginning of another."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _range_number(bounds: np.ndarray) -> Column:
    """The range of a doc_id; rows without one have the range -1, behind all others."""

    @F.pandas_udf("int")
    def of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy()), dtype="int32")

    return F.when(F.col("doc_id").isNull(), -1).otherwise(of(F.coalesce("doc_id", F.lit(0))))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (range, ends, doc_id, text) sorted so that each document is followed by the next one.

    The order is descending doc_id, rows without id at the end, rows of one id
    by their text; after the last comes the first. The ids are cut into ranges
    at their quantiles; each range ends with a copy of the first document of the
    range that follows (``ends`` is 1), so no task has to look into another.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    found = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10 * ranges)).alias("bounds")).first()["bounds"]
    bounds = np.unique(np.array(found or [0], np.int64))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("range", _range_number(bounds))
    first = staged(rows.groupBy("range").agg(F.max("doc_id").alias("first_id")), "first-ids")
    same = (rows["range"] == first["range"]) & rows["doc_id"].eqNullSafe(first["first_id"])
    # At most a row per range, and those are bounded above.
    heads = rows.join(F.broadcast(first), same).groupBy(first["range"].alias("range")).agg(F.min("text").alias("text"))
    by_range = Window.orderBy("range")
    before = F.coalesce(F.lead("range").over(by_range), F.min("range").over(Window.orderBy(F.lit(1))))
    ends = heads.select(before.alias("range"), F.lit(1).alias("ends"), F.lit(None).cast("bigint").alias("doc_id"), "text")
    own = rows.select("range", F.lit(0).alias("ends"), "doc_id", "text")
    return own.union(ends).repartition("range").sortWithinPartitions("range", "ends", F.desc_nulls_last("doc_id"), "text")


def _fingerprint_rows(schema: pa.Schema):
    held: list[tuple] = []  # the last row so far, which waits for its next one

    def some(batch):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        rows = held + list(zip(int64(batch.column("ends")).tolist(), ids, texts, anchors(texts)))
        held[:] = rows[-1:]
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[0]]
        changed = [edited(a[2], b[2]) for a, b in pairs]
        new = anchors(changed)
        return record_batch(
            schema,
            [a[1] for a, _ in pairs],
            [len(a[2]) for a, _ in pairs],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            [printed(a[3]) for a, _ in pairs],
            [printed(e) for e in new],
            [likeness(a[3], e) for (a, _), e in zip(pairs, new)],
            [likeness(a[3], b[3]) for a, b in pairs],
        )

    def step(batches):
        held.clear()
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_pylist()
            for begin, end in groups_of(lengths, _BYTES_AT_ONCE):
                yield some(batch.slice(begin, end - begin))

    return step


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The fingerprint of every text of ``docs`` (doc_id, text; other columns are not looked at), and of its edited text.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text counts as empty; an empty text has an
    empty fingerprint, which is alike to an empty one only. Repeated rows are
    each other's next document. A single document is its own next one. An empty
    table gives no rows. Texts are read whole, however long; a fingerprint takes
    about 2.4 characters for each one of its text.
    """
    names = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])
    return arrow_map(with_next(docs, ranges), _fingerprint_rows(schema), names)


@query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
