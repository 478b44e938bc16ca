"""Exact dedup by deterministic block naming (operator 12).

A text without its white space is cut into blocks of a fixed size. Equal blocks
get one integer name, dealt in sorted order. Then names at an even place and the
names behind them are paired, and equal pairs get one integer name, again and
again, until every document has one name left. Two documents end with the same
name after the same number of rounds if and only if their texts are equal: no
name stands for two things.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import documents, staged
from obsflow.llm.registry import query

#: What does not count when texts are compared: the space and the controls from tab to carriage return.
_IGNORED = " \t\n\x0b\x0c\r"

#: Code points in a block. Most documents have one or two blocks, and twice as long a text takes one round more.
BLOCK = 2048

#: A pair of the last name of an odd number of names has no second name.
_NONE = -1

Digest = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """The text without the characters that do not count; null counts as empty."""
    return reduce(lambda left, c: F.replace(left, F.lit(c)), _IGNORED, F.coalesce(text, F.lit("")))


def _blocks(text: Column, size: int) -> Column:
    """The blocks of a text in order; an empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) <= size, F.array(text)).otherwise(cut)


def _named(sorted_keys: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Different keys with their integer names, dealt over the whole table in sorted order."""
    dealt = sorted_keys.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return staged(dealt.withColumn("name", F.monotonically_increasing_id()), label)


def name_blocks(docs: DataFrame, size: int, digest: Digest) -> DataFrame:
    """(digest, content, name) of every different block.

    Blocks are sorted by digest, then by content. Where one block alone has a
    digest, the digest tells it apart from all others and ``content`` is null:
    the sort has compared them. Different blocks of one digest keep their
    content, by which they are told apart.
    """
    # In a projection of its own, so that it is worked out once.
    texts = docs.select(normalised(F.col("text")).alias("plain"))
    met = (
        texts.select(F.explode(_blocks(F.col("plain"), size)).alias("content"))
        .groupBy(digest(F.col("content")).alias("digest"))
        .agg(F.array_sort(F.collect_set("content")).alias("contents"))
    )
    told_apart = F.when(F.size("contents") > 1, F.col("contents")).otherwise(F.array(F.lit(None).cast("string")))
    return _named(met.select("digest", F.explode(told_apart).alias("content")), ["digest", "content"], "block-names")


def identities(docs: DataFrame, size: int = BLOCK, digest: Digest = F.xxhash64) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` and the identity of each.

    Gives two tables: (row, doc_id, chars, text_sha256), where ``row`` numbers
    the rows, and (row, round, name): texts are equal if round and name are.
    ``digest`` only routes blocks; any function gives the same groups.
    """
    names = name_blocks(docs, size, digest)
    # Only where a digest has several blocks are contents needed to find the name.
    shared = not names.filter("content IS NOT NULL").isEmpty()
    texts = docs.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), normalised(F.col("text")).alias("plain")
    )

    def described(block: Column) -> Column:
        own = block if shared else F.lit(None).cast("string")
        return F.struct(digest(block).alias("digest"), own.alias("own"))

    rows = staged(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "chars",
            F.sha2("plain", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("plain"), size), described).alias("blocks"),
        ),
        "block-rows",
    )
    parts = rows.select("row", F.size("blocks").alias("parts"), F.posexplode("blocks").alias("place", "block"))
    asked = names.withColumnRenamed("digest", "met")
    same = (F.col("block.digest") == F.col("met")) & F.coalesce(
        F.col("content") == F.col("block.own"), F.col("content").isNull()
    )
    level = parts.join(asked, same).select("row", "parts", "place", "name")
    finished, number = [], 0
    while True:
        level = staged(level, f"names-{number}")
        finished.append(level.filter("parts = 1").select("row", F.lit(number).alias("round"), "name"))
        longer = level.filter("parts > 1")
        if longer.isEmpty():
            break
        level, number = _paired(longer, number), number + 1
    done = finished[0]
    for more in finished[1:]:
        done = done.union(more)
    return rows.drop("blocks"), done


def _paired(level: DataFrame, number: int) -> DataFrame:
    """One round: the names of adjacent pairs."""
    second = F.col("place") % 2 == 1
    pairs = staged(
        level.groupBy("row", "parts", F.floor(F.col("place") / 2).alias("place")).agg(
            F.max(F.when(~second, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(second, F.col("name"))), F.lit(_NONE)).alias("second"),
        ),
        f"pairs-{number}",
    )
    names = _named(pairs.select("first", "second").distinct(), ["first", "second"], f"pair-names-{number}")
    return pairs.join(names, ["first", "second"]).select("row", F.ceil(F.col("parts") / 2).alias("parts"), "place", "name")


def exact_duplicates(docs: DataFrame, size: int = BLOCK, digest: Digest = F.xxhash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id, text; other columns are not looked at).

    Texts are equal when they are after white space (space, tab to carriage
    return) is taken out. Of equal texts the row with the most code points
    stays, then the one with the smallest doc_id, rows without an id last; of
    rows that repeat an id and a length one stays. A null text is an empty one,
    and empty texts are equal. A repeated row is another member of its group.
    An empty table gives no rows. Texts count whole, whatever their length.
    """
    rows, names = identities(docs, size, digest)
    known = staged(rows.join(names, "row"), "identities")
    rank = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = known.groupBy("round", "name").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return known.join(groups, ["round", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM texts WINDOW w AS (PARTITION BY t ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM ranked
"""


@query("op12_block_naming_dedup", _SQL)
def op12_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))
