"""Preference formatting (operator 7).

A chosen and a rejected conversation begin alike. Their longest common prefix of
turns is rendered once as the prompt; what follows in each is rendered as its
completion, with the spans that a model is trained on: what the assistant says
and the mark that ends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.registry import query

# How a turn is rendered.
HEAD, HEAD_END, TURN_END, LINE_END = "<|", "|>\n", "<|end|>", "\n"
TRAINED_ROLE = "assistant"


def _plain(column: Column) -> Column:
    """A text that cannot be taken for a mark: ``<|`` in it gets a space. Null is empty."""
    return F.replace(F.coalesce(column, F.lit("")), F.lit(HEAD), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), _plain(turn["role"]), F.lit(HEAD_END))


def _body(turn: Column) -> Column:
    return F.concat(_plain(turn["text"]), F.lit(TURN_END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit(LINE_END))), "")


def _mask(turns: Column) -> Column:
    """The trained spans of the rendered turns as ``start:end``, in code points, the end exclusive."""

    def step(done: Column, turn: Column) -> Column:
        start = done["at"] + F.length(_head(turn))
        end = start + F.length(_body(turn))
        span = F.concat_ws(":", start, end)
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((end + len(LINE_END)).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, first, step, lambda done: done["spans"]), ",")


def _side(chosen: bool) -> Column:
    """The turns of one side in order: by number, then by role and text where numbers repeat."""
    own = F.filter("turns", lambda t: t["chosen"] == F.lit(chosen))
    return F.transform(F.array_sort(own), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_preferences(turns: DataFrame) -> DataFrame:
    """A row per pair of (pair_id, chosen boolean, turn, role, text).

    Columns: pair_id, n_common (turns of the prompt), prompt, chosen,
    chosen_mask, rejected, rejected_mask. Turns are common as long as role and
    text are equal at the same place, null being equal to null. A pair of equal
    conversations has empty completions. A conversation without a partner has an
    empty prompt, and the completion and mask of the missing side are null. Null
    roles and texts are rendered as empty, turns without number come first, and
    repeated rows are turns of their own. Rows without a pair_id or without a
    side belong to no pair and are left out. An empty table gives no rows.

    The turns of one pair come together in one task: a conversation is one text
    in the end. Nothing else is gathered.
    """
    rows = turns.filter("pair_id IS NOT NULL AND chosen IS NOT NULL")
    turn = F.struct("chosen", "turn", "role", "text")
    pairs = rows.groupBy("pair_id").agg(F.collect_list(turn).alias("turns"))
    sides = pairs.select("pair_id", _side(True).alias("a"), _side(False).alias("b"))
    both = F.least(F.size("a"), F.size("b"))
    differs = F.transform(
        F.slice(F.arrays_zip("a", "b"), F.lit(1), both), lambda z: ~z["a"].eqNullSafe(z["b"])
    )
    fork = F.array_position(differs, F.lit(True))
    forked = sides.withColumn("n_common", F.when(fork > 0, fork - 1).otherwise(both).cast("bigint"))
    start = (F.col("n_common") + 1).cast("int")

    def rest(side: str) -> Column:
        return F.slice(F.col(side), start, F.size(side))

    cut = forked.select("pair_id", "n_common", "a", "b", rest("a").alias("rest_a"), rest("b").alias("rest_b"))
    return cut.select(
        "pair_id", "n_common", _rendered(F.slice("a", F.lit(1), F.col("n_common").cast("int"))).alias("prompt"),
        *(
            F.when(F.size(side) > 0, what(F.col(f"rest_{side}"))).alias(name)
            for side, name, what in (
                ("a", "chosen", _rendered), ("a", "chosen_mask", _mask), ("b", "rejected", _rendered), ("b", "rejected_mask", _mask)
            )
        ),
    )


def neighbours(conversations: DataFrame) -> DataFrame:
    """Conversations as pairs: 2n is the chosen one, 2n + 1 the rejected one."""
    even = F.pmod("conv_id", F.lit(2)) == 0
    return conversations.select(F.shiftright("conv_id", 1).alias("pair_id"), even.alias("chosen"), "turn", "role", "text")


def _sql() -> str:
    def plain(column: str) -> str:
        return f"replace(coalesce({column}, ''), '{HEAD}', '< |')"

    def side(chosen: str, name: str) -> str:
        own = f"chosen = {chosen}"
        return f"""CASE WHEN count(*) FILTER ({own}) > 0 THEN
      coalesce(string_agg(rendered, '' ORDER BY place) FILTER ({own} AND place > n_common), '') END AS {name},
    CASE WHEN count(*) FILTER ({own}) > 0 THEN
      coalesce(string_agg(span, ',' ORDER BY place) FILTER ({own} AND place > n_common AND role = '{TRAINED_ROLE}'), '') END AS {name}_mask"""

    return f"""
WITH placed AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS chosen, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
    '{HEAD}' || {plain("role")} || '{HEAD_END}' AS head, {plain("text")} || '{TURN_END}' AS body
  FROM conversations
), counted AS (
  SELECT pair_id, min(place) FILTER (NOT alike) - 1 AS before, max(place) FILTER (alike) AS common
  FROM (
    SELECT pair_id, place, count(*) = 2 AND count(DISTINCT (coalesce(role, ''), role IS NULL, coalesce(text, ''), text IS NULL)) = 1 AS alike
    FROM placed GROUP BY pair_id, place
  ) GROUP BY pair_id
), rendered AS (
  SELECT p.*, coalesce(before, common, 0) AS n_common, head || body || '{LINE_END}' AS rendered
  FROM placed p JOIN counted USING (pair_id)
), spans AS (
  SELECT *, coalesce(sum(length(rendered)) FILTER (place > n_common) OVER (
      PARTITION BY pair_id, chosen ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rendered
), marked AS (
  SELECT *, (before + length(head))::BIGINT || ':' || (before + length(head) + length(body))::BIGINT AS span FROM spans
)
SELECT pair_id, any_value(n_common)::BIGINT AS n_common,
    coalesce(string_agg(rendered, '' ORDER BY place) FILTER (chosen AND place <= n_common), '') AS prompt,
    {side("TRUE", "chosen")},
    {side("FALSE", "rejected")}
FROM marked GROUP BY pair_id
"""


@query("op7_preference_pairs", _sql())
def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_preferences(neighbours(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
