"""Mixing sources to target weights by Pareto order sampling (operator 2).

Every source gets a target number of words. A document of a source whose target
is r times its size is expected r times: floor(r) whole copies are certain, and
the rest is an inclusion probability. Each document draws a number u from its id;
documents are ranked by the odds of u divided by the odds of their inclusion
(Rosén, 1997), and the first ones are taken whose words make up the rest of the
target. That is a sample of fixed size with unequal probabilities.

No source is sorted in one place. The rank is cut into cells, words are summed
per source and cell, and only the cell in which the target is reached is looked
into, twice; what comes back is one cut per source, against which every document
is judged where it lies. Documents of one id and size are counted before they
are ordered, so rows without id, or copies with one id, are one entry there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.common import WORD, documents, hash_share, staged
from obsflow.llm.registry import query

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
PASSES = 3
SEED = "mix:"
_CELLS = 4096
_RANKED = ("doc_id", "source", "size", "rank", "cell", "inner", "rows")
#: Tied rows that are numbered together.
_BLOCK_BITS = 12


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, size).

    All words are shared by weight; a target stops at ``max_repeats`` times its
    source, and the excess is shared anew. With the sources in order of the
    level at which they stop, the level of the others is the greatest of what
    is left per weight, so one pass over the sources settles all rounds.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    picks = F.array(*(F.lit(w) for w in weights))
    weighed = totals.withColumn("weight", picks[(F.row_number().over(order) - 1) % len(weights)])
    stops = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    stopped = F.coalesce(F.sum("source_size").over(stops.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * max_repeats
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - stopped
    per_weight = left / F.sum("weight").over(stops.rowsBetween(0, Window.unboundedFollowing))
    levelled = weighed.withColumn("level", per_weight).withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("source_size").cast("double") * max_repeats, F.col("level") * F.col("weight"))
    return levelled.select("source", "source_size", target.alias("target"))


def _with_rank(sized: DataFrame) -> DataFrame:
    """Adds the certain copies, the rank by odds and its cells to rows that know their source's target."""
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance")))
    scaled = F.col("rank") / (1 + F.col("rank")) * _CELLS
    return (
        sized.withColumn("whole", F.floor(share)).withColumn("chance", share - F.col("whole"))
        .withColumn("rank", F.when(F.col("chance") > 0, odds))
        .withColumn("cell", F.floor(scaled).cast("int"))
        .withColumn("inner", F.floor((scaled - F.col("cell")) * _CELLS).cast("int"))
    )


def _crossing(rows: DataFrame, cell: str, before: Column) -> DataFrame:
    """(source, cut, before, words): per source the cell in which the rest of its target is reached, and the words before it.

    No cell if the rest is more than all words, which ``words`` counts.
    """
    words = F.sum(F.col("size") * F.col("rows"))
    cells = rows.groupBy("source", cell).agg(words.alias("words"), F.first("rest").alias("rest"), F.first(before).alias("base"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy(cell))
    at = cells.withColumn("before", F.col("base") + running - F.col("words"))
    crosses = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    return at.groupBy("source").agg(
        F.max(F.when(crosses, F.col(cell))).alias("cut"), F.max(F.when(crosses, F.col("before"))).alias("before"),
        F.sum("words").alias("words"),
    )


def _same_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the source, a null source being one of them."""
    renamed = right.withColumnRenamed("source", "source_")
    return left.join(renamed, left["source"].eqNullSafe(renamed["source_"]), "left").drop("source_")


def _key() -> Column:
    return F.struct("rank", "doc_id", "size")


def _fits(number: int) -> Column:
    return F.col("rank").isNotNull() & (F.col("size") <= F.col(f"rest_{number}"))


def _below_cut(number: int) -> Column:
    """Whether a row is taken in a pass, of those that the pass considers and can tell apart."""
    cell, inner = F.coalesce(f"cell_{number}", F.lit(_CELLS)), F.coalesce(f"inner_{number}", F.lit(-1))
    last = F.col(f"last_{number}")
    at_last = F.coalesce((_key() < last) | (_key() == last) & (F.col(f"left_out_{number}") == 0), F.lit(False))
    within = (F.col("inner") < inner) | (F.col("inner") == inner) & at_last
    return F.coalesce(_fits(number) & ((F.col("cell") < cell) | (F.col("cell") == cell) & within), F.lit(False))


def _taken(passes: int) -> Column:
    """Whether a row is taken in one of the first passes."""
    return reduce(lambda a, b: a | b, (_below_cut(i) for i in range(passes)), F.lit(False))


def _tied(number: int) -> Column:
    """Whether a row is one of those alike in rank, id and size of which a pass takes some and leaves others."""
    alike = (_key() == F.col(f"last_{number}")) & (F.col(f"left_out_{number}") > 0)
    return F.coalesce(_fits(number) & alike, F.lit(False))


def _in_tie() -> Column:
    """The pass that takes some of the rows that tie with this one, null for most rows.

    There is one at most: what such a pass leaves of the target is less than the
    size of these rows, or it is the last one.
    """
    return F.coalesce(*(F.when(_tied(i) & ~_taken(i), i) for i in range(PASSES)))


def cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: its target, and for each pass the rank up to which documents get one more copy.

    ``sizes`` has (doc_id, source, size, u). The first pass takes documents in
    order of rank while they fit into the rest of the target; the next ones go
    on with those that fit into what is left, the last of them up to the nearest
    sum. How near the target is reached depends on their number, PASSES. Ranks tie
    where ids do; then the id and the size decide. Of rows alike in all of that the last
    key takes ``take_*`` and leaves ``left_out_*``.
    """
    counted = sizes.groupBy("doc_id", "source", "size", "u").agg(F.count("*").alias("rows"))
    ranked = staged(_with_rank(_same_source(counted, targets)).filter("rank IS NOT NULL").select(*_RANKED), "mix-ranks")
    rest = F.when(F.col("source_size") > 0, F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size"))
    found = targets.withColumn("rest_0", rest)
    for number in range(PASSES):
        known = _same_source(ranked, found.drop("source_size", "target"))
        rows = known.filter(~_taken(number) & (F.col("size") <= F.col(f"rest_{number}"))).select(
            *_RANKED, F.col(f"rest_{number}").alias("rest")
        )
        outer = staged(_crossing(rows, "cell", F.lit(0)).repartition(1), "mix-cells")
        within = staged(_same_source(rows, outer.drop("words")).filter("cell = cut").drop("cut"), "mix-within")
        inner = staged(_crossing(within, "inner", F.col("before")).repartition(1), "mix-inner")
        order = Window.partitionBy("source").orderBy(_key()).rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("rows")).over(order), F.lit(0))
        at_cut = _same_source(within.drop("before"), inner.drop("words")).filter("inner = cut").withColumn("ahead", ahead)
        last_rows = at_cut.withColumn("take", _first_rows(number == PASSES - 1)).filter("take > 0")
        reached = F.col("ahead") + F.col("take") * F.col("size")
        last = last_rows.groupBy("source").agg(
            F.max(_key()).alias(f"last_{number}"), F.max_by("take", _key()).alias(f"take_{number}"),
            F.max_by(F.col("rows") - F.col("take"), _key()).alias(f"left_out_{number}"), F.max(reached).alias("reached"),
        )
        cut = _same_source(found, outer.select("source", F.col("cut").alias(f"cell_{number}"), "words"))
        cut = _same_source(cut, inner.select("source", F.col("cut").alias(f"inner_{number}"), "before"))
        cut = _same_source(cut, last)
        whole = F.when(F.col(f"cell_{number}").isNull(), F.coalesce("words", F.lit(0)))
        spent = whole.otherwise(F.coalesce("reached", "before"))
        cut = cut.withColumn(f"rest_{number + 1}", F.col(f"rest_{number}") - spent)
        found = staged(cut.drop("words", "before", "reached").repartition(1), "mix-cuts")
    return found


def _first_rows(nearest: bool) -> Column:
    """How many of the ``rows`` alike the rest of the target has room for behind the words ahead of them."""
    size = F.col("size")
    needed = size / 2 if nearest else size
    guess = F.floor((F.col("rest") - needed - F.col("ahead")) / size) + 1
    # The quotient is rounded, the sum is what counts.
    room = guess - (F.col("ahead") + (guess - 1) * size + needed > F.col("rest")).cast("int")
    some = F.greatest(F.lit(0), F.least(F.col("rows"), room))
    return F.when(size > 0, some).otherwise(F.when(F.col("ahead") <= F.col("rest"), F.col("rows")).otherwise(0)).cast("bigint")


def _numbered(tied: DataFrame) -> DataFrame:
    """Adds ``ordinal``, the number of a row among those of its source and pass, counted from 0.

    The rows are written with a number each; blocks of them are counted, so no
    task sees all that tie.
    """
    written = staged(tied.withColumn("number", F.monotonically_increasing_id()), "mix-ties")
    blocked = written.withColumn("block", F.shiftright("number", _BLOCK_BITS))
    running = F.sum("rows").over(Window.partitionBy("source", "pass").orderBy("block"))
    blocks = blocked.groupBy("source", "pass", "block").agg(F.count("*").alias("rows"))
    first = blocks.select(F.col("source").alias("source_"), F.col("pass").alias("pass_"), F.col("block").alias("block_"),
                          (running - F.col("rows")).alias("ahead"))
    same = F.col("source").eqNullSafe(F.col("source_")) & (F.col("pass") == F.col("pass_")) & (F.col("block") == F.col("block_"))
    inside = F.row_number().over(Window.partitionBy("source", "pass", "block").orderBy("number")) - 1
    return blocked.join(first, same).withColumn("ordinal", F.col("ahead") + inside)


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """(row, size, source_size, target, copies) of every row of ``docs``; ``row`` holds its columns.

    ``copies`` says how often the mix takes the document. Documents are taken
    whole, so a source of few documents can miss its target by some words. A null text and one without words have size 0 and count for nothing;
    a null source is a source of its own, the last; rows that repeat are
    documents of their own with one draw; rows without id share one draw. Of
    rows that tie in source, id and size as many are taken as the target has room for, in
    the order in which they lie. An
    empty table gives no rows, and extra columns stay within ``row``. The draw
    depends on id and seed alone, so reruns agree.
    """
    held = docs.select(
        F.struct("*").alias("row"), "doc_id", "source", word_count("text").alias("size"), hash_share(F.col("doc_id"), seed).alias("u")
    )
    sizes = staged(held.drop("row"), "mix-sizes")
    targets = staged(source_targets(sizes, weights, max_repeats).repartition(1), "mix-targets")
    found = cuts(sizes, targets)
    judged = _with_rank(_same_source(held, found))
    result = "row", "size", "source_size", "target"

    def with_copies(rows: DataFrame, taken: Column) -> DataFrame:
        return rows.select(*result, (F.col("whole") + taken.cast("int")).cast("int").alias("copies"))

    ties = [F.coalesce(F.col(f"left_out_{i}") > 0, F.lit(False)) for i in range(PASSES)]
    if found.filter(reduce(lambda a, b: a | b, ties)).isEmpty():
        return with_copies(judged, _taken(PASSES))
    take = F.coalesce(*(F.when(F.col("pass") == i, F.col(f"take_{i}")) for i in range(PASSES)))
    in_tie = judged.withColumn("pass", _in_tie())
    tied = in_tie.filter("pass IS NOT NULL").select(*result, "source", "whole", "pass", take.alias("take"))
    return with_copies(in_tie.filter("pass IS NULL"), _taken(PASSES)).unionByName(
        with_copies(_numbered(tied), F.col("ordinal") < F.col("take"))
    )


def repeated(mixture: DataFrame) -> DataFrame:
    """The documents of a mixture, each as often as the mix takes it; those it does not take are left out."""
    return mixture.filter("copies > 0").select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")


def _passes_sql() -> str:
    """Each pass looks at the rows not picked that fit, and picks the first ones by rank."""
    steps = []
    for number in range(PASSES):
        counted = "size / 2e0" if number == PASSES - 1 else "size"
        steps.append(f""", open_{number} AS (
  SELECT *, rank IS NOT NULL AND NOT picked AND size <= rest AS fits FROM rest_{number}
), pick_{number} AS (
  SELECT * EXCLUDE (picked), picked OR (fits AND coalesce(sum(size) FILTER (fits) OVER (PARTITION BY source
      ORDER BY rank, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE
    + {counted} <= rest) AS picked
  FROM open_{number}
), rest_{number + 1} AS (
  SELECT * EXCLUDE (rest, fits), target - whole * source_size
    - coalesce(sum(size) FILTER (picked) OVER (PARTITION BY source), 0) AS rest
  FROM pick_{number}
)""")
    return "".join(steps)


_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    (('0x' || substr(md5('{SEED}' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5e0)
      / 4503599627370496e0 AS u
  FROM documents
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::BIGINT AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - {MAX_REPEATS} * coalesce(sum(source_size) OVER (
      ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, least(source_size::DOUBLE * {MAX_REPEATS}, max(level) OVER () * weight) AS target FROM levels
), shares AS (
  SELECT doc_id, size, u, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS share
  FROM docs JOIN targets t ON docs.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, floor(share) AS whole, CASE WHEN share > floor(share)
    THEN (u / (1 - u)) / ((share - floor(share)) / (1 - (share - floor(share)))) END AS rank
  FROM shares
), rest_0 AS (SELECT *, target - whole * source_size AS rest, FALSE AS picked FROM ranked){_passes_sql()}
SELECT doc_id, size, source_size, target, (size * (whole + picked::INT))::BIGINT AS taken FROM rest_{PASSES}
"""


@query("op2_mix_sources", _SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = mix(documents(spark, sf_dir))
    return mixture.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
