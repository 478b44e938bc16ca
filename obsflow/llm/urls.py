"""URL filters by a tree of path templates (operator 8).

Rules decide the urls they fit. For the others, the paths of each host are read
as a tree, level by level: segments that vary become wildcards, and sibling
branches whose shares of blocked pages do not differ significantly become one
branch. Each path so gets a template, and a template whose labelled pages are
mostly blocked, smoothed towards allowing, is rejected. The labels are the
rules' own verdicts.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from obsflow.llm.common import staged
from obsflow.llm.registry import query

#: Levels of a path that are told apart; what is deeper is one wildcard.
DEPTH = 4
#: A segment with a smaller share of its siblings' pages is variable, where there are so many different ones.
RARE = 0.05
MANY = 10
#: Chi-square with one degree of freedom, 5 %.
DIFFERENT = 3.841
#: Purity starts from so many pages of which this share is blocked.
PRIOR_PAGES = 5.0
PRIOR_SHARE = 0.1
REJECT = 0.5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    Rule("net", "/", True),
    Rule("example.net", "/en/", False),
    Rule("example.com", "/de/", True),
    Rule("org", "/fr/", False),
)


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _by_rule(value, rules) -> Column:
    """The longest rule that fits host and path; null if none does."""
    found = F.lit(None)
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        own = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        found = F.when(own & F.col("path").startswith(rule.path), F.lit(value(rule))).otherwise(found)
    return found


def _wildcard(segment: str) -> Column:
    """The class of a variable segment, without regard to a file ending."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(stem.rlike("^[0-9]+$"), "{number}")
        .when(stem.rlike("^[0-9a-fA-F-]{8,}$"), "{hex}")
        .when(stem.rlike("[0-9]"), "{mixed}")
        .otherwise("{word}")
    )


def _merged(branches: DataFrame) -> DataFrame:
    """(host, prefix, token, branch): siblings in order of their blocked share, cut where a neighbour differs."""
    order = Window.partitionBy("host", "prefix").orderBy(F.col("blocked") / F.col("pages"), "token")
    pooled = (F.col("blocked") + F.col("blocked_before")) / (F.col("pages") + F.col("pages_before"))
    apart = F.col("blocked") / F.col("pages") - F.col("blocked_before") / F.col("pages_before")
    spread = pooled * (1 - pooled) * (1 / F.col("pages") + 1 / F.col("pages_before"))
    differs = F.coalesce((spread > 0) & (apart * apart > DIFFERENT * spread), F.lit(False))
    numbered = (
        branches.withColumns({f"{c}_before": F.lag(c).over(order) for c in ("pages", "blocked")})
        .withColumn("group", F.sum(differs.cast("int")).over(order))
    )
    # Siblings are few: at most 1 / RARE frequent segments or MANY others, and the wildcards.
    names = numbered.groupBy("host", "prefix", "group").agg(
        F.array_join(F.array_sort(F.collect_set("token")), "|").alias("branch")
    )
    return numbered.join(names, ["host", "prefix", "group"]).select("host", "prefix", "token", "branch")


def _level(paths: DataFrame, number: int) -> DataFrame:
    """Paths with one more segment of their template."""
    here = paths.withColumn("segment", F.get("segments", F.lit(number)))
    segments = here.filter("segment IS NOT NULL").groupBy("host", "prefix", "segment").agg(
        F.sum("pages").alias("pages"), F.sum("blocked").alias("blocked")
    )
    totals = segments.groupBy("host", "prefix").agg(F.sum("pages").alias("all_pages"), F.count(F.lit(1)).alias("different"))
    rare = (F.col("pages") < RARE * F.col("all_pages")) & (F.col("different") >= MANY)
    token = F.when(F.col("segment").rlike("[0-9]") | rare, _wildcard("segment")).otherwise(F.col("segment"))
    tokens = segments.join(totals, ["host", "prefix"]).withColumn("token", token)
    branches = tokens.groupBy("host", "prefix", "token").agg(
        F.sum("pages").alias("pages"), F.sum("blocked").alias("blocked")
    )
    known = tokens.select("host", "prefix", "segment", "token").join(_merged(branches), ["host", "prefix", "token"])
    joined = here.join(known, ["host", "prefix", "segment"], "left")
    prefix = F.concat("prefix", F.lit("/"), "branch")
    return joined.select(
        "host", "path", "segments", "pages", "blocked", "allowed", F.coalesce(prefix, "prefix").alias("prefix")
    )


def templates(urls: DataFrame, rules=RULES, depth: int = DEPTH) -> DataFrame:
    """(host, path, template, purity) of each host and path of ``urls`` (host, path)."""
    blocks = _by_rule(lambda r: int(r.block), rules)
    labelled = urls.select("host", "path", blocks.alias("label"))
    paths = labelled.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("label") == 1).alias("blocked"), F.count_if(F.col("label") == 0).alias("allowed"),
    ).select(
        "host", "path", F.filter(F.split("path", "/", -1), lambda s, i: i > 0).alias("segments"),
        "pages", "blocked", "allowed", F.lit("").alias("prefix"),
    )
    paths = staged(paths, "paths")
    for number in range(depth):
        paths = staged(_level(paths, number), "paths")
    deeper = F.when(F.size("segments") > depth, F.concat("prefix", F.lit("/**"))).otherwise(F.col("prefix"))
    paths = paths.withColumn("template", deeper)
    nodes = paths.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    purity = (F.col("blocked") + PRIOR_PAGES * PRIOR_SHARE) / (F.col("blocked") + F.col("allowed") + PRIOR_PAGES)
    rated = nodes.select("host", "template", purity.alias("purity"))
    return paths.select("host", "path", "template").join(rated, ["host", "template"])


def filter_urls(pages: DataFrame, rules=RULES, depth: int = DEPTH) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages`` (page_id, url; other columns are not looked at).

    A null url and one without ``://`` have an empty host and path, which form a
    template of their own. Rows that repeat, and rows without page_id, are pages
    like any other. Long paths are read whole; below ``depth`` levels they share
    a wildcard. An empty table gives no rows.
    """
    urls = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    judged = urls.join(templates(urls, rules, depth), ["host", "path"])
    rule = _by_rule(lambda r: r.name, rules)
    word = _by_rule(lambda r: "block" if r.block else "allow", rules)
    learned = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", rule.cast("string").alias("rule"), F.coalesce(word, learned).alias("verdict"), "template", "purity"
    )


def _sql() -> str:
    def by_rule(value) -> str:
        cases = "".join(
            f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {value(r)}"
            for r in sorted(RULES, key=lambda r: (-len(r.name), r.name))
        )
        return f"CASE{cases} END"

    levels = "".join(
        f""", here{i} AS (
  SELECT *, CASE WHEN len(segments) > {i} THEN segments[{i + 1}] END AS segment FROM level{i}
), segments{i} AS (
  SELECT host, prefix, segment, sum(pages)::BIGINT AS pages, sum(blocked)::BIGINT AS blocked FROM here{i}
  WHERE segment IS NOT NULL GROUP BY ALL
), tokens{i} AS (
  SELECT *, CASE WHEN regexp_matches(segment, '[0-9]')
      OR pages < {RARE} * sum(pages) OVER siblings AND count(*) OVER siblings >= {MANY} THEN
    CASE WHEN regexp_matches(stem, '^[0-9]+$') THEN '{{number}}' WHEN regexp_matches(stem, '^[0-9a-fA-F-]{{8,}}$') THEN '{{hex}}'
      WHEN regexp_matches(stem, '[0-9]') THEN '{{mixed}}' ELSE '{{word}}' END
    ELSE segment END AS token
  FROM (SELECT *, regexp_replace(segment, '\\.[A-Za-z]{{1,5}}$', '') AS stem FROM segments{i})
  WINDOW siblings AS (PARTITION BY host, prefix)
), branches{i} AS (
  SELECT host, prefix, token, sum(pages)::DOUBLE AS n, sum(blocked)::DOUBLE AS b FROM tokens{i} GROUP BY ALL
), before{i} AS (
  SELECT *, lag(n) OVER w AS n0, lag(b) OVER w AS b0 FROM branches{i} WINDOW w AS (PARTITION BY host, prefix ORDER BY b / n, token)
), groups{i} AS (
  SELECT *, sum(coalesce((b / n - b0 / n0) * (b / n - b0 / n0) > {DIFFERENT}
      * ((b + b0) / (n + n0) * (1 - (b + b0) / (n + n0)) * (1 / n + 1 / n0))
      AND (b + b0) / (n + n0) * (1 - (b + b0) / (n + n0)) * (1 / n + 1 / n0) > 0, FALSE)::INT)
    OVER (PARTITION BY host, prefix ORDER BY b / n, token) AS g
  FROM before{i}
), named{i} AS (
  SELECT host, prefix, token, string_agg(token, '|') OVER (PARTITION BY host, prefix, g ORDER BY token
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS branch FROM groups{i}
), level{i + 1} AS (
  SELECT h.host, h.path, h.segments, h.pages, h.blocked, h.allowed, coalesce(h.prefix || '/' || branch, h.prefix) AS prefix
  FROM here{i} h LEFT JOIN tokens{i} t ON h.host = t.host AND h.prefix = t.prefix AND h.segment = t.segment
    LEFT JOIN named{i} n ON t.host = n.host AND t.prefix = n.prefix AND t.token = n.token
)"""
        for i in range(DEPTH)
    )
    return f"""
WITH urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
      '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), labelled AS (
  SELECT *, {by_rule(lambda r: f"'{r.name}'")} AS rule, {by_rule(lambda r: int(r.block))} AS label FROM urls
), level0 AS (
  SELECT host, path, string_split(path, '/')[2:] AS segments, count(*) AS pages,
    count(*) FILTER (label = 1) AS blocked, count(*) FILTER (label = 0) AS allowed, '' AS prefix
  FROM labelled GROUP BY host, path
){levels}, templates AS (
  SELECT host, path, blocked, allowed, prefix || CASE WHEN len(segments) > {DEPTH} THEN '/**' ELSE '' END AS template
  FROM level{DEPTH}
), rated AS (
  SELECT host, path, template, (sum(blocked) OVER node + {PRIOR_PAGES * PRIOR_SHARE}::DOUBLE)
    / (sum(blocked) OVER node + sum(allowed) OVER node + {PRIOR_PAGES}::DOUBLE) AS purity
  FROM templates WINDOW node AS (PARTITION BY host, template)
)
SELECT page_id, host, path, rule,
  CASE label WHEN 1 THEN 'block' WHEN 0 THEN 'allow' ELSE CASE WHEN purity > {REJECT} THEN 'block' ELSE 'allow' END END AS verdict,
  template, purity
FROM labelled JOIN rated USING (host, path)
"""


@query("op8_url_filter", _sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
