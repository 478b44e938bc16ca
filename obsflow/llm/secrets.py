"""Secret scans over a trigram inverted index (operator 6).

For each rule a Boolean query over trigrams is derived from its regular
expression: what every match must contain. The index has a posting (trigram,
document) for each trigram that some rule asks for; postings are intersected per
alternative of a rule, and only the documents that remain are searched with that
rule's expression. Rules whose expression demands no trigram search all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import documents
from obsflow.llm.registry import query

_MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of the pattern whose ``group`` has at least ``least`` characters.

    ``search`` finds the same matches as its second group, behind a first one,
    for a pattern whose plain search can take the square of a text's length.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    search: str | None = None


def _either_case(word: str) -> str:
    """ASCII letters in either case; ignoring case would also match letters beyond ASCII that fold to these."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

_PART = "[A-Za-z0-9_-]"
_JWT = rf"eyJ{_PART}+\.eyJ{_PART}+\.{_PART}+"
# At the start of a run of these characters alone, and only where the rest of a token stands behind the run.
_JWT_SEARCH = rf"(?<!{_PART})(?={_PART}++\.eyJ{_PART}++\.{_PART})({_PART}*?)({_JWT})"

# The first three kinds are the base, in their order. A run of 24 or more hexadecimal
# digits is a match of [0-9a-f]+ with 24 characters or more, since those matches are whole runs.
RULES = (
    Rule("assign", rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("jwt", _JWT, search=_JWT_SEARCH),
    Rule("pem", r"-----BEGIN (?:[A-Z ]* )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE = ("assign", "access", "hex")

_PEM = next(r.pattern for r in RULES if r.kind == "pem")
_BREAK = r"""(?:[\s>"',#*]|\\[nr])++"""
# After the header whatever stands before the end mark, unless another mark comes first. Without an
# end mark the header fields, the lines of base64 and a shorter last line.
_PEM_BLOCK = (
    _PEM
    + r"(?:[^-]*+(?:-(?!----(?:BEGIN|END)\x20)[^-]*+)*+-----END (?:[A-Z ]* )?PRIVATE KEY-----"
    + rf"|(?:(?:{_BREAK}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_BREAK}[A-Za-z0-9+/]{{24,}}+={{0,2}})++"
    + rf"(?:{_BREAK}(?:[A-Za-z0-9+/]+=+|[A-Za-z0-9+/]+(?=\s*+$|\x20*[\r\n]|\\[nr])))?)?)"
)
#: What is taken out of a text. A scan reports a private key by its header; here the key goes with it.
REDACTED = tuple(replace(r, pattern=_PEM_BLOCK) if r.kind == "pem" else r for r in RULES)


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams; every match contains all of one of them.

    An empty set among them means that matches need not contain any trigram.
    """
    strings, demanded = _demand(re._parser.parse(pattern))
    found = _both(demanded, _of_strings(strings) if strings is not None else [frozenset()])
    return [a for a in found if not any(b < a for b in found)]


def _of_strings(strings: set[str]) -> list[frozenset[str]]:
    return list({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _both(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    return list({x | y for x, y in product(a, b)})


def _demand(items) -> tuple[set[str] | None, list[frozenset[str]]]:
    """Of a sequence: all strings it matches (None if too many), and the trigrams it demands beside them."""
    run, demanded, whole = {""}, [frozenset()], True
    for item in items:
        strings, own = _demand_of(item)
        demanded = _both(demanded, own)
        if strings is not None and len(run) * len(strings) <= _MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
        else:
            demanded, run, whole = _both(demanded, _of_strings(run)), strings or {""}, False
    return (run, demanded) if whole else (None, _both(demanded, _of_strings(run)))


def _demand_of(item) -> tuple[set[str] | None, list[frozenset[str]]]:
    kind, value = str(item[0]), item[1]
    nothing = [frozenset()]
    if kind == "LITERAL":
        return {chr(value).lower()}, nothing
    if kind == "IN":
        if all(str(k) == "LITERAL" for k, _ in value):
            return {chr(v).lower() for _, v in value}, nothing
        return None, nothing
    if kind == "SUBPATTERN":
        return _demand(value[-1])
    if kind == "BRANCH":
        parts = [_demand(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts):
            return set().union(*(s for s, _ in parts)), nothing
        return None, [a for s, d in parts for a in (_both(d, _of_strings(s)) if s is not None else d)]
    if kind in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = value
        strings, demanded = _demand(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, nothing
        if low and strings is not None:
            return None, _both(demanded, _of_strings(strings))
        return None, demanded if low else nothing
    return None, nothing


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index (doc_id, trigram): which documents contain which of the trigrams, in whatever case."""
    lowered = docs.select("doc_id", F.lower("text").alias("text"))
    present = F.array_compact(F.array(*(F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select("doc_id", F.explode(present).alias("trigram"))


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, kinds): the documents whose postings fulfil the queries of rules that demand trigrams."""
    terms = [
        (rule.kind, number, trigram, place, (1 << len(alternative)) - 1)
        for rule in rules if not scans_fully(rule)
        for number, alternative in enumerate(trigram_query(rule.pattern))
        for place, trigram in enumerate(sorted(alternative))
    ]
    asked = docs.sparkSession.createDataFrame(terms, "kind string, alternative int, term string, place int, full long")
    index = postings(docs, sorted({t[2] for t in terms}))
    # The terms are those of the rules; the same few rows whatever the corpus.
    met = index.join(F.broadcast(asked), F.col("trigram") == F.col("term"))
    hits = met.groupBy("doc_id", "kind", "alternative", "full").agg(
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("found")
    )
    return hits.filter("found = full").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def scans_fully(rule: Rule) -> bool:
    return frozenset() in trigram_query(rule.pattern)


def _spans(rule: Rule, number: int) -> Column:
    """The rule's spans in ``text``, from left to right without overlap, in code points, the end exclusive.

    Splitting the text at the matches gives the stretches between them, so the
    places follow from lengths.
    """
    pattern = rule.search or rule.pattern
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(2)) if rule.search else whole
    measured = matches if rule.search else F.regexp_extract_all("text", F.lit(pattern), F.lit(rule.group))
    between = F.slice(F.split(F.col("text"), pattern, -1), 1, F.size(whole))
    steps = F.arrays_zip(between.alias("gap"), whole.alias("whole"), matches.alias("hit"), measured.alias("part"))
    empty = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")

    def add(done: Column, step: Column) -> Column:
        # The match is the end of what is searched for.
        end = done["at"] + F.length(step["gap"]) + F.length(step["whole"])
        start = end - F.length(step["hit"])
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        more = F.when(F.length(step["part"]) >= rule.least, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    found = F.aggregate(steps, first, add, lambda done: done["spans"])
    return F.when(F.regexp_like("text", F.lit(pattern)), found).otherwise(empty)


def find_secrets(docs: DataFrame, rules=RULES) -> DataFrame:
    """(row, text, spans) of every row of ``docs``; ``row`` holds its columns.

    ``spans`` is sorted by start, then kind as listed, with start and end in
    code points, the end exclusive. A null text counts as empty and has no
    spans. Rows that repeat an id, or have none, are searched each for itself;
    extra columns stay within ``row``; an empty table gives no rows. Texts are
    searched whole.
    """
    held = docs.select(F.struct("*").alias("row"))
    chosen = candidates(docs, rules).withColumnRenamed("doc_id", "candidate")
    met = held.join(chosen, F.col("row.doc_id").eqNullSafe(F.col("candidate")), "left").select(
        "row", F.coalesce("row.text", F.lit("")).alias("text"), "kinds"
    )
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    each = [
        _spans(r, n) if scans_fully(r) else F.when(F.array_contains("kinds", r.kind), _spans(r, n)).otherwise(none)
        for n, r in enumerate(rules)
    ]
    return met.select("row", "text", F.array_sort(F.concat(*each)).alias("spans"))


def redacted(docs: DataFrame, rules=REDACTED) -> DataFrame:
    """The rows of ``docs``, all columns, with every secret replaced by its kind in brackets.

    Of a private key the whole block is replaced, from its header to its end
    mark or, where that is missing, to the end of its lines of base64.
    Where spans overlap, the first one names what they cover together. A
    document without secrets stays as it is, a null text stays null; the column
    n_chars, if there is one, follows the text.
    """
    found = find_secrets(docs, rules)

    def step(done: Column, span: Column) -> Column:
        # substring counts from 1
        gap = F.substring(F.col("text"), done["at"] + 1, span["start"] - done["at"])
        apart = span["start"] >= done["at"]
        out = F.when(apart, F.concat(done["out"], gap, F.lit("["), span["kind"], F.lit("]"))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.when(F.size("spans") > 0, F.aggregate("spans", first, step, rest)).otherwise(F.col("row.text"))
    clean = found.select("row", text.alias("clean"), F.size("spans").alias("secrets"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("secrets") > 0, F.length("clean").cast(kind)).otherwise(F.col("row.n_chars"))
    return clean.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def _printed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _sql() -> str:
    def lists(rule: Rule, number: int) -> str:
        pattern = rule.pattern.replace("'", "''")
        return f"""regexp_extract_all(t, '{pattern}', 0) AS m{number},
    regexp_extract_all(t, '{pattern}', {rule.group}) AS g{number}, string_split_regex(t, '{pattern}') AS p{number}"""

    def spans(rule: Rule, number: int) -> str:
        start = f"""(coalesce(list_sum(list_transform(p{number}[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m{number}[1:i - 1], lambda x: length(x))), 0))::INT"""
        return f"""list_transform(list_filter(range(1, len(m{number}) + 1), lambda i: length(g{number}[i]) >= {rule.least}),
    lambda i: {{'start': {start}, 'number': {number}, 'end': ({start} + length(m{number}[i]))::INT, 'kind': '{rule.kind}'}})"""

    counts = ", ".join(f"len(list_filter(s, lambda x: x.kind = '{k}')) AS n_{k}" for k in BASE)
    text = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.start || ':' || x.end), ',')"
    return f"""
WITH found AS (
  SELECT doc_id, {", ".join(lists(r, n) for n, r in enumerate(RULES))}
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), joined AS (
  SELECT doc_id, list_sort(list_concat({", ".join(spans(r, n) for n, r in enumerate(RULES))})) AS s FROM found
)
SELECT doc_id, {counts}, sha256({text.format(f"list_filter(s, lambda x: x.number < {len(BASE)})")}) AS base_sha256,
  {text.format("s")} AS spans
FROM joined
"""


@query("op6_secret_scan", _sql())
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = _printed(F.filter("spans", lambda s: s["number"] < len(BASE)))
    return found.select(
        "row.doc_id", *(count(k) for k in BASE), F.sha2(base, 256).alias("base_sha256"), _printed(F.col("spans")).alias("spans")
    )
