import hashlib
import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from obsflow.llm import mixing, registry
from tests.llm.helpers import doc_table, write_documents


def slow_targets(sizes, max_repeats=3):
    """Rounds of sharing until no source is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, stopped = sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in stopped}
        total = sum(rest.values())
        share = {s: left * w / total for s, w in rest.items()}
        above = [s for s in rest if share[s] > max_repeats * sizes[s]]
        if not above:
            return stopped | share
        for s in above:
            stopped[s] = max_repeats * sizes[s]
            left -= stopped[s]


def slow_mix(rows):
    size = {r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    sources = {}
    for r in rows:
        sources[r[3]] = sources.get(r[3], 0) + size[r]
    targets, found = slow_targets(sources), []
    for source, total in sources.items():
        share = targets[source] / total if total else 0.0
        whole = math.floor(share)
        own = [r for r in rows if r[3] == source]
        picked = set()
        chance = share - whole

        def rank(r):
            u = (int(hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return (u / (1 - u)) / (chance / (1 - chance))

        rest = targets[source] - whole * total
        for number in range(mixing.PASSES if chance > 0 else 0):
            passed = 0
            for r in sorted((r for r in own if r not in picked and size[r] <= rest), key=lambda r: (rank(r), r[0] or -1)):
                if passed + (size[r] / 2 if number == mixing.PASSES - 1 else size[r]) > rest:
                    break
                passed += size[r]
                picked.add(r)
            rest -= passed
        found += [(r[0], size[r], total, targets[source], size[r] * (whole + (r in picked))) for r in own]
    return found


def rows(n=120):
    texts = ["w " * (i * 37 % 50 + 1) for i in range(n)] + [None, "", "x\x85y\tz q", "b " * 5000]
    names = ["a", "b", "c", "d", "é", "z", None, "empty"]
    return [(i, t, "en", names[i % 7 if i % 11 else 0], 0) for i, t in enumerate(texts)] + [(999, "", "en", "empty", 0)]


def as_sorted(found):
    return sorted(((r[0] is None, r[0] or 0, r[1], r[2], round(r[3], 6), r[4]) for r in found))


def test_query_equals_brute_force_and_its_sql(spark, tmp_path):
    folder = write_documents(tmp_path, rows())
    found = [tuple(r) for r in registry.queries()["op2_mix_sources"](spark, folder).collect()]
    assert as_sorted(found) == as_sorted(slow_mix(rows()))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    sql = duck.execute(registry.oracle_sql()["op2_mix_sources"]).fetchall()
    assert sorted(sql) == sorted(found)


def test_sources_of_some_fifty_documents_come_near_their_targets(spark):
    mixture = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    by = mixture.groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")
    )
    for r in by.collect():
        assert abs(r["taken"] - r["target"]) <= 0.02 * r["target"] and r["most"] <= 3


@pytest.mark.parametrize("sizes", [{"a": 5}, {"a": 1, "b": 1000, "c": 10}, {"a": 0, "b": 0}, {None: 7, "b": 9, "a": 900}])
def test_targets(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    assert found == pytest.approx(slow_targets(sizes))


def tied_rows():
    """A third of the rows without id, equal or not, repeated rows, and one id with many texts."""
    equal = [(None, "w " * 10, "en", "hot", 0)] * 300
    several = [(None, "v " * (1 + i % 7), "en", "hot", 0) for i in range(150)]
    repeats = [(7, "r " * 12, "en", "b", 0)] * 90 + [(8, "", "en", "b", 0)] * 20
    one_id = [(5, f"{i} " * (1 + i % 4), "en", None, 0) for i in range(80)]
    others = [(100 + i, "o " * (i * 37 % 50 + 1), "en", ("hot", "b", "c", None)[i % 4], 0) for i in range(300)]
    return equal + several + repeats + one_id + others


@pytest.mark.parametrize("bits", [2, 12])
def test_rows_that_tie_at_a_cut_are_taken_one_by_one(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(mixing, "_BLOCK_BITS", bits)
    folder = write_documents(tmp_path, tied_rows())
    found = [tuple(r) for r in registry.queries()["op2_mix_sources"](spark, folder).collect()]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    sql = duck.execute(registry.oracle_sql()["op2_mix_sources"]).fetchall()
    assert as_sorted(found) == as_sorted(sql)
    taken, target = {}, {}
    for _, size, total, aim, words in found:
        taken[total] = taken.get(total, 0) + words
        target[total] = aim
    assert len(taken) == 4
    assert all(abs(taken[t] - target[t]) <= 30 for t in taken)


def test_the_hot_group_alone(spark):
    """Equal rows without id beside other documents, as many as the target has room for."""
    rows = [(None, "w " * 10, "en", "a", 0)] * 300 + [(i, "x " * 10, "en", "b", 0) for i in range(300)]
    mixture = mixing.mix(doc_table(spark, rows)).groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("rows")
    )
    for r in mixture.collect():
        assert r["rows"] == 300 and abs(r["taken"] - r["target"]) <= 5


def test_odd_rows(spark):
    docs = doc_table(spark, [(None, "a b", None, None, 1), (None, "a b", None, None, 1), (1, None, None, "s", 0), (1, "x", None, "s", 0)])
    docs = docs.withColumn("size", F.lit("extra")).withColumn("copies", F.lit(1)).withColumn("target", F.lit(None))
    mixture = mixing.mix(docs)
    assert mixture.count() == 4
    assert mixture.agg(F.sum("copies")).first()[0] >= 2
    again = mixing.repeated(mixture)
    assert again.columns == docs.columns and set(again.select("size").distinct().collect()) == {("extra",)}
    assert mixing.mix(docs.limit(0)).collect() == []
    assert mixing.repeated(mixing.mix(docs.limit(0))).collect() == []
