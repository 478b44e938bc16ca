import random
import re

import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsflow.llm import registry, simhash
from tests.llm.helpers import doc_rows, doc_table, smallest_reachable, write_documents


def slow_fingerprint(text, shingle=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aB é\x85\t\x1c\n", max_size=60))
def test_fingerprint_equals_the_plain_one(text):
    assert simhash.simhash(text.encode(), 3) % 2**64 == slow_fingerprint(text)


def texts(seed=1):
    dice = random.Random(seed)
    bases = [" ".join(dice.choices("abcdefghijklmnopq", k=dice.choice([2, 40, 300]))) for _ in range(25)]
    near = [b + " " + dice.choice("xyz") for b in bases for _ in range(3)]
    return [*bases, *near, *bases[:5], None, "", " \n ", "A b C", "a B c", "x" * 100_000, "long " * 60_000]


def test_query_equals_brute_force(spark, tmp_path):
    rows = doc_rows(texts(), start=7)
    fps = {r[0]: slow_fingerprint(r[1]) for r in rows}
    groups = smallest_reachable(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert len(set(groups.values())) < len(set(fps.values()))
    found = registry.queries()["op4_simhash_near_dedup"](spark, write_documents(tmp_path, rows)).collect()
    assert sorted(map(tuple, found)) == sorted((i, f"{fps[i]:016x}", groups[i]) for i in fps)


def test_links_equal_brute_force_for_close_and_crowded_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 20)
    dice = random.Random(5)
    centres = [dice.getrandbits(64) for _ in range(4)]
    fps = [c ^ sum(1 << b for b in dice.sample(range(64), dice.randrange(7))) for c in centres for _ in range(60)]
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    table = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    found = {r["fp"]: r["component"] for r in simhash.fingerprint_components(table).collect()}
    expected = smallest_reachable(range(len(fps)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {signed[i]: c for i, c in expected.items()} == found


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "only without id here"), (3, None), (4, "")]
    docs = doc_table(spark, [(i, t, None, None, None) for i, t in rows]).withColumn("fp", F.lit("x"))
    docs = docs.withColumn("component_id", F.lit(9)).withColumn("node", F.lit(1)).withColumn("text_", F.lit(None))
    found = simhash.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == [(1, 1), (1, 1), (3, 3), (4, 3), (None, 1), (None, None)]
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 1, 3, None, None]


def test_empty_table(spark):
    assert simhash.near_duplicates(doc_table(spark, [])).collect() == []
    assert simhash.representatives(doc_table(spark, [])).collect() == []
