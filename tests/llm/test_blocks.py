import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from obsflow.llm import blocks, registry
from tests.llm.helpers import doc_rows, doc_table, write_documents


def plain(rows):
    """Brute force over (doc_id, text, ...) rows: what stays of each group, for rows in any order."""
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows]
    groups = {}
    for r, t in zip(rows, texts):
        groups.setdefault(t, []).append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    best = {t: min(g) for t, g in groups.items()}
    found = []
    for r, t in zip(rows, texts):
        keep = None if best[t][1] else best[t][2]
        found.append((r[0], keep, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(found, key=str)


def texts(size):
    dice = random.Random(3)
    words = ["".join(dice.choices("abé𝒳 \n", k=size // 2)) for _ in range(4)]
    made = ["".join(dice.choices(words, k=dice.randrange(9))) for _ in range(120)]
    spaced = [" \t".join(t) for t in made[:30]]
    edges = ["x" * n for n in (size - 1, size, size + 1, 2 * size, 4 * size, 4 * size + 1)]
    return [*made, *spaced, *made[:20], *edges, *edges, None, "", " \r\n", " ", "ab", "a b", "a\x0bb", "y" * 50_000]


def digests(df):
    return sorted(
        ((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()), key=str
    )


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.length(c) % 2], ids=["hash", "colliding"])
def test_groups_equal_brute_force(spark, digest):
    rows = doc_rows(texts(8), start=5)
    found = blocks.exact_duplicates(doc_table(spark, rows).repartition(3), size=8, digest=digest)
    assert digests(found) == plain(rows)
    kept = found.filter("kept").collect()
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({e[3] for e in plain(rows)})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_query_equals_brute_force_and_its_sql(spark, tmp_path):
    rows = doc_rows([*texts(64), *("long " * n + "é" for n in (3000, 3000, 3001))], start=1)
    folder = write_documents(tmp_path, rows)
    df = registry.queries()["op12_block_naming_dedup"](spark, folder)
    assert digests(df) == plain(rows)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    assert sorted(duck.execute(registry.oracle_sql()["op12_block_naming_dedup"]).fetchall()) == sorted(map(tuple, df.collect()))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_names_stand_for_one_block_each(spark):
    docs = doc_table(spark, doc_rows(["abcdabcd", "abcdxy", "a bcd", "xy", None]))
    names = [tuple(r) for r in blocks.name_blocks(docs, 4, lambda c: F.lit(7).cast("bigint")).collect()]
    assert sorted((c, n) for _, c, n in names) == sorted(zip(["", "abcd", "xy"], sorted(n for *_, n in names)))
    apart = blocks.name_blocks(docs, 4, F.xxhash64).collect()
    assert len(apart) == 3 and all(r["content"] is None for r in apart)


def test_odd_rows(spark):
    rows = [(None, "a b", "en", "s", 3), (None, "ab", "en", "s", 2), (4, "ab", "en", "s", 2), (4, "ab", "en", "s", 2),
            (9, "a b", "en", "s", 3), (None, None, None, None, None), (2, " ", "en", "s", 1)]
    clashing = doc_table(spark, rows).withColumns({c: F.lit("x") for c in ("row", "name", "parts", "digest", "kept", "chars")})
    found = blocks.exact_duplicates(clashing)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert digests(found) == plain(rows)
    assert sorted(r["doc_id"] for r in found.filter("kept").collect()) == [2, 9]
    same = doc_table(spark, rows[3:4] * 50)
    assert [r["kept"] for r in blocks.exact_duplicates(same).collect()].count(True) == 1
    assert blocks.exact_duplicates(clashing.limit(0)).collect() == []


def test_many_copies(spark):
    docs = doc_table(spark, doc_rows(["one text " * 900] * 400 + ["another"] * 3))
    assert sorted({(r["group_size"], r["keep_id"]) for r in blocks.exact_duplicates(docs).collect()}) == [(3, 400), (400, 0)]
