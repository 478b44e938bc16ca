import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import languages, registry
from tests.llm.helpers import doc_table


@pytest.fixture(scope="module")
def found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    return registry.queries()["op9_language_id"](spark, sf_dir).join(docs, "doc_id").collect()


def test_held_out_accuracy(found):
    unseen = [r for r in found if r["held_out"]]
    assert len(unseen) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) / len(unseen) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_whole_tables_are_answered(spark, sf_dir, found):
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(50).select("id", languages.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def slow_sets(rows, usual=0.0):
    """By language: the n-grams that two documents have, as plain sets."""
    sets = {}
    for text, lang in rows:
        padded = "   " + "".join(c.lower() if c.isalpha() else "\0" for c in text) + "   "
        padded = padded.replace(" ", "\0")
        grams = {padded[i : i + 4] for i in range(len(padded) - 3)} - {"\0" * 4}
        for g in grams:
            sets.setdefault(lang, {}).setdefault(g, []).append(1)
    return {lang: {g for g, n in found.items() if len(n) >= 2} for lang, found in sets.items()}


def test_counts_are_those_of_exact_sets_but_for_wrong_positives(spark):
    dice = random.Random(2)
    words = {"aa": ["mont", "älig", "Ord"], "bb": ["kiru", "zo", "wexa"], "cc": ["mont", "zo", "ilni"]}
    rows = [(" ".join(dice.choices(w, k=30)) + " 1.", lang) for lang, w in words.items() for _ in range(6)]
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(rows)], "doc_id long, text string, lang string")
    known = languages.learn(docs, usual=0.0)
    assert known.languages == ("aa", "bb", "cc")
    texts = ["mont älig xyzq", "zo zo ilni", "kiru, kiru", None, "123"]
    total, counted = known.counts(texts)
    sets = slow_sets(rows)
    for k, text in enumerate(texts):
        padded = "\0\0\0" + "".join(c.lower() if c.isalpha() else "\0" for c in text or "") + "\0\0\0"
        grams = [g for g in (padded[i : i + 4] for i in range(len(padded) - 3)) if g.strip("\0")]
        assert total[k] == len(grams)
        for l, lang in enumerate(known.languages):
            exact = sum(g in sets[lang] for g in grams)
            assert exact <= counted[k][l] <= exact + 1
    lang, score = known.predict(texts)
    assert lang == ["aa", "cc", "bb", "und", "und"] and score[3] == score[4] == 0


def test_long_texts_in_pieces_count_like_whole_ones(monkeypatch):
    text = "Abc dé fgh. " * 50
    whole = [np.concatenate([h for _, h, _ in languages.grams([text])])]
    monkeypatch.setattr(languages, "_CHARS_AT_ONCE", 7)
    assert (np.concatenate([h for _, h, _ in languages.grams([text])]) == whole[0]).all()
    assert list(languages.grams([])) == []


def test_runs_of_texts_count_like_single_ones():
    known = languages.LanguageFilter(("a", "b"), languages.mixed(np.arange(1 << 18, dtype=np.uint64))[None, :])
    texts = ["one two", None, "", "drei", "x", "12", "vier fünf" * 9]
    total, counted = known.counts(texts)
    for k, text in enumerate(texts):
        t, c = known.counts([text])
        assert t[0] == total[k] and (c[0] == counted[k]).all()


def test_nothing_learned_and_odd_rows(spark):
    docs = doc_table(spark, [(1, None, None, None, None), (None, "abc", "en", None, 3), (2, "", "en", None, 0)])
    docs = docs.withColumn("found", F.lit(1)).withColumn("score", F.lit("s"))
    nothing = languages.learn(docs.filter("lang = 'xx'"))
    assert {tuple(r) for r in languages.identify(docs, nothing).collect()} == {
        (1, "und", 0.0), (None, "und", 0.0), (2, "und", 0.0)
    }
    known = languages.learn(docs)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in languages.identify(docs, known).collect()}
    assert found[1] == found[2] == ("und", 0.0) and found[None][0] == "en"
    assert [r["doc_id"] for r in languages.in_a_language(docs, known).collect()] == [None]
    assert languages.identify(docs.limit(0), known).collect() == []
    assert languages.in_a_language(docs, known).columns == docs.columns


def test_more_than_64_languages(spark):
    rows = [(3 * n + k, f"{chr(0x4E00 + n)}{chr(0x5E00 + n)} " * 5, f"l{n:03}") for n in range(70) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = languages.learn(docs)
    lang, _ = known.predict([r[1] for r in rows])
    assert lang == [r[2] for r in rows]
