import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from obsflow.llm import languages, registry
from tests.llm import test_mixing, test_secrets, test_simhash
from tests.llm.helpers import doc_table, smallest_reachable, write_documents
from tests.llm.test_packing import check_pieces

WORDS = {"en": ["the", "house", "river", "walking"], "de": ["über", "straße", "gehen", "wald"], "fr": ["été", "garçon", "rivière", "leurs"]}


def rows():
    dice = random.Random(6)
    made = []
    for i in range(120):
        lang = dice.choice(list(WORDS))
        text = " ".join(dice.choices(WORDS[lang], k=dice.choice([20, 60, 200]))) + f" {lang}{i}"
        if i % 9 == 0:
            text += ' password = "hunter2hunter2" end'
        made.append((i, text, lang, f"s{i % 4}", len(text)))
    copies = [(200 + i, made[i][1], None, "s0", made[i][4]) for i in range(15)]
    odd = [(300, None, "en", "s1", 0), (301, "", None, "s1", 0), (302, "12 345 !!", "de", "s1", 9), (303, "щ" * 300, None, None, 300)]
    return made + copies + odd


def slow_stages(spark, table):
    """The rows after each of the first four stages."""
    known = languages.learn_from_documents(doc_table(spark, table))
    lang, score = known.predict([r[1] for r in table])
    kept = [r for r, l, s in zip(table, lang, score) if l != "und" and s >= languages.MIN_SCORE]
    yield kept
    fps = {r[0]: test_simhash.slow_fingerprint(r[1]) for r in kept}
    groups = smallest_reachable(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    kept = [r for r in kept if groups[r[0]] == r[0]]
    yield kept
    clean = []
    for doc, text, lang, source, size in kept:
        at, out = 0, ""
        for start, _, end, kind in test_secrets.slow_spans(text):
            if start >= at:
                out += text[at:start] + f"[{kind}]"
            at = max(at, end)
        out += text[at:]
        clean.append((doc, out, lang, source, len(out) if out != text else size))
    yield clean
    taken = {r[0]: r[4] // r[1] for r in test_mixing.slow_mix(clean)}
    yield [r for r in clean for _ in range(taken[r[0]])]


def test_stages_equal_brute_force(spark, tmp_path):
    table = rows()
    folder = write_documents(tmp_path, table)
    docs, before = corpus_pipeline.documents(spark, folder), None
    for (name, stage), expected in zip(corpus_pipeline.STAGES, slow_stages(spark, table)):
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert Counter(map(tuple, docs.collect())) == Counter(expected), name
        assert before is None or expected != before, f"{name} decides nothing here"
        before = expected
    assert not {300, 301, 302, 303} & {r[0] for r in before}


def test_one_row_of_each_group_passes(spark, tmp_path):
    """Copies as repeated rows, without ids, and under an id that has another text too."""
    one, two, three = ("the old house by the river was sold again", "a completely different set of words here", "third text")
    table = [(1, one), (1, one), (None, one), (2, one), (2, two), (2, two), (3, two), (None, three), (None, three), (4, None), (5, ""), (5, "")]
    docs = doc_table(spark, [(i, t, "en", f"s{n % 2}", n) for n, (i, t) in enumerate(table)]).withColumn("row_key", F.lit(1))
    found = corpus_pipeline.simhash_near_dedup(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    assert kept == sorted([(1, one), (2, two), (None, three), (4, None)], key=str)


def test_run_packs_what_is_left(spark, tmp_path):
    folder = write_documents(tmp_path, rows())
    *_, mixed = slow_stages(spark, rows())
    found = registry.queries()["pipeline"](spark, folder).collect()
    copies = Counter(r[0] for r in mixed)
    starts = Counter((r["doc_id"], r["start"]) for r in found if r["start"] == 0)
    assert {d: n for (d, _), n in starts.items()} == copies
    once = [r for r in mixed if copies[r[0]] == 1]
    tokens = Counter()
    for r in found:
        tokens[r["doc_id"]] += r["length"]
    assert all(tokens[r["doc_id"]] == copies[r["doc_id"]] * r["doc_tokens"] for r in found)
    assert once and len({r["sequence_id"] for r in found}) == max(r["sequence_id"] for r in found) + 1
    assert registry.oracle_sql().get("pipeline") is None


def test_stages_keep_extra_columns_and_take_empty_tables(spark, tmp_path):
    folder = write_documents(tmp_path, rows())
    docs = doc_table(spark, rows()).selectExpr("*", "'x' AS rank", "1 AS component_id", "2 AS row", "3 AS spans", "4 AS u")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns and found.count() > 0, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    assert corpus_pipeline.pack(spark, docs.limit(0), folder).count() == 0


def test_check_pieces_finds_gaps():
    try:
        check_pieces([], [(1, "a", None, None, 1)])
    except AssertionError:
        return
    raise AssertionError("a missing document goes unnoticed")
