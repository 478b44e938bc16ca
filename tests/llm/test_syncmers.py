import hashlib
import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsflow.llm import registry, syncmers
from tests.llm.helpers import doc_rows, doc_table, write_documents


def codes(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def slow_syncmers(text):
    """Anchors by definition: the least inner hash of the k-mer stands first or last."""
    found = []
    for i in range(len(text) - syncmers.KMER + 1):
        inner = syncmers._window_hashes(codes(text[i : i + syncmers.KMER]), syncmers.INNER).tolist()
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, int(syncmers._window_hashes(codes(text[i : i + syncmers.KMER]), syncmers.KMER)[0])))
    return found


def slow_fingerprint(text):
    first = {}
    for place, h in slow_syncmers(text):
        first.setdefault(h >> 32, place)
    if not first and text:
        first = {int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little") >> 32: 0}
    return sorted(first.items())[: syncmers.ANCHORS]


@given(st.lists(st.text(alphabet="abé \n", max_size=90), max_size=5))
def test_fingerprints_equal_the_plain_ones(texts):
    found = syncmers.anchors(texts)
    assert [[tuple(x) for x in f.tolist()] for f in found] == [slow_fingerprint(t) for t in texts]


def test_long_texts_in_pieces(monkeypatch):
    dice = random.Random(1)
    text = "".join(dice.choices("abcdef ", k=3000))
    whole = syncmers.anchors([text])[0]
    monkeypatch.setattr(syncmers, "_CHARS_AT_ONCE", 100)
    assert (syncmers.anchors([text])[0] == whole).all()
    assert [tuple(x) for x in whole.tolist()] == slow_fingerprint(text)


def test_one_repeated_passage_fills_no_front():
    text = "abcdefghijklmnop" * 3000 + "".join(random.Random(2).choices("qrstuv", k=500))
    assert [tuple(x) for x in syncmers.anchors([text])[0].tolist()] == slow_fingerprint(text)


def test_a_short_passage_is_found_in_long_texts():
    dice = random.Random(5)
    passage, one, other = ("".join(dice.choices("abcdefgh ", k=n)) for n in (300, 120_000, 120_000))
    a, b = syncmers.anchors([one[:70_000] + passage + one[70_000:], other[:9_000] + passage + other[9_000:]])
    shared = {h >> 32 for _, h in slow_syncmers(passage)}
    assert len(shared) > 40 and shared <= set(a["hash"].tolist()) & set(b["hash"].tolist())
    assert syncmers.likeness(a, b) >= 2 * len(shared) / (len(a) + len(b))


def test_a_few_changed_words_in_a_long_text_show():
    text = "".join(random.Random(6).choices("abcdefgh ", k=120_000))
    changed = text[:50_000] + "xyzzy" * 10 + text[50_050:]
    a, b = syncmers.anchors([text, changed])
    assert 0.99 < syncmers.likeness(a, b) < 1


def test_anchors_do_not_depend_on_context():
    passage = "".join(random.Random(3).choices("abcdefgh", k=200))
    alone = {h for _, h in slow_syncmers(passage)}
    assert alone <= {h for _, h in slow_syncmers("xx yy" + passage + "zz")}


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    found = []
    for i, row in enumerate(order):
        text, following = row[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        found.append((row[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), text, changed, following))
    return found


def check(found, rows):
    truth = {(d, n, s): (t, c, f) for d, n, s, t, c, f in expected(rows)}
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found} == set(truth)
    for r in found:
        text, changed, following = truth[r["doc_id"], r["n_chars"], r["edited_sha256"]]
        own, new, other = syncmers.anchors([text, changed, following])
        assert r["fingerprint"] == syncmers.printed(own) and r["edited_fingerprint"] == syncmers.printed(new)
        assert r["near_edited"] == syncmers.likeness(own, new) and r["near_next"] == syncmers.likeness(own, other)
        assert syncmers.read(r["fingerprint"]).tolist() == own.tolist()


def test_query_equals_brute_force(spark, tmp_path):
    dice = random.Random(7)
    texts = ["".join(dice.choices("abcde é\n", k=dice.choice([0, 3, 11, 12, 400]))) for _ in range(90)]
    rows = doc_rows([*texts, *texts[:9], None, "", "y" * 100_000])
    dice.shuffle(rows)
    check(registry.queries()["op5_fingerprints"](spark, write_documents(tmp_path, rows)).collect(), rows)


def test_ties_nulls_and_clashing_columns(spark):
    rows = [(3, "aaa"), (3, "bbb"), (3, "aaa"), (None, "ccc"), (None, None), (1, "z" * 30), (-5, "q" * 9)]
    docs = doc_table(spark, [(i, t, None, None, None) for i, t in rows])
    docs = docs.withColumn("range", F.lit("r")).withColumn("ends", F.lit(7)).withColumn("first_id", F.lit(0))
    check(syncmers.fingerprints(docs, ranges=5).collect(), rows)


def test_one_document_and_none(spark):
    docs = doc_table(spark, [(4, "abcdef", "en", "s", 6)])
    found = syncmers.fingerprints(docs).collect()
    assert [(r["edited_sha256"], r["near_next"]) for r in found] == [(hashlib.sha256(b"abcdab").hexdigest(), 1.0)]
    assert syncmers.fingerprints(docs.limit(0)).collect() == []


def test_likeness_of_corpus_documents(spark, sf_dir):
    found = syncmers.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("n_chars > 300").collect()
    near = sum(r["near_edited"] for r in found) / len(found)
    far = sum(r["near_next"] for r in found) / len(found)
    assert near > 0.55 and far < 0.2
    assert sum(r["near_edited"] > 0.35 for r in found) > 0.97 * len(found)
