import hashlib
import random
import re

from pyspark.sql import functions as F

from obsflow.llm import registry, substrings
from tests.llm.helpers import doc_rows, doc_table, write_documents


def slow(rows):
    """By row: words, removed words and kept text, from a dictionary of all windows."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    first = {}
    order = [float("inf") if r[0] is None else r[0] for r in rows]
    for doc, words in zip(order, split):
        for i in range(len(words) - 12):
            window = tuple(words[i : i + 13])
            first[window] = min(first.get(window, doc), doc)
    found = []
    for row, doc, words in zip(rows, order, split):
        gone = set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((row[0], len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def texts(seed, vocabulary="the of and to extraordinary é naturally x\x85y remarkable cat international".split()):
    dice = random.Random(seed)
    passages = [dice.choices(vocabulary, k=dice.choice([13, 14, 30, 60])) for _ in range(12)]
    found = []
    for _ in range(120):
        words = []
        for _ in range(dice.randrange(1, 6)):
            part = list(dice.choice(passages)) if dice.random() < 0.5 else [f"w{dice.randrange(10**6)}" for _ in range(dice.randrange(1, 40))]
            if dice.random() < 0.3 and len(part) > 2:
                part[dice.randrange(len(part))] = "changed"
            words += part[dice.randrange(3) :]
        found.append(dice.choice([" ", "\n", " \t"]).join(words))
    return [*found, *found[:15], None, "", " \n", "a b c", "same " * 400, "same " * 30, " ".join(passages[0])]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rows = doc_rows(texts(1))
    random.Random(2).shuffle(rows)
    expected = slow(rows)
    assert sum(r[2] for r in expected) > 1000
    assert as_rows(registry.queries()["op3_substring_dedup"](spark, write_documents(tmp_path, rows))) == sorted(expected, key=str)


def digest(df):
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s"))


def test_many_shards_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_BYTES_AT_ONCE", 200)
    monkeypatch.setattr(substrings, "_FLUSH_BYTES", 2000)
    rows = doc_rows(texts(3, "a bb ccc dddd eeeee ffffff".split()))
    assert as_rows(digest(substrings.without_repeats(doc_table(spark, rows), shard_bytes=500))) == sorted(slow(rows), key=str)


def test_frequent_passages_go_by_content(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = doc_rows([f"{passage} own{i} " + " ".join(f"t{i}-{k}" for k in range(20)) for i in range(60)] + [passage] * 60, start=5)
    table = doc_table(spark, rows).select("doc_id", F.col("text").cast("binary").alias("text")).coalesce(1)
    frequent = substrings.arrow_map(
        table, substrings._gather(1, "frequent"), "content bigint, doc_id bigint, text_key bigint, first bigint, windows int"
    )
    assert frequent.count() > 100
    assert as_rows(digest(substrings.without_repeats(table))) == sorted(slow(rows), key=str)


def test_batches_need_not_be_the_same_in_every_job(spark, tmp_path):
    """One partition while the windows are judged, one for each file when the result is read."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = doc_rows([f"{passage} own{i} " + " ".join(f"t{i}-{k}" for k in range(20)) for i in range(40)])
    for part in range(10):
        (tmp_path / f"{part}").mkdir()
        write_documents(tmp_path / f"{part}", rows[part::10])
    docs = spark.read.parquet(*(f"{tmp_path}/{part}/documents.parquet" for part in range(10)))
    files = {f"spark.sql.files.{name}": value for name, value in {"openCostInBytes": "0", "minPartitionNum": "1"}.items()}
    try:
        for name, value in files.items():
            spark.conf.set(name, value)
        assert docs.rdd.getNumPartitions() == 1
        found = substrings.without_repeats(docs)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        assert as_rows(digest(found)) == sorted(slow(rows), key=str)
    finally:
        for name in (*files, "spark.sql.files.maxPartitionBytes"):
            spark.conf.unset(name)


def test_crowded_anchors_go_window_by_window(spark):
    """A phrase that every document surrounds by other words, beside repeated passages."""
    dice, phrase = random.Random(4), [f"extraordinary{i}" for i in range(8)]
    made = [
        " ".join([f"a{dice.randrange(30)}" for _ in range(9)] + phrase + [f"b{dice.randrange(30)}" for _ in range(9)])
        for _ in range(150)
    ]
    rows = doc_rows(texts(7) + made + [f"{a} {b}" for a, b in zip(made, reversed(made))])
    docs = doc_table(spark, rows)
    binary = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    assert 0 < len(substrings.crowded_anchors(binary, 50, 1)) < len(substrings.crowded_anchors(binary, 0, 1))
    expected = sorted(slow(rows), key=str)
    for crowded in (50, 0):
        assert as_rows(digest(substrings.without_repeats(docs, 500, crowded, 1))) == expected


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(20))
    rows = [(3, words), (3, words), (3, words + " more"), (None, words), (None, words + " z"), (2, None), (9, "x " + words), (1, "w0")]
    docs = doc_table(spark, [(i, t, None, None, None) for i, t in rows])
    docs = docs.withColumn("first", F.lit(0)).withColumn("mask", F.lit("m")).withColumn("places", F.lit(None))
    assert as_rows(digest(substrings.without_repeats(docs))) == sorted(slow(rows), key=str)
    assert substrings.without_repeats(docs.limit(0)).collect() == []


def test_automaton_knows_the_first_document_of_each_window():
    dice = random.Random(9)
    docs = [[dice.choice([b"a", b"b", b"c"]) for _ in range(dice.randrange(30))] for _ in range(40)]
    automaton = substrings.SuffixAutomaton()
    for number, words in enumerate(docs):
        automaton.add(words, number)
    probe = [dice.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    for size in (1, 3, 5):
        for at, found in enumerate(automaton.first_documents(probe, size)):
            window = probe[at : at + size]
            having = [n for n, w in enumerate(docs) if any(w[i : i + size] == window for i in range(len(w) - size + 1))]
            assert found == (having[0] if having else None)


def test_corpus_documents_equal_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert as_rows(registry.queries()["op3_substring_dedup"](spark, sf_dir)) == sorted(slow(rows), key=str)


def test_many_rows_of_one_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(0, text, "en", "s", 1), *[(None, text, "en", "s", 1)] * 500, *[(7, text, "en", "s", 1)] * 500]
    docs = doc_table(spark, rows)
    found = substrings.without_repeats(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, found), key=str) == [(0, 300, 0, 1), (7, 300, 300, 500), (None, 300, 300, 500)]
    places = substrings.repeated_windows(docs.select("doc_id", F.col("text").cast("binary").alias("text")), substrings.SHARD_BYTES, substrings.CROWDED, substrings.SAMPLE)
    assert places.groupBy("doc_id", "text_key", "first").count().filter("count > 1").count() > 0
