import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsflow.llm import packing, registry
from tests.llm.helpers import doc_rows, doc_table, write_documents


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab '\n\t 1é.<|endoftext|>", max_size=80))
def test_ids_are_those_of_tokenizers(text):
    model = packing.encoder(packing.VOCABULARY)
    assert model.ids(text).tolist() == model.exact.encode(text, add_special_tokens=False).ids


def test_special_strings_and_long_words():
    model = packing.encoder(packing.VOCABULARY)
    assert [t.content for t in model.exact.get_added_tokens_decoder().values()] == list(packing.SPECIAL)
    for text in ("a <|endoftext|> b", "x" * 50_000, " " * 3000 + "\n" * 10):
        assert model.ids(text).tolist() == model.exact.encode(text, add_special_tokens=False).ids


def texts():
    dice = random.Random(4)
    return [" ".join(dice.choices(["one", "two", "drei", "quatre", ".\n"], k=dice.choice([1, 30, 700]))) for _ in range(150)]


def check_pieces(pieces, rows):
    """Every id in one piece, sequences without gaps, padding only where the rule allows."""
    model = packing.encoder(packing.VOCABULARY)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == {r[0] for r in rows}
    for doc_id, text, *_ in rows:
        ids = model.exact.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            own = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(own)
            at += p["length"]
        assert at == len(ids)
    for number, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 2048 or at < 2048 and at & (at - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_query_round_trip(spark, tmp_path):
    rows = doc_rows([*texts(), None, "", "long text " * 40_000], start=3)
    found = registry.queries()["op10_pack"](spark, write_documents(tmp_path, rows)).collect()
    check_pieces(found, rows)


def test_every_window_has_the_target_mix(spark):
    rows = [(i, t, "en", "abcd"[i % 4 if i % 3 else 0], 0) for i, t in enumerate(texts() * 3)]
    pieces = packing.pack(doc_table(spark, rows)).collect()
    total, windows = Counter(), {}
    for p in pieces:
        total[p["source"]] += p["length"]
        windows.setdefault(p["sequence_id"], Counter())[p["source"]] += p["length"]
    every = sum(total.values())
    full = [w for w in windows.values() if sum(w.values()) == 2048]
    assert len(full) > 40
    for window in full[1:-1]:
        for source, tokens in total.items():
            assert abs(window[source] - 2048 * tokens / every) <= 2 * packing.LEAST_SERVED


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.integers(1, 9000), min_size=1, max_size=7),
    st.lists(st.integers(1, 50), min_size=7, max_size=7) | st.none(),
    st.integers(8, 300), st.integers(1, 70),
)
def test_schedule_serves_every_token_once(totals, weights, window, least):
    schedule = packing.Schedule.of(totals, weights and weights[: len(totals)], window, least)
    cutter = packing.Sequences.of(sum(totals), window)
    queue = np.repeat(np.arange(len(totals)), 3)
    thirds = np.concatenate([np.diff(np.linspace(0, t, 4).astype(int)) for t in totals])
    first = np.concatenate([np.linspace(0, t, 4).astype(int)[:3] for t in totals])
    some = thirds > 0
    owner, start, length, number, offset = packing.cut(schedule, cutter, queue[some], first[some], thirds[some])
    places = np.sort(np.concatenate([np.arange(n) + cutter.start(np.array([s]))[0] + o for s, o, n in zip(number, offset, length)]))
    assert (places == np.arange(sum(totals))).all() and (length > 0).all()
    for doc, tokens in enumerate(thirds[some]):
        own = owner == doc
        assert (np.sort(start[own]) == np.append(0, np.cumsum(length[own][np.argsort(start[own])]))[:-1]).all()
        assert length[own].sum() == tokens


def test_many_sources_keep_their_proportions(spark, monkeypatch):
    """Sources beyond the queues of one schedule, in two levels of groups."""
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    rows = [(i, "one two drei " * 60, "en", f"s{i % 13:02}" if i % 26 else None, 0) for i in range(390)]
    for chosen in (None, {"s12": 4, None: 1}):
        found = packing.pack(doc_table(spark, rows), weights=chosen, sequence=256, least=8)
        pieces = found.withColumn("ids_crc32", F.crc32("ids")).collect()
        total, half = Counter(), Counter()
        end = sum(p["length"] for p in pieces)
        tokens = {p["doc_id"]: p["doc_tokens"] for p in pieces}
        assert len(tokens) == 390 and sum(tokens.values()) == end
        for p in pieces:
            total[p["source"]] += p["length"]
            half[p["source"]] += p["length"] * (256 * p["sequence_id"] + p["offset"] < end // 10)
        assert len(total) == 14
        if chosen is None:
            assert all(abs(half[s] - total[s] / 10) < 130 for s in total)
        else:
            plain = [half[s] for s in total if s != "s12"]
            assert max(plain) - min(plain) < 130 and 3 < half["s12"] / (sum(plain) / len(plain)) < 5


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.integers(1, 900), min_size=1, max_size=40), st.booleans(),
    st.integers(8, 100), st.integers(1, 40), st.integers(2, 5),
)
def test_nested_schedule_serves_every_token_once(totals, weighted, window, least, most):
    totals = np.array(sorted(totals, reverse=True), np.int64)
    schedule = packing.Nested.of(totals, np.arange(1, len(totals) + 1) if weighted else None, window, least, most)
    cutter = packing.Sequences.of(int(totals.sum()), window)
    queue = np.repeat(np.arange(len(totals)), 2)
    tokens = np.stack([totals // 2, totals - totals // 2], axis=1).ravel()
    first = np.stack([np.zeros_like(totals), totals // 2], axis=1).ravel()
    some = tokens > 0
    owner, start, length, number, offset = packing.cut(schedule, cutter, queue[some], first[some], tokens[some])
    places = np.sort(np.concatenate([np.arange(n) + cutter.start(np.array([s]))[0] + o for s, o, n in zip(number, offset, length)]))
    assert (places == np.arange(totals.sum())).all() and (np.diff(owner) >= 0).all()
    for doc, size in enumerate(tokens[some]):
        own = owner == doc
        assert (start[own] == np.append(0, np.cumsum(length[own]))[:-1]).all() and length[own].sum() == size


def test_sequences_are_padded_but_for_powers_of_two(spark):
    docs = doc_table(spark, doc_rows(texts()[:20]))
    pieces = packing.pack(docs, sequence=96)
    found = packing.sequences(pieces, sequence=96).collect()
    joined = b"".join(r["ids"][: 4 * r["tokens"]] for r in sorted(found, key=lambda r: r["sequence_id"]))
    assert len(joined) == 4 * pieces.agg(F.sum("length")).first()[0]
    assert all(len(r["ids"]) == 4 * (r["tokens"] if r["tokens"].bit_count() == 1 else 96) for r in found)


def test_weights_and_odd_rows(spark):
    rows = [(None, "a b c", None, None, 0), (None, None, None, None, 0), (5, "x " * 300, "en", "s", 0), (5, "x " * 300, "en", "s", 0)]
    docs = doc_table(spark, rows).withColumn("task", F.lit("t")).withColumn("queue", F.lit(1)).withColumn("ids", F.lit(2))
    for weights in (None, {"s": 1, None: 3}):
        pieces = packing.pack(docs, weights=weights, sequence=64).collect()
        tokens = Counter()
        for p in pieces:
            tokens[p["doc_id"]] += p["length"]
        assert tokens == {None: 5, 5: 2 * 302}
    assert packing.pack(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, weights={str(i): 1 for i in range(2000)})


@pytest.mark.parametrize("unit", [" ", "\n", "\t", "\r\n", " \n", "\u00a0", "a", "7", "!", "é", "漢", "a "])
def test_long_runs_of_every_class(unit):
    model = packing.Encoder(packing.VOCABULARY)
    for text in (unit * (2_000_000 // len(unit)), "x" + unit * 9000 + "y"):
        assert model.ids(text).tolist() == model.exact.encode(text, add_special_tokens=False).ids
