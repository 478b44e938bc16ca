"""Substring dedup by suffix automata of reference shards (operator 3).

A window is ``WINDOW`` consecutive words of one document. A word is removed if a
window that covers it also starts in a document with a smaller id.

The reference is the corpus itself, so streaming every document through the
automaton of every shard would cost the square of the corpus. Shards are
therefore cut by content: each window has an anchor, the least of its inner
``GRAM``-word groups in a fixed pseudo-random order, which depends on the window
alone. A run of windows around one anchor is a stretch of at most
``2 * WINDOW - GRAM`` words. Stretches are dealt to shards by anchor, so equal
windows always meet, and only stretches of the same anchor need to be matched.
A shard builds the suffix automaton of its stretches, in order of the smallest
document that has each, and streams the stretches through it: where the matching
statistic reaches ``WINDOW`` words, the state knows the first document with that
window. Per document the windows found are joined to maximal spans and removed.

An anchor that stands in very many different surroundings would crowd its shard.
Such anchors are found in a share of the documents before, and their windows are
dealt one by one, by their whole content, which equal windows share as well. What
the share misses changes how work is dealt, never which windows are found.

Shards hold a fixed share of the text, so their number grows with the corpus and
their automata do not. Equal stretches of one batch of documents travel once.
Stretches that are frequent in a batch travel without the list of their places;
their places are joined to the result by content instead, which Spark can split.
Both come from one reading of the documents and travel in one shuffle, since what
is frequent depends on the batch, and another job may cut its batches otherwise.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import WORD, arrow_map, documents, groups_of, int64, mixed, record_batch, staged
from obsflow.llm.registry import query

WINDOW = 13
GRAM = 3
#: Text per shard; its stretches take several times as much.
SHARD_BYTES = 2 << 20
#: An anchor with more different stretches than this, as estimated, is crowded.
CROWDED = 1 << 14
#: One in so many documents is looked at for crowded anchors.
SAMPLE = 100
#: Every task holds the hashes of the most crowded anchors, 8 MB at most; others lie in one shard as they are.
_MOST_CROWDED = 1 << 20
#: A stretch with more places than this in a batch is frequent.
LISTED = 8
_BYTES_AT_ONCE = 1 << 20
_FLUSH_BYTES = 8 << 20
_PLACES_AT_ONCE = 1 << 16
_NO_ID = np.iinfo(np.int64).max  # a document without id comes after all others
_BASE = 0x9E3779B97F4A7C15
_SHORT_GRAM = 4 * GRAM
_codec = pa.Codec("zstd", compression_level=3)


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash base and of its inverse modulo 2**64."""
    with np.errstate(over="ignore"):
        up, down = (
            np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, np.uint64(b), np.uint64)])
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        )
    return up, down


class Words:
    """The words of one or more documents in a row, joined by single spaces."""

    def __init__(self, counts: list[int], joined: bytes):
        self.joined = joined
        data = np.frombuffer(joined, np.uint8)
        spaces = np.flatnonzero(data == 32)
        self.starts, self.ends = np.r_[0, spaces + 1], np.r_[spaces, len(data)]
        size = 1 << max(21, int(len(data)).bit_length())
        up, self._down = _powers(size)
        with np.errstate(over="ignore"):
            self._sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)]
        self.counts = np.array(counts, np.int64)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of each text from a first to a last word; equal texts have equal hashes wherever they stand."""
        with np.errstate(over="ignore"):
            begin = self.starts[first]
            return mixed((self._sums[self.ends[last]] - self._sums[begin]) * self._down[begin])

    def stretches(self) -> tuple[np.ndarray, ...]:
        """(document, first window, windows, anchor word, anchor hash) of each run of windows with one anchor.

        Words are numbered through all documents, windows within theirs. Groups
        of short words are frequent in any language, so they come last in the order.
        """
        grams = np.arange(len(self.starts) - GRAM + 1)
        if len(grams) < WINDOW - GRAM + 1:
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
        hashes = self.hashes(grams, grams + GRAM - 1)
        length = self.ends[GRAM - 1 :] - self.starts[: len(grams)]
        order = hashes >> np.uint64(1) | (length < _SHORT_GRAM).astype(np.uint64) << np.uint64(63)
        anchor, span, width = grams, WINDOW - GRAM + 1, 1
        while width < span:
            step = min(width, span - width)
            left, right = anchor[:-step], anchor[step:]
            anchor, width = np.where(order[left] <= order[right], left, right), width + step
        begins = np.cumsum(self.counts) - self.counts
        owner = np.repeat(np.arange(len(self.counts)), self.counts)[: len(anchor)]
        whole = np.arange(len(anchor)) + WINDOW <= (begins + self.counts)[owner]
        change = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])]
        at = np.flatnonzero(change)
        sizes = np.diff(np.r_[at, len(anchor)])
        at, sizes = at[whole[at]], sizes[whole[at]]
        return owner[at], at, sizes, anchor[at], hashes[anchor[at]]


def _runs_of_words(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], Words]]:
    """The words of the texts: the texts' numbers, the number of the first word of each, and the words.

    A long text comes in parts that overlap by a window less one word.
    """
    split = [(k, w) for k, w in enumerate(t.split() for t in texts) if len(w) >= WINDOW]
    if sum(map(len, texts)) <= _BYTES_AT_ONCE:
        if split:
            yield [k for k, _ in split], [0] * len(split), Words([len(w) for _, w in split], b" ".join(b" ".join(w) for _, w in split))
        return
    for number, words in split:
        for first, last in groups_of((len(w) + 1 for w in words), _BYTES_AT_ONCE):
            part = words[first : last + WINDOW - 1]
            if len(part) >= WINDOW:
                yield [number], [first], Words([len(part)], b" ".join(part))


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A few texts at a time, about ``size`` bytes of them."""
    lengths = pc.binary_length(batch.column("text")).fill_null(0).to_pylist()
    for begin, end in groups_of(lengths, size):
        yield batch.slice(begin, end - begin)


@dataclass
class Stretches:
    """Stretches of some documents: columns of numbers, and the words that the byte places refer to."""

    joined: bytes
    columns: dict[str, np.ndarray]

    @classmethod
    def of(
        cls, words: Words, numbers: np.ndarray, firsts: np.ndarray, ids: np.ndarray, keys: np.ndarray, shards: int,
        crowded: np.ndarray,
    ):
        owner, at, sizes, anchor, hashes = words.stretches()
        single = np.isin(hashes, crowded)
        if single.any():
            which, nth = _repeat(np.where(single, sizes, 1))
            owner, anchor, hashes, single = owner[which], anchor[which], hashes[which], single[which]
            at, sizes = at[which] + np.where(single, nth, 0), np.where(single, 1, sizes[which])
        begins = (np.cumsum(words.counts) - words.counts)[owner]
        low, last = words.starts[at], at + sizes + WINDOW - 2
        high, content = words.ends[last], words.hashes(at, last)
        gram, gram_length = words.starts[anchor] - low, words.ends[anchor + GRAM - 1] - words.starts[anchor]
        return cls(words.joined, {
            "shard": (np.where(single, content, hashes) % np.uint64(shards)).astype(np.int64), "content": content,
            "low": low, "high": high, "windows": sizes,
            # The anchor of a window dealt by itself is all of it.
            "gram": np.where(single, 0, gram), "gram_length": np.where(single, high - low, gram_length),
            "doc": ids[numbers[owner]], "key": keys[numbers[owner]], "first": firsts[owner] + at - begins,
        })


def _stretches(batch: pa.RecordBatch, shards: int, crowded: np.ndarray) -> Iterator[Stretches]:
    texts = [t or b"" for t in batch.column("text").to_pylist()]
    ids = int64(batch.column("doc_id"), _NO_ID)
    keys = np.array([zlib.crc32(t) for t in texts], np.int64)
    for numbers, firsts, words in _runs_of_words(texts):
        yield Stretches.of(words, np.array(numbers), np.array(firsts), ids, keys, shards, crowded)


_BLOB = pa.schema([("shard", pa.int32()), ("contents", pa.binary()), ("numbers", pa.binary()), ("size", pa.int64())])
_PLACE = pa.schema([("content", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int64()), ("windows", pa.int32())])


_PLACES = ("content", "doc_id", "text_key", "first")


def _content_key(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)


class Batch:
    """Stretches gathered from some documents, equal ones together, sorted by shard."""

    def __init__(self, gathered: list[Stretches]):
        self.joined = [g.joined for g in gathered]
        run = np.repeat(np.arange(len(gathered)), [len(g.columns["doc"]) for g in gathered])
        columns = {name: np.concatenate([g.columns[name] for g in gathered]) for name in gathered[0].columns}
        order = np.lexsort((columns["first"], columns["key"], columns["doc"], columns["content"], columns["shard"]))
        self.run, self.columns = run[order], {name: c[order] for name, c in columns.items()}
        content, length = self.columns["content"], self.columns["high"] - self.columns["low"]
        new = np.r_[True, (content[1:] != content[:-1]) | (length[1:] != length[:-1])]
        self.begins = np.flatnonzero(new[: len(content)])
        self.counts = np.diff(np.r_[self.begins, len(content)])

    def _texts(self, groups: np.ndarray) -> list[bytes]:
        at = self.begins[groups]
        places = zip(self.run[at].tolist(), self.columns["low"][at].tolist(), self.columns["high"][at].tolist())
        return [self.joined[run][low:high] for run, low, high in places]

    def blobs(self) -> Iterator[pa.RecordBatch]:
        """A row for each shard: its stretches, and of each the anchor's place, the frequency mark and the places."""
        frequent = self.counts > LISTED
        listed = np.where(frequent, 1, self.counts)  # of a frequent one the place in the smallest document
        owner, nth = _repeat(listed)
        place = self.begins[owner] + nth
        doc, key, first = (self.columns[c][place] for c in ("doc", "key", "first"))
        shard = self.columns["shard"][self.begins]
        cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else np.zeros(0, np.int64)
        ends = np.r_[0, np.cumsum(listed)]
        rows = []
        for low, high in zip(cuts.tolist(), cuts[1:].tolist()):
            own, at = slice(low, high), self.begins[low:high]
            flat = slice(int(ends[low]), int(ends[high]))
            numbers = b"".join(x.tobytes() for x in (
                self.columns["gram"][at].astype("<u4"), self.columns["gram_length"][at].astype("<u4"),
                listed[own].astype("u1"), frequent[own].astype("u1"),
                doc[flat].astype("<i8"), key[flat].astype("<u4"), first[flat].astype("<i8"),
            ))
            texts = self._texts(np.arange(low, high))
            rows.append((int(shard[low]), _packed(b"\n".join(texts)), _packed(numbers), high - low))
        if rows:
            yield record_batch(_BLOB, *zip(*rows))

    def frequent(self) -> Iterator[pa.RecordBatch]:
        groups = np.flatnonzero(self.counts > LISTED)
        owner, nth = _repeat(self.counts[groups])
        content = np.array([_content_key(t) for t in self._texts(groups)], np.int64)
        place = self.begins[groups[owner]] + nth
        yield record_batch(
            _PLACE, content[owner], *(self.columns[c][place] for c in ("doc", "key", "first", "windows"))
        )

    def dealt(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The blobs, and the places of frequent stretches, which go to any shard but the one that would be hot.

        A row without contents has places; which shard it goes to follows from what it has.
        """
        yield from self.blobs()
        for places in self.frequent():
            for begin in range(0, places.num_rows, _PLACES_AT_ONCE):
                some = places.slice(begin, _PLACES_AT_ONCE)
                numbers = _packed(b"".join(int64(some.column(c)).astype("<i8").tobytes() for c in _PLACES))
                yield record_batch(_BLOB, [zlib.crc32(numbers) % shards], [None], [numbers], [some.num_rows])


def _repeat(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number as often as its count says, and the place within its repeats."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _codec.compress(data, asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return _codec.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


_ANCHORED = pa.schema([("anchor", pa.int64()), ("content", pa.int64())])


def _anchors(batches):
    for batch in batches:
        for texts in _slices(batch, _BYTES_AT_ONCE):
            for *_, words in _runs_of_words([t or b"" for t in texts.column("text").to_pylist()]):
                _, at, sizes, _, hashes = words.stretches()
                pairs = np.unique(np.stack([hashes, words.hashes(at, at + sizes + WINDOW - 2)]), axis=1)
                yield record_batch(_ANCHORED, *pairs.view(np.int64))


def crowded_anchors(docs: DataFrame, crowded: int = CROWDED, sample: int = SAMPLE) -> np.ndarray:
    """The hashes of anchors in more than ``crowded`` different stretches, judged by one in ``sample`` documents."""
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    different = arrow_map(some, _anchors, "anchor bigint, content bigint").distinct()
    counts = different.groupBy("anchor").count().filter(F.col("count") > crowded / sample)
    most = counts.orderBy(F.desc("count"), "anchor").limit(_MOST_CROWDED).select("anchor").toArrow()
    return int64(most.column("anchor").combine_chunks()).view(np.uint64)


def _gather(shards: int, what: str, crowded: np.ndarray = np.zeros(0, np.uint64)):
    def rows(batch: Batch) -> Iterator[pa.RecordBatch]:
        return batch.dealt(shards) if what == "dealt" else getattr(batch, what)()

    def step(batches):
        gathered, held = [], 0
        for batch in batches:
            for some in (s for texts in _slices(batch, _BYTES_AT_ONCE) for s in _stretches(texts, shards, crowded)):
                gathered.append(some)
                held += len(some.joined)
                if held > _FLUSH_BYTES:
                    yield from rows(Batch(gathered))
                    gathered, held = [], 0
        if gathered:
            yield from rows(Batch(gathered))

    return step


class SuffixAutomaton:
    """All substrings of the texts added; each state knows the first document that has its substrings."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def _state(self, following: dict, link: int, length: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of the substrings of ``q`` that follow ``p`` by a word."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes], document: int) -> None:
        """Adds a text; texts come in ascending order of document."""
        last = 0
        for word in words:
            following = self.next[last].get(word)
            if following is not None:
                last = self._split(last, word, following)
                continue
            state = self._state({}, 0, self.length[last] + 1, document)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._split(p, word, self.next[p][word])
            last = state

    def first_documents(self, words: list[bytes], window: int) -> Iterator[int | None]:
        """Streams a text; at the end of each window the first document that has it, None if none does."""
        state = matched = 0
        for place, word in enumerate(words, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            if place >= window:
                yield self.first[state] if matched >= window else None


class Shard:
    """The stretches dealt to one shard."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.by_anchor: dict[bytes, list[int]] = {}
        self.least: list[int] = []
        self.frequent: set[int] = set()
        self.places: list[np.ndarray] = []

    def add(self, contents: bytes, numbers: bytes, size: int) -> None:
        texts, data = _unpacked(contents).split(b"\n"), _unpacked(numbers)
        anchors = np.frombuffer(data, "<u4", 2 * size).reshape(2, size)
        counts = np.frombuffer(data, "u1", size, 8 * size).astype(np.int64)
        frequent = np.frombuffer(data, "u1", size, 9 * size)
        total, at = int(counts.sum()), 10 * size
        docs = np.frombuffer(data, "<i8", total, at)
        keys = np.frombuffer(data, "<u4", total, at + 8 * total)
        firsts = np.frombuffer(data, "<i8", total, at + 12 * total)
        least = np.minimum.reduceat(docs, np.cumsum(counts) - counts).tolist()
        own = []
        for text, begin, length, doc in zip(texts, *anchors.tolist(), least):
            number = self.number.get(text)
            if number is None:
                number = self.number[text] = len(self.least)
                self.least.append(doc)
                self.by_anchor.setdefault(text[begin : begin + length], []).append(number)
            elif doc < self.least[number]:
                self.least[number] = doc
            own.append(number)
        own = np.array(own)
        self.frequent.update(own[frequent > 0].tolist())
        listed = np.repeat(frequent == 0, counts)
        self.places.append(np.stack([np.repeat(own, counts), docs, keys, firsts])[:, listed])

    def first_documents(self) -> dict[int, list[int]]:
        """By stretch whose anchor has another one too: the first document of each of its windows."""
        texts = list(self.number)
        several = [n for numbers in self.by_anchor.values() if len(numbers) > 1 for n in numbers]
        automaton = SuffixAutomaton()
        for n in sorted(several, key=self.least.__getitem__):
            automaton.add(texts[n].split(), self.least[n])
        return {n: list(automaton.first_documents(texts[n].split(), WINDOW)) for n in several}


_VERDICT = pa.schema([
    ("content", pa.int64()), ("firsts", pa.list_(pa.int64())),
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int64()), ("mask", pa.int32()),
])


def _verdicts(shard: Shard) -> Iterator[pa.RecordBatch]:
    """The windows found elsewhere first: by place, and by content for frequent stretches.

    A mask has bit k for the k-th window of the stretch.
    """
    first = shard.first_documents()
    windows = np.array([t.count(b" ") + 2 - WINDOW for t in shard.number], np.int64)
    number, doc, key, start = np.concatenate(shard.places, axis=1)
    simple = np.ones(len(windows), bool)
    simple[list(first)] = False
    mask = np.where(simple[number] & (np.array(shard.least)[number] < doc), (1 << windows[number]) - 1, 0)
    for at in np.flatnonzero(~simple[number]).tolist():
        mask[at] = sum(1 << k for k, d in enumerate(first[int(number[at])]) if d < doc[at])
    some = np.flatnonzero(mask)
    nothing = [None] * len(some)
    yield record_batch(_VERDICT, nothing, nothing, doc[some], key[some], start[some], mask[some])
    if shard.frequent:
        texts, own = list(shard.number), sorted(shard.frequent)
        lists = [first.get(n) or [shard.least[n]] * int(windows[n]) for n in own]
        nothing = [None] * len(own)
        yield record_batch(_VERDICT, [_content_key(texts[n]) for n in own], lists, nothing, nothing, nothing, nothing)


def _places(numbers: bytes, size: int) -> pa.RecordBatch:
    """Places of frequent stretches as they were found, for the verdicts by content."""
    content, doc, key, first = np.frombuffer(_unpacked(numbers), "<i8").reshape(len(_PLACES), size)
    nothing = [None] * size
    return record_batch(_VERDICT, content, nothing, doc, key, first, nothing)


def _match(batches):
    shard, current = Shard(), None
    for batch in batches:
        for row in batch.to_pylist():
            if row["contents"] is None:
                yield _places(row["numbers"], row["size"])
                continue
            if current is not None and row["shard"] != current:
                yield from _verdicts(shard)
                shard = Shard()
            current = row["shard"]
            shard.add(row["contents"], row["numbers"], row["size"])
    if current is not None:
        yield from _verdicts(shard)


def repeated_windows(docs: DataFrame, shard_bytes: int = SHARD_BYTES, crowded: int = CROWDED, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text_key, first, mask): the windows of (doc_id, text) that start in a document with a smaller id too."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    anchors = crowded_anchors(docs, crowded, sample)
    blobs = arrow_map(docs, _gather(shards, "dealt", anchors), "shard int, contents binary, numbers binary, size bigint")
    dealt = blobs.repartition("shard").sortWithinPartitions("shard")
    verdicts = staged(
        arrow_map(
            dealt, _match,
            "content bigint, firsts array<bigint>, doc_id bigint, text_key bigint, first bigint, mask int",
        ),
        "verdicts",
    )
    places = verdicts.filter("content IS NOT NULL AND firsts IS NULL").select(*_PLACES)
    bits = F.aggregate(
        F.sequence(F.lit(0), F.size("firsts") - 1), F.lit(0),
        lambda done, k: done + F.when(F.col("firsts")[k] < F.col("doc_id"), F.pow(F.lit(2), k).cast("int")).otherwise(0),
    )
    frequent = verdicts.filter("firsts IS NOT NULL").select("content", "firsts")
    joined = places.join(frequent, "content").withColumn("mask", bits)
    columns = ["doc_id", "text_key", "first", "mask"]
    return verdicts.filter("content IS NULL").select(columns).union(joined.select(columns)).filter("mask <> 0")


def covered(n_words: int, first: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which words the found windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for k in range(int(mask.max(initial=0)).bit_length()):
        begin = first[mask >> k & 1 == 1] + k
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + WINDOW, -1)
    return np.cumsum(edge)[:-1] > 0


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _remove(batches):
    for whole in batches:
        for batch in _slices(whole, 2 * _BYTES_AT_ONCE):
            places = batch.column("places")
            ends = np.r_[0, np.cumsum(int64(places.value_lengths()))]
            first, mask = (int64(places.flatten().field(c)) for c in ("first", "mask"))
            counts, removed, kept = [], [], []
            for number, text in enumerate(batch.column("text").to_pylist()):
                words = (text or b"").split()
                own = slice(ends[number], ends[number + 1])
                gone = covered(len(words), first[own], mask[own])
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(words, (~gone).tolist())))
            yield record_batch(_KEPT, batch.column("doc_id"), counts, removed, kept)


def without_repeats(
    docs: DataFrame, shard_bytes: int = SHARD_BYTES, crowded: int = CROWDED, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs`` (doc_id, text; other columns are not looked at).

    ``kept`` has the words that stay, joined by one space, as UTF-8. Windows are
    judged on the input, not on what is left. A null text has no words. Rows of
    one doc_id never remove from each other, whether their texts are equal or
    not; a row without id comes after all that have one. An empty table gives no
    rows. Texts are read whole, however long.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    found = repeated_windows(rows, shard_bytes, crowded, sample)
    # Copies of a row find the same places, so a place is gathered once, however many rows repeat.
    once = found.groupBy("doc_id", "text_key", "first").agg(F.bit_or("mask").alias("mask"))
    per_text = once.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "mask")).alias("places"))
    per_text = per_text.withColumnsRenamed({"doc_id": "id", "text_key": "key"})
    own = (F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("id")) & (F.crc32("text") == F.col("key"))
    joined = rows.join(per_text, own, "left").select("doc_id", "text", "places")
    return arrow_map(joined, _remove, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")


_SQL = f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS window_text
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split WHERE len(words) >= {WINDOW})
), found AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY window_text) < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS place FROM found
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), kept AS (
  SELECT p.doc_id, count(*) FILTER (g.place IS NOT NULL) AS n_removed,
    string_agg(word, ' ' ORDER BY p.place) FILTER (g.place IS NULL) AS kept
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


@query("op3_substring_dedup", _SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
