"""Mixture-controlled packing by deficit round-robin (operator 10).

Documents become token ids and queue up by source. Window after window every
queue is served its share of the window; what a window cannot give in whole
tokens, or what is less than ``LEAST_SERVED``, stays as that queue's deficit and
is served later. When a queue is empty, the others share its part. The served
tokens follow one another without gaps and are cut into sequences.

How much of each queue has been served after any window is a formula of the
window's number and the totals per source. So a task finds the places of its
documents from their token numbers within their source alone: deficits carry
over all windows and partitions, and nothing is served one after the other.

Where there are more sources than one schedule holds, the smaller ones lie in
groups. A group is a queue whose tokens its sources give by a schedule of their
own, and so on, so every source keeps its proportion.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obsflow.llm.common import arrow_map, documents, groups_of, int64, record_batch, staged
from obsflow.llm.registry import query

SEQUENCE = 2048
#: A queue's turn waits until its deficit has grown to so many tokens.
LEAST_SERVED = 64
END_ID = 1
PAD_ID = 0
#: One schedule has so many queues at most; where there are more sources, the smaller ones take turns in groups.
MAX_QUEUES = 1024
VOCABULARY = "byte_bpe_50k"
# Fixed value: the special token of that vocabulary.
SPECIAL = ("<|endoftext|>",)
_FRACTION = 28
_CHARS_AT_ONCE = 1 << 20
# From the start of a run on, so that the search takes one pass.
_LONG_SPACE = re.compile(r"(?<!\s)\s{8192}")
#: What a task keeps of the schedules of groups.
_KEPT_BYTES = 64 << 20
_CELLS_AT_ONCE = 1 << 18


class Encoder:
    """Token ids of a text, as ``tokenizers`` gives them for the JSON vocabulary.

    The same vocabulary and split pattern run several times as fast in
    ``tiktoken``, which gives the same ids for text without special tokens;
    texts that contain one go to ``tokenizers``. So do texts with a long run of
    white space, at which the former's regular expressions run out of stack.
    """

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.dtype = np.dtype("<u2") if len(ranks) + len(SPECIAL) <= 1 << 16 else np.dtype("<u4")

    @cached_property
    def exact(self) -> Tokenizer:
        """Loaded where a text needs it: it takes some 100 MB of a worker's memory."""
        return Tokenizer.from_file(public_tokenizers.path(f"{self.vocabulary}.json"))

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in SPECIAL) or _LONG_SPACE.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, self.dtype)
        return np.array(self.fast.encode_ordinary(text), self.dtype)


@lru_cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _encode(vocabulary: str, end_id: int):
    schema = pa.schema([
        ("task", pa.int32()), ("doc_id", pa.int64()), ("source", pa.string()),
        ("doc_tokens", pa.int64()), ("first", pa.int64()), ("ids", pa.binary()),
    ])

    def step(batches):
        model, task, queued = encoder(vocabulary), TaskContext.get().partitionId(), {}
        for batch in batches:
            docs, sources, texts = (batch.column(n) for n in ("doc_id", "source", "text"))
            lengths = pc.utf8_length(texts).fill_null(0).to_pylist()
            for begin, end in groups_of(lengths, _CHARS_AT_ONCE):
                names = sources.slice(begin, end - begin).to_pylist()
                ids = [np.append(model.ids(t.as_py() or ""), model.dtype.type(end_id)) for t in texts.slice(begin, end - begin)]
                first = []
                for name, own in zip(names, ids):
                    first.append(queued.get(name, 0))
                    queued[name] = first[-1] + len(own)
                yield record_batch(
                    schema, [task] * len(ids), docs.slice(begin, end - begin), names, [len(x) for x in ids], first,
                    [x.tobytes() for x in ids],
                )

    return step


@dataclass(frozen=True)
class Schedule:
    """What each queue has been served after each round; queues are numbered.

    Phases end when a queue runs empty. Within a phase a queue's quota per
    round is a whole number and a fraction of 2**-28 tokens.
    """

    totals: np.ndarray  # by queue
    rounds: np.ndarray  # by phase
    base: np.ndarray  # served before the phase, by phase and queue; a last row has the totals
    quota: np.ndarray  # in 2**-28 tokens, by phase and queue
    every: np.ndarray  # rounds between two turns, by phase and queue

    @classmethod
    def of(cls, totals: list[int], weights: list[int] | None = None, window: int = SEQUENCE, least: int = LEAST_SERVED):
        weights = [max(1, w) for w in (weights or totals)]
        served, rounds, base, quota = [0] * len(totals), [], [], []
        while any(s < t for s, t in zip(served, totals)):
            active = [s < t for s, t in zip(served, totals)]
            share = sum(w for w, a in zip(weights, active) if a)
            quotas = [max(1, (window << _FRACTION) * w // share) if a else 0 for w, a in zip(weights, active)]
            length = 1 + min((t - s << _FRACTION) // q for s, t, q in zip(served, totals, quotas) if q)
            base.append(served)
            quota.append(quotas)
            rounds.append(length)
            served = [min(t, s + (length * q >> _FRACTION)) for s, t, q in zip(served, totals, quotas)]
        size = (len(rounds), len(totals))
        quota = np.array(quota, np.int64).reshape(size)
        every = -(-(least << _FRACTION) // np.maximum(quota, 1))
        return cls(
            np.array(totals, np.int64), np.array(rounds, np.int64),
            np.array([*base, totals], np.int64).reshape(size[0] + 1, size[1]), quota, np.maximum(every, 1),
        )

    def _due(self, phase, queue, turn):
        """Tokens due by a round, whether or not the queue has its turn then."""
        quota, kind = self.quota[phase, queue], np.int64
        whole, part = quota >> kind(_FRACTION), quota & kind((1 << _FRACTION) - 1)
        return np.minimum(self.base[phase + 1, queue], self.base[phase, queue] + turn * whole + (turn * part >> kind(_FRACTION)))

    def _offset(self, phase, queue):
        """Queues with the same distance between turns take them in different rounds."""
        return (queue * 7919) % self.every[phase, queue]

    def served(self, phase, queue, turn):
        every, offset = self.every[phase, queue], self._offset(phase, queue)
        last = np.maximum((turn + offset) // every * every - offset, 0)
        return self._due(phase, queue, np.where(turn >= self.rounds[phase], self.rounds[phase], last))

    def turn_of(self, phase, queue, token):
        """The round of the phase in which a token is served."""
        quota = np.maximum(self.quota[phase, queue], 1) / (1 << _FRACTION)
        turn = np.maximum(((token - self.base[phase, queue]) / quota).astype(np.int64) - 1, 1)
        while True:
            early = (self._due(phase, queue, turn) <= token) & (turn < self.rounds[phase])
            if not early.any():
                break
            turn = turn + early
        every, offset = self.every[phase, queue], self._offset(phase, queue)
        return np.minimum(-(-(turn + offset) // every) * every - offset, self.rounds[phase])

    def place(self, phase, queue, turn, token):
        """The token's place in the stream of all served tokens."""
        at = token - self.served(phase, queue, turn - 1)
        if len(at) < len(self.totals) and len(at) * len(self.totals) <= _CELLS_AT_ONCE:
            others = np.arange(len(self.totals))[:, None]
            before = self.served(phase, others, turn - 1)
            more = np.where(others < queue, self.served(phase, others, turn) - before, 0)
            return at + before.sum(axis=0) + more.sum(axis=0)
        for other in range(len(self.totals)):
            before = self.served(phase, other, turn - 1)
            at += before
            earlier = other < queue
            at[earlier] += self.served(phase[earlier], other, turn[earlier]) - before[earlier]
        return at

    def runs(self, queue: np.ndarray, first: np.ndarray, tokens: np.ndarray):
        """Of documents that lie at ``first`` in their queue, what is served at once: document, start, length, place."""
        end = first + tokens
        bounds = self.base[1:, :]  # where phases end, by queue

        def phase_of(token):
            found = np.zeros(len(token), np.int64)
            for q in np.unique(queue):
                own = queue == q
                found[own] = np.searchsorted(bounds[:, q], token[own], side="right")
            return found

        low, high = phase_of(first), phase_of(end - 1)
        owner, nth = _repeat(high - low + 1)
        phase, q = low[owner] + nth, queue[owner]
        begin, stop = np.maximum(first[owner], self.base[phase, q]), np.minimum(end[owner], self.base[phase + 1, q])
        some = begin < stop
        owner, phase, q, begin, stop = owner[some], phase[some], q[some], begin[some], stop[some]

        turn, last, every = self.turn_of(phase, q, begin), self.turn_of(phase, q, stop - 1), self.every[phase, q]
        i, nth = _repeat(-(-(last - turn) // every) + 1)
        phase, q, turn = phase[i], q[i], np.minimum(turn[i] + nth * every[i], self.rounds[phase[i]])
        upto = np.minimum(stop[i], self.served(phase, q, turn))
        since = np.maximum(begin[i], self.served(phase, q, turn - 1))
        some = since < upto
        i, phase, q, turn, since, upto = i[some], phase[some], q[some], turn[some], since[some], upto[some]
        owner = owner[i]
        return owner, since - first[owner], upto - since, self.place(phase, q, turn, since)


@dataclass(frozen=True)
class Nested:
    """A schedule of any number of queues, which are numbered by size, the largest first.

    The first ones have a queue of the schedule each; the others lie in groups
    of neighbours, with a queue for each group.
    """

    totals: np.ndarray  # by queue
    weights: np.ndarray | None
    window: int
    least: int
    most: int  # queues of one schedule
    bounds: np.ndarray  # where groups begin, and the end of the last one
    schedule: Schedule
    kept: dict[int, Nested]

    @classmethod
    def of(cls, totals: np.ndarray, weights: np.ndarray | None = None, window: int = SEQUENCE, least: int = LEAST_SERVED, most: int = MAX_QUEUES):
        size = len(totals)
        groups = min(most, max(0, -(-(size - most) // (most - 1))))
        alone = most - groups if groups else size
        bounds = alone + (size - alone) * np.arange(groups + 1) // max(groups, 1)

        def summed(values):
            return [*values[:alone].tolist(), *(values[a:b].sum().item() for a, b in zip(bounds, bounds[1:]))]

        schedule = Schedule.of(summed(totals), None if weights is None else summed(weights), window, least)
        return cls(totals, weights, window, least, most, bounds, schedule, {})

    def group(self, number: int) -> Nested:
        if number not in self.kept:
            while sum(k.schedule.base.nbytes for k in self.kept.values()) * 3 > _KEPT_BYTES:
                self.kept.pop(next(iter(self.kept)))
            own = slice(*self.bounds[number : number + 2].tolist())
            weights = None if self.weights is None else self.weights[own]
            self.kept[number] = Nested.of(self.totals[own], weights, self.window, self.least, self.most)
        return self.kept[number]

    def runs(self, queue: np.ndarray, first: np.ndarray, tokens: np.ndarray):
        """As those of a schedule."""
        group = np.searchsorted(self.bounds, queue, side="right") - 1
        if len(self.bounds) == 1 or (group < 0).all():
            return self.schedule.runs(queue, first, tokens)
        alone = np.flatnonzero(group < 0)
        parts = [(alone, np.zeros(len(alone), np.int64), tokens[alone], first[alone], queue[alone])]
        for number in np.unique(group[group >= 0]).tolist():
            own = np.flatnonzero(group == number)
            owner, start, length, place = self.group(number).runs(queue[own] - self.bounds[number], first[own], tokens[own])
            parts.append((own[owner], start, length, place, np.full(len(owner), self.bounds[0] + number)))
        owner, start, length, first, queue = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((start, owner))
        owner, start, length, first, queue = (c[order] for c in (owner, start, length, first, queue))
        part, begin, length, place = self.schedule.runs(queue, first, length)
        return owner[part], start[part] + begin, length, place


def _repeat(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number as often as its count says, and the place within its repeats."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass(frozen=True)
class Sequences:
    """The stream cut into sequences: whole ones, and a tail whose lengths are powers of two."""

    starts_of_tail: np.ndarray
    whole: int
    length: int

    @classmethod
    def of(cls, total: int, length: int = SEQUENCE):
        whole, rest = divmod(total, length)
        sizes = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        return cls(whole * length + np.cumsum([0, *sizes])[: len(sizes)].astype(np.int64), whole, length)

    def number(self, place):
        tail = self.whole + np.searchsorted(self.starts_of_tail, place, side="right") - 1
        return np.where(place < self.whole * self.length, place // self.length, tail)

    def start(self, number):
        tail = np.append(self.starts_of_tail, 0)[np.clip(number - self.whole, 0, len(self.starts_of_tail))]
        return np.where(number < self.whole, number * self.length, tail)


def cut(schedule: Schedule | Nested, sequences: Sequences, queue: np.ndarray, first: np.ndarray, tokens: np.ndarray):
    """The pieces of documents that lie at ``first`` in their queue: document, start, length, sequence, offset."""
    if not len(queue):
        return (np.zeros(0, np.int64),) * 5
    owner, start, length, place = schedule.runs(queue, first, tokens)
    number, final = sequences.number(place), sequences.number(place + length - 1)
    i, nth = _repeat(final - number + 1)
    number = number[i] + nth
    here = np.maximum(place[i], sequences.start(number))
    until = np.where(number == final[i], place[i] + length[i], sequences.start(number + 1))
    return owner[i], start[i] + (here - place[i]), until - here, number, here - sequences.start(number)


def _pieces(schedule: Nested, sequences: Sequences):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ])

    def step(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            queue, first, tokens = (int64(batch.column(n)) for n in ("queue", "first", "doc_tokens"))
            for begin, end in groups_of(tokens.tolist(), _CHARS_AT_ONCE):
                own = slice(begin, end)
                owner, start, length, number, offset = cut(schedule, sequences, queue[own], first[own], tokens[own])
                some = batch.slice(begin, end - begin)
                # A document's pieces follow one another, so their ids are the documents' ids in a row.
                data = b"".join(some.column("ids").to_pylist())
                ids = np.frombuffer(data, f"<u{len(data) // int(tokens[own].sum())}").astype("<u4")
                ends = np.append(0, np.cumsum(length) * 4).astype(np.int32)
                values = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                take = pa.array(owner)
                yield record_batch(
                    schema, some.column("doc_id").take(take), some.column("source").take(take), start, length,
                    tokens[own][owner], number, offset, values,
                )

    return step


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    weights: dict[str | None, int] | None = None,
    sequence: int = SEQUENCE,
    least: int = LEAST_SERVED,
) -> DataFrame:
    """The pieces of all documents of ``docs`` (doc_id, source, text; other columns are not looked at).

    Columns: doc_id, source, start (tokens of the document before the piece),
    length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit integers,
    little-endian). ``weights`` are the target proportions of the sources, by
    default their shares of all tokens, so that every window has the corpus'
    mix and all queues end together; a source without a weight has the weight 1.
    Sources may be any number. The driver and each task hold 8 bytes for each.

    A null or empty text is one end token. Every row is a document of its own,
    also one without id or with an id seen before. A null source is a queue of
    its own. An empty table gives no rows. Within its source a document's place
    follows the order in which the files were read.
    """
    if weights and len(weights) > MAX_QUEUES:
        raise ValueError(f"weights for more than {MAX_QUEUES} sources")
    encoded = staged(
        arrow_map(
            docs.select("doc_id", "source", "text"), _encode(vocabulary, END_ID),
            "task int, doc_id bigint, source string, doc_tokens bigint, first bigint, ids binary",
        ),
        "encoded", compression="zstd",
    )
    parts = encoded.groupBy("task", "source").agg(F.sum("doc_tokens").alias("tokens"))
    sources = parts.groupBy("source").agg(F.sum("tokens").alias("all_tokens"))
    rank = F.row_number().over(Window.orderBy(F.desc("all_tokens"), F.asc_nulls_last("source")))
    numbered = sources.select(F.col("source").alias("name"), (rank - 1).alias("queue"))
    queued = parts.join(numbered, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    before = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    placed = staged(queued.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))), "queues")
    queues = placed.groupBy("queue", "source").agg(F.sum("tokens").alias("tokens")).orderBy("queue")
    rows = queues.select("tokens", *(["source"] if weights else [])).toArrow().combine_chunks()
    totals = int64(rows.column("tokens").combine_chunks())
    chosen = np.array([max(1, weights.get(s, 0)) for s in rows.column("source").to_pylist()], np.int64) if weights else None
    schedule = Nested.of(totals, chosen, sequence, least, MAX_QUEUES)
    at = encoded.join(
        placed.select(F.col("task").alias("t"), F.col("source").alias("s"), "queue", "base"),
        (F.col("task") == F.col("t")) & F.col("source").eqNullSafe(F.col("s")),
    ).select("doc_id", "source", "queue", (F.col("base") + F.col("first")).alias("first"), "doc_tokens", "ids")
    return arrow_map(
        at, _pieces(schedule, Sequences.of(int(totals.sum()), sequence)),
        "doc_id bigint, source string, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary",
    )


def sequences(pieces: DataFrame, sequence: int = SEQUENCE, pad_id: int = PAD_ID) -> DataFrame:
    """(sequence_id, tokens, ids) of packed pieces, padded unless the tokens are a power of two."""
    sorted_pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), sorted_pieces.alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"]))
    power_of_two = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (sequence - F.col("tokens")).cast("int")))
    return whole.select("sequence_id", "tokens", F.when(power_of_two, joined).otherwise(F.concat(joined, pad)).alias("ids"))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op10_pack")
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(documents(spark, sf_dir)))
