"""Conversation structure repair by Wagner-Fischer target alignment (operator 13).

A conversation should read ``(s?(ua)+)?``: an optional system turn, then user
and assistant in turns. There is one such string of each feasible length, so a
conversation is aligned to each of them: a table of edit costs over rows and
letters still to come, kept to a band that the cost of a known repair allows
(Ukkonen). Of the cheapest repairs, traced back through the tables, the one whose
audit comes first in ASCII order is taken.

A conversation lies in one task, or where it is long, in slices over several:
the rows are dealt by ranges of their order. A slice is aligned from and to each
state of the grammar, and slices are joined state by state. No repair of equal
cost begins another one, so the least audit of the whole is made of least audits
of the parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import arrow_map, staged
from obsflow.llm.registry import query

# What edits cost, and what an undeleted truncated turn adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Turns that are aligned at a time; longer conversations are joined from such pieces.
PIECE = 256

# Faults of a turn.
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_FAULTS = {"blank": _BLANK, "duplicate": _DUPLICATE, "truncated": _TRUNCATED}

# States of the grammar: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = "start", "system", "user", "assistant"
STATES = (START, SYSTEM, USER, ASSISTANT)
FINAL = (START, ASSISTANT)
_NEXT = {START: "u", SYSTEM: "u", ASSISTANT: "u", USER: "a"}
_LAST = {USER: "u", ASSISTANT: "a"}

# Steps of a repair. An upper-case letter takes a turn, a lower-case one inserts; U and A give it that role.
_AUDIT = str.maketrans("UAua", "RRII")
_ROLES = {"U": "user", "A": "assistant", "u": "user", "a": "assistant"}

_FAR = 1 << 60


def _other(letter: str) -> str:
    return "a" if letter == "u" else "u"


@dataclass(frozen=True)
class Turn:
    """What the alignment needs of a turn: the first letter of its role, and its fault."""

    initial: str
    fault: int

    @property
    def keepable(self) -> bool:
        return self.fault in (_FINE, _TRUNCATED)

    @property
    def extra(self) -> int:
        return TRUNCATED if self.fault == _TRUNCATED else 0


Path = tuple[int, str, str]  # cost, audit, steps


def _incumbent(turns: list[Turn], entry: str, last: str) -> int:
    """The cost of a plain repair: faulty turns go, the others take the next letter, one insertion ends it."""
    cost, letter, before = 0, _NEXT[entry], _LAST.get(entry)
    for turn in turns:
        if turn.fault != _FINE:
            cost += DELETE
        else:
            cost += REROLE * (turn.initial != letter)
            before, letter = letter, _other(letter)
    if before == last:
        return cost
    return cost + (INSERT if letter == last else 2 * INSERT)


class Table:
    """Costs of aligning the turns from the i-th on to the last r letters of the alternation that ends in ``last``.

    Only cells that a repair of at most ``limit`` can pass are filled: r more
    turns than letters cost a deletion each, r more letters an insertion each.
    """

    def __init__(self, turns: list[Turn], last: str, limit: int):
        self.turns, self.last = turns, last
        n = len(turns)
        self.low = [max(0, n - i - limit // DELETE) for i in range(n + 1)]
        self.high = [n - i + limit // INSERT for i in range(n + 1)]
        self.cost = [[]] * n + [[INSERT * r for r in range(self.high[n] + 1)]]
        for i in range(n - 1, -1, -1):
            self.cost[i] = self._row(i)

    def _row(self, i: int) -> list[int]:
        turn, found = self.turns[i], []
        for r in range(self.low[i], self.high[i] + 1):
            best = DELETE + self.at(i + 1, r)
            if r:
                if found:
                    best = min(best, INSERT + found[-1])
                if turn.keepable:
                    best = min(best, self.taken(turn, r) + self.at(i + 1, r - 1))
            found.append(best)
        return found

    def letter(self, r: int) -> str:
        """The first of the last r letters."""
        return self.last if r % 2 else _other(self.last)

    def taken(self, turn: Turn, r: int) -> int:
        return turn.extra + REROLE * (turn.initial != self.letter(r))

    def at(self, i: int, r: int) -> int:
        return self.cost[i][r - self.low[i]] if self.low[i] <= r <= self.high[i] else _FAR

    def lengths(self, i: int, letter: str) -> Iterable[int]:
        """The feasible numbers of letters from the i-th turn on that begin with the given one."""
        return (r for r in range(max(1, self.low[i]), self.high[i] + 1) if self.letter(r) == letter)

    def steps(self, i: int, r: int) -> str:
        """The cheapest steps from a cell on whose audit comes first: D, then I, K and R."""
        found = []
        while i < len(self.turns) or r:
            cost = self.at(i, r)
            if i < len(self.turns) and cost == DELETE + self.at(i + 1, r):
                found.append("D")
                i += 1
                continue
            letter = self.letter(r)
            if r > self.low[i] and cost == INSERT + self.at(i, r - 1):
                found.append(letter)
            else:
                found.append("K" if self.turns[i].initial == letter else letter.upper())
                i += 1
            r -= 1
        return "".join(found)


def align(turns: list[Turn], entries: Iterable[str] = (START,), exits: Iterable[str] = FINAL) -> dict[tuple[str, str], Path]:
    """The best repair of a piece from each state it may be entered in to each it may be left in."""
    n = len(turns)
    deleted = (DELETE * n, "D" * n, "D" * n)
    system = [k for k, t in enumerate(turns) if t.initial == "s" and t.keepable]
    found: dict[tuple[str, str], Path] = {}
    for leave in exits:
        if leave in _LAST:
            limit = max(_incumbent(turns, e, _LAST[leave]) for e in entries)
            table = Table(turns, _LAST[leave], limit)
        for enter in entries:
            paths = [deleted] if enter == leave else []
            if enter == START and leave == SYSTEM:
                kept = [(DELETE * (n - 1) + turns[k].extra, "D" * k + "K" + "D" * (n - 1 - k)) for k in system]
                paths += [(cost, steps, steps) for cost, steps in kept]
            elif leave in _LAST:
                # (cost, leading steps, cell): from the first turn on, or from behind a kept system turn
                cells = [(table.at(0, r), "", 0, r) for r in table.lengths(0, _NEXT[enter])]
                if enter == START:
                    cells += [
                        (DELETE * k + turns[k].extra + table.at(k + 1, r), "D" * k + "K", k + 1, r)
                        for k in system for r in table.lengths(k + 1, "u")
                    ]
                least = min(c[0] for c in [*cells, *paths])
                traced = [lead + table.steps(i, r) for cost, lead, i, r in cells if cost == least]
                paths += [(least, steps.translate(_AUDIT), steps) for steps in traced]
            if paths:
                found[enter, leave] = min(paths)
    return found


def joined(before: dict[tuple[str, str], Path], after: dict[tuple[str, str], Path]) -> dict[tuple[str, str], Path]:
    """The best repairs of two pieces in a row."""
    found: dict[tuple[str, str], Path] = {}
    for (enter, middle), (cost, audit, steps) in before.items():
        for (start, leave), (more, audit_after, steps_after) in after.items():
            if start == middle:
                path = (cost + more, audit + audit_after, steps + steps_after)
                found[enter, leave] = min(found.get((enter, leave), path), path)
    return found


# Turns in order, and their slices.


def _order() -> list[Column]:
    """The order of turns: by number, null first, then by role, by digest of the text, and by repeat."""
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "copy")]


def _spoken() -> Column:
    return F.col("text").rlike(r"[^\x20\x09-\x0D]")


def light_turns(turns: DataFrame) -> DataFrame:
    """The turns without texts: (conv_id, turn, role, digest, copy, fault), a fault being the first that holds.

    A turn is a duplicate if its conversation has its role and text at an
    earlier place; where rows are equal in all columns, ``slices`` takes the first one
    as the earlier one.
    """
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    light = staged(
        turns.select(
            "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), "copy",
            F.when(~_spoken(), _BLANK).when(~ended, _TRUNCATED).otherwise(_FINE).alias("own"),
        ),
        "light-turns",
    )
    # With a digest that no two known texts share; only texts that repeat have a row here.
    place = F.struct("turn", "copy")
    repeated = (
        light.groupBy(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")))
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role", "digest")]
    later = F.coalesce(place > F.col("first"), F.lit(False))
    fault = F.when((F.col("own") != _BLANK) & later, _DUPLICATE).otherwise(F.col("own"))
    return light.join(repeated, same, "left").select("conv_id", "turn", "role", "digest", "copy", fault.alias("fault"))


_PATH = "struct<entry:string,exit:string,cost:bigint,audit:string,steps:string>"
_SLICE = (
    "conv_id bigint, part bigint, n bigint, first_turn bigint, last_turn bigint, least_turn bigint, turns bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, last_initial string, "
    f"paths array<{_PATH}>"
)
_SLICE_FIELDS = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("first_turn", pa.int64()),
        ("last_turn", pa.int64()), ("least_turn", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()),
        ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.string()),
        ("last_initial", pa.string()),
        ("paths", pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", pa.int64()),
                                      ("audit", pa.string()), ("steps", pa.string())]))),
    ]
)
_LEGAL = ("su", "ua", "au")


class Slice:
    """The turns of one conversation in one task, as they come; what is held is a piece of them and the paths so far."""

    def __init__(self, conv_id, part: int, entries: tuple[str, ...]):
        self.facts = dict.fromkeys(("n", "turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.facts |= dict.fromkeys(("first_turn", "last_turn", "least_turn", "first_initial", "last_initial"))
        self.facts |= {"conv_id": conv_id, "part": part}
        self.entries, self.held, self.paths, self.before = entries, [], None, None

    def add(self, turn, role: str, digest: str, copy: int, fault: int) -> None:
        facts, row = self.facts, (turn, role, digest, copy)
        if row == self.before and fault != _BLANK:
            fault = _DUPLICATE
        initial = role[:1]
        if facts["n"]:
            facts["illegal"] += facts["last_initial"] + initial not in _LEGAL
        else:
            facts["first_turn"], facts["first_initial"] = turn, initial
        if turn is not None:
            facts["turns"] += facts["least_turn"] is None or turn != facts["last_turn"]
            facts["least_turn"] = turn if facts["least_turn"] is None else facts["least_turn"]
            facts["last_turn"] = turn
        facts["last_initial"], self.before = initial, row
        facts["n"] += 1
        for name, number in _FAULTS.items():
            facts[name] += fault == number
        if len(self.held) == PIECE:
            self._fold(STATES)
        self.held.append(Turn(initial, fault))

    def _fold(self, exits: Iterable[str]) -> None:
        found = align(self.held, self.entries if self.paths is None else STATES, exits)
        self.paths = found if self.paths is None else joined(self.paths, found)
        self.held = []

    def record(self, open_ended: bool) -> dict:
        """``open_ended``: the conversation may go on in the next task."""
        self._fold(STATES if open_ended else FINAL)
        names = ("entry", "exit", "cost", "audit", "steps")
        return self.facts | {"paths": [dict(zip(names, (*key, *path))) for key, path in self.paths.items()]}


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, done = None, []
    for batch in batches:
        for row in batch.to_pylist():
            conv_id = row.pop("conv_id")
            part = row.pop("part")
            if current is None or current.facts["conv_id"] != conv_id:
                # Only the first conversation of a task may have begun in an earlier one.
                entries = STATES if current is None else (START,)
                if current is not None:
                    done.append(current.record(False))
                current = Slice(conv_id, part, entries)
            current.add(**row)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_SLICE_FIELDS)
            done = []
    if current is not None:
        yield pa.RecordBatch.from_pylist([current.record(True)], schema=_SLICE_FIELDS)


def slices(light: DataFrame) -> DataFrame:
    """A row per conversation and task: the counts of its turns there, and their best repairs between states."""
    keys = _order()
    ordered = light.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return arrow_map(
        ordered.select("conv_id", F.spark_partition_id().cast("bigint").alias("part"), "turn", "role", "digest", "copy", "fault"),
        _sliced, _SLICE,
    )


_AUDITED = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, steps string"
)


def _whole(parts: list[dict]) -> dict:
    """One conversation from its slices in order."""
    paths, found, before = None, dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), None
    turns = 0
    for part in parts:
        own = {(p["entry"], p["exit"]): (p["cost"], p["audit"], p["steps"]) for p in part["paths"]}
        paths = own if paths is None else joined(paths, own)
        for name in found:
            found[name] += part[name]
        turns += part["turns"]
        if before is not None:
            found["illegal"] += before["last_initial"] + part["first_initial"] not in _LEGAL
            turns -= part["first_turn"] is not None and part["first_turn"] == before["last_turn"]
        before = part
    known = [t for p in parts for t in (p["least_turn"], p["last_turn"]) if t is not None]
    gaps = max(known) - min(known) + 1 - turns if known else 0
    cost, audit, steps = min(path for (enter, leave), path in paths.items() if enter == START and leave in FINAL)
    return found | {"conv_id": parts[0]["conv_id"], "gaps": gaps, "cost": cost, "audit": audit, "steps": steps}


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("conv_id", pa.int64())]
    fields += [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = pa.schema([*fields, ("audit", pa.string()), ("steps", pa.string())])
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_whole(parts) for parts in batch.column("parts").to_pylist()], schema=schema)


def audits(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, steps) of every conversation of ``turns``.

    ``turns`` has conv_id, turn, role, text and ``copy``, which tells repeats of
    one row apart. ``steps`` is the repair that ``repaired`` carries out.

    Role and text are no nulls. Conversations without an id are one
    conversation; turns without a number come first and leave no gap. Turns of
    one number go by role, digest of the text and copy. A role without a
    letter, or with another one than s, u and a, cannot be kept. An audit is one
    text, so what is gathered of a conversation are its slices, a few letters
    per turn.
    """
    found = staged(slices(light_turns(turns)), "slices")
    columns = [c for c in found.columns if c != "conv_id"]
    gathered = found.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("parts"))
    named = F.transform("parts", lambda p: F.struct(F.col("conv_id"), *(p[c].alias(c) for c in columns)))
    return arrow_map(gathered.select(named.alias("parts")), _audited, _AUDITED)


_REPAIRED = "conv_id bigint, place bigint, role string, text string, step string"


def _carried_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, its steps first, then its turns in order."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("step", pa.string())]
    )
    steps, at, place, conv_id = "", 0, 0, None
    for batch in batches:
        out = []

        def emit(role: str, text: str, step: str) -> None:
            nonlocal place
            out.append({"conv_id": conv_id, "place": place, "role": role, "text": text, "step": step})
            place += 1

        def insert() -> None:
            nonlocal at
            while at < len(steps) and steps[at].islower():
                emit(_ROLES[steps[at]], "", "I")
                at += 1

        for row in batch.to_pylist():
            if row["steps"] is not None:
                steps, at, place, conv_id = row["steps"], 0, 0, row["conv_id"]
            else:
                step = steps[at]
                at += 1
                if step != "D":
                    emit(_ROLES.get(step, row["role"]), row["text"], "K" if step == "K" else "R")
            insert()
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, step) of every turn that a repair keeps, reroles or inserts.

    A task streams its conversations in order, so it holds the steps of one
    conversation, a letter per turn, and a batch of turns.
    """
    nothing = F.lit(None)
    rows = turns.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), "copy", "text", nothing.cast("string").alias("steps")
    )
    heads = audited.select(
        "conv_id", nothing.cast("bigint").alias("turn"), nothing.cast("string").alias("role"),
        nothing.cast("string").alias("digest"), nothing.cast("int").alias("copy"), nothing.cast("string").alias("text"), "steps",
    )
    # Without a role a head comes before all turns, numbered or not.
    keys = [F.col("conv_id"), F.col("role").isNotNull(), *_order()[1:]]
    streamed = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(*keys)
    return arrow_map(streamed.select("conv_id", "role", "text", "steps"), _carried_out, _REPAIRED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "repaired_sha256"]
    conv_id, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))
        for row_id, place, role, text in zip(*columns):
            if not place:
                if digest is not None:
                    done.append((conv_id, digest.hexdigest()))
                conv_id, digest = row_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        ids, hashes = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv_id], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=names
        )


def digests(mended: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations as ``repaired`` streams them, each in one piece and in order."""
    return arrow_map(mended, _hashed, "conv_id bigint, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` after a repeatable damage, with ``copy``; a null role or text is one space.

    By the checksum of conversation and turn (a null there is a space) one in
    twenty is dropped, emptied, stripped of its ends of sentences, repeated, or
    given to the user. A repeated row is damaged like its twin.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    code = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    copies = F.when(code == 0, F.array().cast("array<int>")).when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def repair(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The audit and the digest of the repair of ``turns``, a row for every conv_id of ``conversations``.

    Conversations without a turn have zeros, an empty audit and the digest of
    no text, as have those that keep no turn for the digest. Turns are as in
    ``audits``. Empty tables give no rows; other columns are not looked at.
    """
    audited = staged(audits(turns), "audits")
    hashes = digests(repaired(turns, audited)).select(F.col("conv_id").alias("id"), "repaired_sha256")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    known = audited.withColumnRenamed("conv_id", "of")
    return (
        conversations.select("conv_id").distinct()
        .join(known, F.col("conv_id").eqNullSafe(F.col("of")), "left")
        .join(hashes, F.col("conv_id").eqNullSafe(F.col("id")), "left")
        .select(
            "conv_id",
            *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(conversations), conversations)
