import hashlib
import random
import re
import zlib
from functools import cache

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from obsflow.llm import registry, repair
from obsflow.llm.repair import Turn

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(turns):
    """The cheapest repair by trying every step at every place, in a plain automaton; least audit among equals.

    ``turns``: (initial, fault). Gives cost, audit and what each step leaves: (turn or None, role or None).
    """

    @cache
    def best(i, state, inserted):
        found = []
        if i == len(turns) and state in ("start", "a"):
            found.append((0, "", ()))
        letter = "a" if state == "u" else "u"
        after = letter
        if inserted < 2:  # two in a row lead back to the same state
            cost, audit, kept = best(i, after, inserted + 1) or (None, None, None)
            if cost is not None:
                found.append((cost + 5, "I" + audit, ((None, letter), *kept)))
        if i < len(turns):
            initial, fault = turns[i]
            options = [(2, "D", state, None)]
            if fault not in (1, 2):
                extra = 5 if fault == 3 else 0
                if initial == letter:
                    options.append((extra, "K", after, (i, None)))
                else:
                    options.append((1 + extra, "R", after, (i, letter)))
                if initial == "s" and state == "start":
                    options.append((extra, "K", "s", (i, None)))
            for cost, name, to, kept in options:
                rest = best(i + 1, to, 0)
                if rest:
                    found.append((cost + rest[0], name + rest[1], ((kept,) if kept else ()) + rest[2]))
        return min(found, key=lambda f: f[:2]) if found else None

    for i in range(len(turns), 0, -50):  # from the end, or a long one would go too deep
        for state in ("start", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "start", 0)


def dice_turns(dice, n, initials="uuaas x"):
    return tuple((dice.choice(initials), dice.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_alignment_equals_trying_everything(seed):
    dice = random.Random(seed)
    for _ in range(60):
        turns = dice_turns(dice, dice.randrange(1, 9))
        found = repair.align([Turn(*t) for t in turns])
        assert min(found.values())[:2] == plain_repair(turns)[:2], turns


@pytest.mark.parametrize("piece", [1, 2, 3, 5])
def test_pieces_join_to_the_whole(piece):
    dice = random.Random(piece)
    for _ in range(60):
        turns = [Turn(*t) for t in dice_turns(dice, dice.randrange(2, 12))]
        parts = [turns[i : i + piece] for i in range(0, len(turns), piece)]
        paths = repair.align(parts[0], repair.STATES, repair.STATES)
        for part in parts[1:]:
            paths = repair.joined(paths, repair.align(part, repair.STATES, repair.STATES))
        whole = repair.align(turns, repair.STATES, repair.STATES)
        assert {k: v[:2] for k, v in paths.items()} == {k: v[:2] for k, v in whole.items()}


def test_bands_are_narrow():
    clean = [Turn("ua"[i % 2], 0) for i in range(400)]
    table = repair.Table(clean, "a", repair._incumbent(clean, repair.START, "a"))
    assert sum(map(len, table.cost)) == 401
    assert min(repair.align(clean).values())[:2] == (0, "K" * 400)


def plain_rows(rows):
    """The query over (conv_id, turn, role, text) rows, one conversation at a time."""
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        code = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        for copy in {0: (), 3: (0, 1)}.get(code, (0,)):
            digest = hashlib.sha256(text.encode()).hexdigest()
            convs[conv].append(((turn is not None, turn or 0), role, digest, copy, text))
    found = {}
    for conv, turns in convs.items():
        turns.sort()
        seen, judged = set(), []
        for _, role, _, _, text in turns:
            spoken = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not spoken else 2 if (role, text) in seen else 3 if spoken[-1] not in ".!?" else 0
            seen.add((role, text))
            judged.append((role[:1], fault))
        numbers = [t[0][1] for t in turns if t[0][0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit, kept = plain_repair(tuple(judged))
        names = {"u": "user", "a": "assistant"}
        lines = [
            f"{names[letter]}:" if i is None else f"{names[letter] if letter else turns[i][1]}:{turns[i][4]}"
            for i, letter in kept
        ]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        counts = [sum(j[1] == f for j in judged) for f in (1, 2, 3)]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (conv, gaps, *counts, illegal, cost, audit, sha)
    return sorted(found.values(), key=str)


def made(seed=2, convs=150):
    dice = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(dice.randrange(1, 9)):
            role = dice.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = dice.choice(["Hi.", "Hi.", "So it is!", "cut off", "Why? \n", " ", "", None, "end.\x85", "é.", f"{conv} {turn}."])
            rows.append((conv, dice.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rows = made()
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    arrays = [pa.array(list(c), type=k) for c, k in zip(columns, kinds)]
    pq.write_table(pa.Table.from_arrays(arrays, ["conv_id", "turn", "role", "text"]), tmp_path / "conversations.parquet")
    df = registry.queries()["op13_conversation_repair"](spark, str(tmp_path))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found_rows(df) == plain_rows(rows)


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found_rows(registry.queries()["op13_conversation_repair"](spark, sf_dir)) == plain_rows(rows)


def test_a_long_conversation_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dice = random.Random(9)
    long = [(7, t, dice.choice(["user", "assistant"]), dice.choice(["Hi.", f"{t}.", f"{t}.", f"{t}"])) for t in range(1800)]
    rows = [*long, *((c, t, "ua"[t % 2] + "x", f"{t}!") for c in (6, 8) for t in range(4))]
    conversations = table(spark, rows).repartition(5)
    turns = repair.damaged(conversations)
    try:
        sizes = [r["n"] for r in repair.slices(repair.light_turns(turns)).filter("conv_id = 7").collect()]
        assert len(sizes) > 1 and max(sizes) > repair.PIECE
        assert found_rows(repair.repair(turns, conversations)) == plain_rows(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "system", "Be kind."), (1, 3, "user", "So?"), (1, 5, "tool", "Yes.")]
    turns = table(spark, rows).withColumn("copy", F.lit(0))
    audited = repair.audits(turns)
    (audit,) = audited.drop("steps").collect()
    assert tuple(audit) == (1, 1, 0, 1, 0, 3, 5, "DDKKR")
    mended = repair.repaired(turns, audited).drop("conv_id", "place").collect()
    assert [tuple(r) for r in mended] == [("system", "Be kind.", "K"), ("user", "So?", "K"), ("assistant", "Yes.", "R")]


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (None, 2, "assistant", "b."), (3, 4, "user", "x" * 200_000 + "."),
            (5, 1, "user", "a."), (5, 1, "user", "a."), (5, 1, "assistant", "b."), (6, None, "user", "")]
    clashing = table(spark, rows).withColumns({c: F.lit("x") for c in ("copy", "digest", "fault", "part", "steps", "place", "n")})
    assert found_rows(repair.repair(repair.damaged(clashing), clashing)) == plain_rows(rows)
    same = table(spark, [(1, 1, "user", "Hi.")] * 300 + [(1, 2, "assistant", "Ho.")] * 5)
    turns = repair.damaged(same)
    (row,) = repair.repair(turns, same).collect()
    assert row["duplicate"] == turns.count() - turns.select("role", "text").distinct().count()
    empty = clashing.limit(0)
    assert repair.repair(repair.damaged(empty), empty).collect() == []
