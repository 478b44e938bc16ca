import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import random

from pyspark.sql import functions as F

from obsflow.llm import preferences, registry


def slow(rows):
    """By pair, from plain lists."""
    plain = lambda t: (t or "").replace("<|", "< |")
    sides = {}
    for conv, turn, role, text in rows:
        sides.setdefault(conv, []).append((turn, role, text))
    found = {}
    for pair in sorted({c // 2 for c in sides}):
        order = lambda t: [(x is not None, x or "" if not isinstance(x, int) else x) for x in t]
        a, b = (sorted(sides.get(2 * pair + k, []), key=order) for k in (0, 1))
        n = 0
        while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
            n += 1

        def render(turns):
            text, spans = "", []
            for _, role, said in turns:
                text += f"<|{plain(role)}|>\n"
                start = len(text)
                text += plain(said) + "<|end|>"
                if role == "assistant":
                    spans.append(f"{start}:{len(text)}")
                text += "\n"
            return text, ",".join(spans)

        own = [render(t[n:]) if t else (None, None) for t in (a, b)]
        found[pair] = (pair, n, render(a[:n])[0], *own[0], *own[1])
    return found


def conversations(seed=1):
    dice = random.Random(seed)
    rows = []
    for conv in range(60):
        if dice.random() < 0.1:
            continue
        for turn in range(dice.randrange(1, 6)):
            same = dice.random() < 0.7
            text = f"turn {turn} é" if same else f"own {conv} <|end|> ü"
            rows.append((conv, turn, "assistant" if turn % 2 else "user", text))
    rows += [(100, 0, None, None), (101, 0, None, None), (101, 1, "assistant", None), (102, 0, "assistant", "x" * 200_000)]
    return rows


def write(tmp_path, rows):
    names, kinds = ["conv_id", "turn", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()]
    table = pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
    pq.write_table(table, f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_query_equals_brute_force_and_its_sql(spark, tmp_path):
    rows = conversations()
    folder = write(tmp_path, rows)
    df = registry.queries()["op7_preference_pairs"](spark, folder)
    columns = ["pair_id", "n_common", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]
    assert df.columns == columns
    found = {r["pair_id"]: tuple(r) for r in df.collect()}
    assert found == slow(rows)
    assert max(r[1] for r in found.values()) > 1
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS FROM '{folder}/conversations.parquet'")
    cursor = duck.execute(registry.oracle_sql()["op7_preference_pairs"])
    assert [c[0] for c in cursor.description] == columns
    assert {r[0]: r for r in cursor.fetchall()} == found
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_masked_spans_hold_what_the_assistant_says(spark):
    rows = [(1, True, 0, "user", "q"), (1, True, 1, "assistant", "yes é"), (1, False, 0, "user", "q"), (1, False, 1, "assistant", "no")]
    r = preferences.format_preferences(spark.createDataFrame(rows, "pair_id long, chosen boolean, turn long, role string, text string")).first()
    for side, said in (("chosen", "yes é"), ("rejected", "no")):
        low, high = map(int, r[f"{side}_mask"].split(":"))
        assert r[side][low:high] == said + "<|end|>"
    assert r["prompt"] == "<|user|>\nq<|end|>\n"


def test_odd_rows(spark):
    rows = [(None, True, 0, "user", "x"), (1, None, 0, "user", "x"), (2, True, None, "user", "b"), (2, True, 0, "user", "a"),
            (2, True, 0, "user", "a"), (2, False, None, "user", "b")]
    turns = spark.createDataFrame(rows, "pair_id long, chosen boolean, turn long, role string, text string")
    turns = turns.withColumn("prompt", F.lit(1)).withColumn("turns", F.lit(2)).withColumn("a", F.lit(3))
    found = preferences.format_preferences(turns).collect()
    assert [(r["pair_id"], r["n_common"], r["chosen"].count("a<|end|>"), r["rejected"]) for r in found] == [(2, 1, 2, "")]
    assert preferences.format_preferences(turns.limit(0)).collect() == []
