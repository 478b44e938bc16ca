import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import registry, spherical
from tests.llm.helpers import smallest_reachable


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def truth(rows, threshold=0.9):
    """Links and components of rows whose vectors can be compared, by comparing all."""
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    label = smallest_reachable(range(len(rows)), lambda a, b: near[a, b])
    return {i: (int(near[k].sum()), ids[label[k]]) for k, i in enumerate(ids)}


def groups(seed, dimension, centres=30, near=8, noise=0.25):
    dice = np.random.default_rng(seed)
    x = dice.standard_normal((centres, dimension))
    rows = [c + noise * dice.standard_normal(dimension) for c in x for _ in range(near)] + list(x)
    return [(10 + i, [float(v) for v in r], i % 3) for i, r in enumerate(rows)]


@pytest.mark.parametrize("dimension", [2, 7, 20, 64])
def test_links_equal_brute_force(spark, dimension, monkeypatch):
    monkeypatch.setattr(spherical, "CELL_ROWS", 50)
    rows = groups(dimension, dimension)
    rows += [(1000 + i, r[1], 0) for i, r in enumerate(rows[:20])] + [(2000 + i, rows[0][1], 0) for i in range(60)]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in spherical.near_duplicates(table(spark, rows)).collect()}
    expected = truth(rows)
    assert set(found) == set(expected)
    assert all(found[i][0] <= expected[i][0] for i in found)
    links = sum(n for n, _ in found.values()) / sum(n for n, _ in expected.values())
    assert links >= 0.99
    if links == 1:
        assert found == expected


def test_whole_table_has_every_link(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = registry.queries()["op1_embedding_near_dedup"](spark, sf_dir).collect()
    expected = truth([(r["vec_id"], r["embedding"]) for r in data])
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("dimension", [3, 24, 64, 200])
def test_recall_at_the_threshold(dimension):
    dice = np.random.default_rng(5)
    x = dice.standard_normal((2000, dimension))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = dice.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * away / np.linalg.norm(away, axis=1, keepdims=True)
    code, level = spherical.caps(dimension, spherical.WORDS, 0.9, 0.995)
    own = [set(zip(*(c.tolist() for c in code.decode(v, level)))) for v in (x, y)]
    shared = {row for row, _ in own[0] & own[1]}
    assert len(shared) >= 0.98 * len(x)
    assert len(own[0]) < 50 * len(x)


def test_decoding_lists_all_directions_above_the_height():
    code = spherical.ProductCode.of(40, 6)
    unit = np.random.default_rng(1).standard_normal((50, 40))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    a, b = code.scores(unit)
    total = a[:, :, None] + b[:, None, :]
    assert np.allclose(total.max(axis=(1, 2)), 1)
    expected = {(r, i * 6 + j) for r, i, j in zip(*(x.tolist() for x in np.nonzero(total >= 0.7)))}
    assert set(zip(*(x.tolist() for x in code.decode(unit, 0.7)))) == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
        (None, [1.0, 1.0], 0), (7, [1.0, 1.0], 0), (8, [2.0, 2.0], 0), (8, [2.0, 2.0], 0), (9, [1.0, 1.0, 0.0], 0),
        (10, [-1.0, -1.0], 0), (11, [1e-30, 1e-30], None), (12, [3e38, 3e38], 1), (13, [-0.0, 5.0], 1),
    ]
    odd = table(spark, rows).withColumn("node", F.lit("x")).withColumn("links", F.lit(0)).withColumn("key", F.lit(0))
    found = sorted(map(tuple, spherical.near_duplicates(odd).collect()), key=str)
    assert found == sorted(
        [(i, 0, i) for i in (1, 2, 3, 4, 5, 6, None, 9, 10, 13)] + [(7, 4, 7), (8, 4, 7), (8, 4, 7), (11, 4, 7), (12, 4, 7)],
        key=str,
    )
    assert spherical.near_duplicates(odd.limit(0)).collect() == []


@pytest.mark.parametrize("words", [64, 1024, 4096])
def test_recall_with_any_number_of_words(words):
    dice = np.random.default_rng(6)
    x = dice.standard_normal((1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = dice.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * away / np.linalg.norm(away, axis=1, keepdims=True)
    code, level = spherical.caps(64, words, 0.9, 0.995)
    own = [set(zip(*(c.tolist() for c in code.decode(v, level)))) for v in (x, y)]
    assert len({row for row, _ in own[0] & own[1]}) >= 0.98 * len(x)
    assert len(own[0]) < 100 * len(x)


def test_words_follow_the_vectors():
    assert [spherical.words_for(n) for n in (0, 100_000, 400_000, 10**9)] == [256, 256, 512, 25_600]


def test_components_in_double_precision(spark):
    rows = [(1, [1e300, 0.0]), (2, [2e300, 0.0]), (3, [1e-60, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [0.0, 1e-320])]
    found = spherical.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, found)) == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 1, 5), (6, 1, 5)]
