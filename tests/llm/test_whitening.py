import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from obsflow.llm import registry, whitening


def vectors(rows=300, dims=12, seed=4):
    dice = np.random.default_rng(seed)
    mixing = dice.normal(size=(dims, dims))
    return (dice.normal(size=(rows, dims)) @ mixing / 3).astype(np.float32)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def integers(vectors):
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def plain_scatter(x):
    n, dims = len(x), len(x[0])
    sums = [sum(v[i] for v in x) for i in range(dims)]
    centred = [[n * v[i] - sums[i] for i in range(dims)] for v in x]
    # n^2 times the covariance; the centred integers carry a factor n each
    scatter = [[sum(v[i] * v[j] for v in centred) // n for j in range(dims)] for i in range(dims)]
    return sums, centred, scatter


def plain_polynomial(m):
    """Faddeev and LeVerrier, in exact fractions; e_0, e_1, ..."""
    d = len(m)
    power = [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
    found, c = [1], Fraction(1)
    for k in range(1, d + 1):
        product = [[sum(m[i][t] * power[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c = -sum(product[i][i] for i in range(d)) / k
        found.append((-1) ** k * c)
        power = [[product[i][j] + (c if i == j else 0) for j in range(d)] for i in range(d)]
    return [int(f) for f in found]


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_equals_plain_one(spark, seed):
    dice = random.Random(seed)
    d = dice.randrange(1, 9)
    base = [[dice.randrange(-50, 50) * (dice.random() < 0.6) for _ in range(d)] for _ in range(d)]
    m = [[sum(base[i][k] * base[j][k] for k in range(d)) for j in range(d)] for i in range(d)]
    assert whitening.characteristic_polynomial(spark, m) == plain_polynomial(m)


def test_primes():
    found = whitening._primes(2**200)
    assert found[0] == 2**31 - 1 and len(set(found)) == len(found) and math.prod(found) > 2**200
    assert all(all(p % q for q in range(2, 2000)) for p in found)


def symmetric(roots):
    found = [1]
    for r in roots:
        found = [a + r * b for a, b in zip([*found, 0], [0, *found])]
    return found


def test_roots_are_counted_and_isolated():
    roots = [7, 7, 7, 3, 2, 1, 0, 0, 10**30, 10**30 + 1]
    poly = symmetric(roots)
    for at in (0, 1, 2, 3, 6, 7, 8, 10**30):
        assert whitening.roots_above(poly, at, 0) == sum(r > at for r in roots)
    found = whitening.largest_roots(poly, 8)
    assert [r.times for r in found] == [1, 1, 3, 1, 1, 1]
    for r, expected in zip(found, (10**30 + 1, 10**30, 7, 3, 2, 1)):
        assert abs(Fraction(r.at, 2**r.bits) - expected) < Fraction(expected, 2**100)
    assert whitening.largest_roots([1, 0, 0], 2) == []
    assert sum(r.times for r in whitening.largest_roots(poly, 2)) == 2


def test_null_space_of_close_and_equal_roots():
    # Eigenvalues 10^20 + 1 and 10^20 are closer than doubles tell apart; 5 occurs twice.
    m = [[10**20 + 1, 0, 0, 0], [0, 10**20, 0, 0], [0, 0, 5, 0], [0, 0, 0, 5]]
    first, second, both = whitening.largest_roots(symmetric([10**20 + 1, 10**20, 5, 5]), 4)
    assert np.allclose(whitening.null_space(m, first), [[1, 0, 0, 0]], atol=1e-15)
    assert np.allclose(whitening.null_space(m, second), [[0, 1, 0, 0]], atol=1e-15)
    space = np.array(whitening.null_space(m, both))
    assert np.allclose(space @ space.T, np.eye(2), atol=1e-15) and np.allclose(space[:, :2], 0, atol=1e-15)


@pytest.mark.parametrize("magnitude", [1.0, 1e-3, 1e6, 1e15])
def test_scatter_is_exact_at_every_magnitude(spark, magnitude):
    rows = (vectors(60, 4) * magnitude).astype(np.float64)
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "vector array<double>").repartition(3)
    fit = whitening.fit_scatter(df, 4)
    sums, _, scatter = plain_scatter([[a - 100_000 for a in v] for v in integers(rows)])
    assert (fit.n, list(fit.sums), [list(r) for r in fit.scatter]) == (60, sums, scatter)


def check(found, rows, components):
    """The query's rows against plain covariance and numpy's eigenvectors."""
    x = integers([v for _, v in rows])
    sums, centred, scatter = plain_scatter(x)
    n = len(x)
    values, axes = np.linalg.eigh(np.array(scatter, dtype=np.float64) / n**2)
    values, axes = values[::-1], axes[:, ::-1]
    expected = {i: (sum(c * c for c in v), v) for (i, _), v in zip(rows, centred)}
    assert len(found) == n * components
    signs = {}
    for r in sorted(found, key=lambda r: (r["vec_id"], r["component"])):
        k = r["component"] - 1
        deviation, v = expected[r["vec_id"]]
        assert r["n"] == n and int(r["deviation_text"]) == deviation
        assert r["deviation"] == (deviation if deviation < 2**63 else None)
        plain = sum(a / n * b for a, b in zip(v, axes[:, k])) / math.sqrt(values[k])
        sign = signs.setdefault(k, 1 if plain * r["whitened"] >= 0 else -1)
        assert r["whitened"] == pytest.approx(sign * plain, abs=1e-8)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in found}) == 1


def test_query_equals_brute_force(spark, tmp_path):
    rows = list(enumerate(vectors().tolist()))
    pq.write_table(pa.table({"vec_id": [i for i, _ in rows], "embedding": [v for _, v in rows]}), tmp_path / "embeddings.parquet")
    check(registry.queries()["op11_embedding_whitening"](spark, str(tmp_path)).collect(), rows, 8)


def test_given_table(spark, sf_dir):
    df = registry.queries()["op11_embedding_whitening"](spark, sf_dir)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(df.collect(), [(r["vec_id"], r["embedding"]) for r in table.collect()], 8)


def test_fewer_dimensions_than_components(spark):
    rows = list(enumerate(vectors(50, 3).tolist()))
    found = whitening.whiten(table(spark, rows)).collect()
    assert all(len(r["whitened"]) == len(r["explained"]) == 3 for r in found)
    assert sum(found[0]["explained"]) == pytest.approx(1)


def test_dependent_dimensions_have_no_coordinates(spark):
    rows = [(i, [a, a, 0.0]) for i, a in enumerate((1.0, 2.0, 4.0, 8.0))]
    found = whitening.whiten(table(spark, rows)).collect()
    assert all(r["whitened"][1:] == [None, None] and r["explained"] == [1.0, None, None] for r in found)
    assert all(r["identity_error"] < 1e-9 for r in found)
    assert sum(r["whitened"][0] ** 2 for r in found) / 4 == pytest.approx(1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [3.0, -1.0]), (8, [2.0]), (9, [])]
    bad = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, -inf])]
    df = table(spark, good + bad, "double").withColumns({c: F.lit("x") for c in ("row", "n", "vector", "whitened")})
    found = whitening.whiten(df).collect()
    assert sorted((r["row"]["vec_id"] for r in found), key=str) == sorted((i for i, _ in good), key=str)
    assert {r["n"] for r in found} == {5}
    padded = [(i, [*v, 0.0, 0.0][:2]) for i, v in good]
    _, centred, _ = plain_scatter(integers([v for _, v in padded]))
    assert sorted(r["deviation"] for r in found) == sorted(sum(c * c for c in v) for v in centred)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(table(spark, bad)).collect() == []
    (alone,) = whitening.whiten(table(spark, good[:1])).collect()
    assert (alone["n"], alone["deviation"], alone["whitened"], alone["identity_error"]) == (1, 0, [None, None], None)
    (empty,) = whitening.whiten(table(spark, good[-1:])).collect()
    assert empty["whitened"] == []


def test_entries_beyond_a_long(spark):
    rows = [(i, [a, float(i)]) for i, a in enumerate((1e300, -1e300, 0.0, 1e17))]
    found = whitening.whiten(table(spark, rows, "double")).collect()
    assert all(r["deviation"] is None and int(r["deviation_text"]) > 2**63 for r in found)
    assert all(r["identity_error"] < 1e-9 for r in found)
