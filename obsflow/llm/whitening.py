"""Embedding whitening by the exact characteristic polynomial (operator 11).

Entries become integers, so the scatter matrix of all vectors is a matrix of
exact integers. Its characteristic polynomial is found modulo many primes
(reduction to Hessenberg form) and put together by Chinese remaindering. All its
roots are real, which makes counting them above a point a matter of signs; the
largest ones are isolated and refined to high precision, and the null space of
the matrix less each root is found by inverse iteration in fixed-point integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.llm.common import arrow_map, int64
from obsflow.llm.registry import query

# An entry c counts as the integer floor(1024 * c) + 100000.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8

#: Integers beyond this count as this; every sum and product below is exact up to it.
LARGEST = 2**62

#: Roots are found to this many bits; roots that agree in all of them are one multiple root.
ROOT_BITS = 128
#: Bits behind the binary point in inverse iteration.
FRACTION_BITS = 192

_LIMB_BITS, _LIMBS = 32, 6
_ROWS_AT_A_TIME = 4096


# Scatter: sums of products of exact integers over all rows.


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """The integers of a batch without the offset, a row per vector; shorter vectors go on with zero entries."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.zeros((len(column), dims))
    whole[np.arange(dims) < lengths[:, None]] = entries
    with np.errstate(over="ignore"):
        scaled = np.floor(whole * SCALE)
    return np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64)


def _products(z: np.ndarray) -> np.ndarray:
    """The exact sum of the outer products of the rows with themselves."""
    largest = int(np.abs(z).max(initial=0))
    if largest * largest * len(z) < 2**53:
        exact = z.astype(np.float64)
        return (exact.T @ exact).astype(np.int64).astype(object)
    if largest * largest * len(z) < 2**63:
        return (z.T @ z).astype(object)
    big = z.astype(object)
    return big.T @ big


def _limbs(number: int) -> list[int]:
    """A signed integer as digits of 32 bits, the last one signed; sums of digits give the sum of the numbers."""
    mask = (1 << _LIMB_BITS) - 1
    low = [number >> (_LIMB_BITS * n) & mask for n in range(_LIMBS - 1)]
    return [*low, number >> (_LIMB_BITS * (_LIMBS - 1))]


def _scatter_of(dims: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_A_TIME):
                y = _vectors(batch.column("vector").slice(start, _ROWS_AT_A_TIME), dims)
                found = _products(np.column_stack([np.ones(len(y), np.int64), y]))
                total = found if total is None else total + found
        if total is None:
            return
        i, j = np.triu_indices(dims + 1)
        digits = list(zip(*(_limbs(int(v)) for v in total[i, j])))
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(d, pa.int64()) for d in digits)]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", *(f"d{n}" for n in range(_LIMBS))])

    return step


@dataclass(frozen=True)
class Fit:
    """What all vectors add up to: their number, per dimension the sum, and n * n times their covariance, all exact."""

    n: int
    sums: tuple[int, ...]
    scatter: tuple[tuple[int, ...], ...]

    @property
    def trace(self) -> int:
        return sum(row[i] for i, row in enumerate(self.scatter))


def fit_scatter(vectors: DataFrame, dims: int) -> Fit:
    """One pass over ``vector``: a matrix per task, added up by Spark; what reaches the driver has dims^2 / 2 rows.

    The integers are summed without the offset. Sums are exact, so taking the
    mean out afterwards leaves the very integers that centred rows give.
    """
    digits = [f"d{n}" for n in range(_LIMBS)]
    parts = arrow_map(vectors, _scatter_of(dims), "i int, j int, " + ", ".join(f"{d} bigint" for d in digits))
    added = parts.groupBy("i", "j").agg(*(F.sum(d).alias(d) for d in digits))
    total = [[0] * (dims + 1) for _ in range(dims + 1)]
    for row in added.collect():
        value = sum(row[d] << (_LIMB_BITS * n) for n, d in enumerate(digits))
        total[row["i"]][row["j"]] = total[row["j"]][row["i"]] = value
    n, sums = total[0][0], total[0][1:]
    scatter = tuple(
        tuple(n * total[i + 1][j + 1] - sums[i] * sums[j] for j in range(dims)) for i in range(dims)
    )
    return Fit(n, tuple(sums), scatter)


# The characteristic polynomial.


def _primes(product: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds the given number."""
    small = np.ones(46_342, bool)
    small[:2] = False
    for p in range(2, 216):
        if small[p]:
            small[p * p :: p] = False
    divisors = np.flatnonzero(small)
    found, at, reached = [], 2**31 - 1, 1
    while reached <= product:
        if (at % divisors).all():
            found.append(at)
            reached *= at
        at -= 2
    return found


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to the given one modulo p, with zeros below the first subdiagonal."""
    h = matrix.copy()
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(axis=1)) % p
    return h


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of the characteristic polynomial modulo p, from the constant term to the leading one."""
    h = hessenberg(matrix, p)
    d = len(h)
    of_leading = np.zeros((d + 1, d + 1), np.int64)  # row k: that of the leading k rows and columns
    of_leading[0, 0] = 1
    for k in range(1, d + 1):
        shifted = np.r_[0, of_leading[k - 1, :-1]]
        found = shifted - h[k - 1, k - 1] * of_leading[k - 1] % p
        below, factors = 1, []
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            factors.append(below * int(h[i - 1, k - 1]) % p)
        if factors:
            found = found - (np.array(factors)[:, None] * of_leading[k - 2 :: -1][: len(factors)] % p).sum(axis=0)
        of_leading[k] = found % p
    return of_leading[d]


def characteristic_polynomial(spark: SparkSession, scatter) -> list[int]:
    """The symmetric functions e_0, e_1, ... of the eigenvalues of a positive semidefinite integer matrix.

    They are the coefficients from the leading one on, without their
    alternating signs. Each prime is a row that Spark deals to a task; e_k is
    at most what d equal eigenvalues of the same sum give, which says how many
    primes are needed.
    """
    d, trace = len(scatter), sum(row[i] for i, row in enumerate(scatter))
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(scatter, dtype=object)
        for batch in batches:
            primes = int64(batch.column("p"))
            found = [polynomial_modulo((exact % int(p)).astype(np.int64), int(p)) for p in primes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("p"), pa.array([f.tolist() for f in found], pa.list_(pa.int64()))], names=["p", "found"]
            )

    primes = spark.createDataFrame([(p,) for p in _primes(bound)], "p bigint")
    dealt = primes.repartition(max(1, spark.sparkContext.defaultParallelism))
    residues = arrow_map(dealt, step, "p bigint, found array<bigint>").collect()
    product = math.prod(r["p"] for r in residues)
    symmetric = [0] * (d + 1)
    for r in residues:
        p, others = r["p"], product // r["p"]
        unit = others * pow(others % p, -1, p)
        for k in range(d + 1):
            residue = r["found"][d - k] * (-1) ** k % p
            symmetric[k] += unit * residue
    return [s % product for s in symmetric]


# Its roots.


def roots_above(symmetric: list[int], at: int, bits: int) -> int:
    """How many roots exceed at / 2^bits, by the signs of the polynomial's derivatives there.

    The rule of signs gives the exact number where all roots are real.
    """
    d = len(symmetric) - 1
    c = [(-1) ** (d - i) * symmetric[d - i] << (bits * (d - i)) for i in range(d + 1)]
    for start in range(d):
        for i in range(d - 1, start - 1, -1):
            c[i] += at * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(symmetric: list[int], at: int, bits: int) -> int:
    value, d = 0, len(symmetric) - 1
    for k, s in enumerate(symmetric):
        value = value * at + ((-1) ** k * s << (bits * k))
    return (value > 0) - (value < 0)


@dataclass(frozen=True)
class Root:
    """The number at / 2^bits, which occurs ``times`` times."""

    at: int
    bits: int
    times: int


def largest_roots(symmetric: list[int], wanted: int) -> list[Root]:
    """The largest positive roots, falling, until there are as many as wanted counting repeats, or no more.

    Intervals are halved until one root is left in each, then that one is
    refined by the sign of the polynomial, to ROOT_BITS bits.
    """
    rank = max(k for k, s in enumerate(symmetric) if s)
    symmetric = symmetric[: rank + 1]
    if not rank:
        return []
    found: list[Root] = []
    # (low, high, bits, roots above low, roots above high): the roots in (low, high] / 2^bits
    waiting = [(0, symmetric[1] + 1, 0, rank, 0)]
    while waiting and sum(r.times for r in found) < wanted:
        low, high, bits, above_low, above_high = waiting.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1 and low:
            found.append(_refined(symmetric, low, high, bits, above_high))
        elif low >> ROOT_BITS >= high - low:
            found.append(Root(low + high, bits + 1, above_low - above_high))
        else:
            if high - low == 1:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            above = roots_above(symmetric, middle, bits)
            waiting.append((low, middle, bits, above_low, above))
            waiting.append((middle, high, bits, above, above_high))
    return found


def _refined(symmetric: list[int], low: int, high: int, bits: int, above: int) -> Root:
    """The one root in (low, high]; beyond it the polynomial has the sign that ``above`` further roots leave."""
    beyond = (-1) ** above
    while low >> ROOT_BITS < high - low:
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        sign = _sign(symmetric, middle, bits)
        if not sign:
            return Root(middle, bits, 1)
        low, high = (low, middle) if sign == beyond else (middle, high)
    return Root(low + high, bits + 1, 1)


# Its components.


def _dot(a: np.ndarray, b: np.ndarray) -> int:
    return int((a * b).sum()) >> FRACTION_BITS


def _unit(v: np.ndarray) -> np.ndarray:
    length = math.isqrt(int((v * v).sum()))
    return np.array([(int(x) << FRACTION_BITS) // length for x in v], dtype=object)


def null_space(scatter, root: Root, rounds: int = 4) -> list[list[float]]:
    """Unit vectors that span the eigenspace of a root, each with a positive largest entry.

    Inverse iteration with the matrix less the root: Gaussian elimination with
    row exchanges, in integers with FRACTION_BITS bits behind the point.
    """
    d = len(scatter)
    a = np.array(scatter, dtype=object) << FRACTION_BITS
    shift = FRACTION_BITS - root.bits
    value = root.at << shift if shift >= 0 else root.at >> -shift
    for i in range(d):
        a[i, i] -= value
    order, factors = list(range(d)), []
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
            for f in factors:
                f[k], f[pivot] = f[pivot], f[k]
        if not a[k, k]:
            a[k, k] = 1
        column = np.zeros(d, dtype=object)
        column[k + 1 :] = (a[k + 1 :, k] << FRACTION_BITS) // a[k, k]
        a[k + 1 :, k:] -= (column[k + 1 :, None] * a[k, k:]) >> FRACTION_BITS
        factors.append(column)

    def solved(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for k in range(d):
            x[k + 1 :] -= (factors[k][k + 1 :] * x[k]) >> FRACTION_BITS
        for k in range(d - 1, -1, -1):
            rest = int(x[k]) - (int((a[k, k + 1 :] * x[k + 1 :]).sum()) >> FRACTION_BITS)
            x[k] = (rest << FRACTION_BITS) // int(a[k, k])
        return x

    dice = np.random.default_rng(d)
    one = 1 << FRACTION_BITS
    found = [
        np.array([int(x) * one >> 30 for x in dice.integers(-(2**30), 2**30, d)], dtype=object) for _ in range(root.times)
    ]
    for _ in range(rounds):
        for n in range(root.times):
            v = _unit(solved(found[n]))
            for _again in range(2):
                for other in found[:n]:
                    v = v - (other * _dot(v, other) >> FRACTION_BITS)
                v = _unit(v)
            found[n] = v
    vectors = [[int(x) / one for x in v] for v in found]
    return [[x * math.copysign(1.0, max(v, key=abs)) for x in v] for v in vectors]


@dataclass(frozen=True)
class Component:
    """An eigenvector of the scatter with its eigenvalue as a float, and its share of the trace."""

    vector: tuple[float, ...]
    eigenvalue: float
    explained: float


def components(spark: SparkSession, fit: Fit, wanted: int = COMPONENTS) -> list[Component]:
    """The components of positive variance, by falling eigenvalue, ``wanted`` at most.

    Each eigenspace is a row that Spark deals to a task. The cost grows with
    the dimensions only, not with the rows.
    """
    if not fit.trace:
        return []
    roots = largest_roots(characteristic_polynomial(spark, fit.scatter), min(wanted, len(fit.scatter)))
    scatter = fit.scatter

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("number").to_pylist()
            spaces = [null_space(scatter, roots[n]) for n in numbers]
            yield pa.RecordBatch.from_arrays(
                [batch.column("number"), pa.array(spaces, pa.list_(pa.list_(pa.float64())))], names=["number", "space"]
            )

    numbers = spark.createDataFrame([(n,) for n in range(len(roots))], "number int").repartition(len(roots))
    spaces = {r["number"]: r["space"] for r in arrow_map(numbers, step, "number int, space array<array<double>>").collect()}
    found = []
    for n, root in enumerate(roots):
        explained = root.at / (fit.trace << root.bits)
        found += [Component(tuple(v), root.at / (1 << root.bits), explained) for v in spaces[n]]
    return found[:wanted]


# Whitening.


def _centred(y: np.ndarray, fit: Fit) -> np.ndarray:
    """n * x - S, exact; the offset cancels out."""
    sums = max(map(abs, fit.sums), default=0)
    if int(np.abs(y).max(initial=0)) * fit.n + sums < 2**62:
        return y * fit.n - np.array(fit.sums, dtype=np.int64)
    return y.astype(object) * fit.n - np.array(fit.sums, dtype=object)


def _deviations(centred: np.ndarray) -> list[int]:
    largest = int(np.abs(centred).max(initial=0))
    if largest * largest * centred.shape[1] >= 2**63:
        centred = centred.astype(object)
    return [int(v) for v in (centred * centred).sum(axis=1)]


def _whitened(centred: np.ndarray, found: list[Component]) -> np.ndarray:
    axes = np.array([c.vector for c in found]).T / np.sqrt([c.eigenvalue for c in found])
    return centred.astype(np.float64) @ axes


def _covariance_of(fit: Fit, found: list[Component]):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(found) + 1, len(found) + 1))
        for batch in batches:
            w = _whitened(_centred(_vectors(batch.column("vector"), len(fit.sums)), fit), found)
            z = np.column_stack([np.ones(len(w)), w])
            total += z.T @ z
        i, j = np.triu_indices(len(found) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "added"]
        )

    return step


def identity_error(vectors: DataFrame, fit: Fit, found: list[Component]) -> float | None:
    """The largest absolute entry of the covariance of all whitened rows less the identity.

    Rows are centred before they are whitened; the mean of what comes out, zero
    but for rounding, is taken out as well.
    """
    if not found:
        return None
    parts = arrow_map(vectors, _covariance_of(fit, found), "i int, j int, added double")
    added = {(r["i"], r["j"]): r["added"] for r in parts.groupBy("i", "j").agg(F.sum("added").alias("added")).collect()}
    n, sides = added[0, 0], range(1, len(found) + 1)
    return max(
        abs(added[i, j] / n - added[0, i] * added[0, j] / (n * n) - (i == j)) for i in sides for j in sides if i <= j
    )


def whiten(table: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """The usable rows of ``table``, all columns within ``row``, with their whitened coordinates.

    Columns: ``row``, ``n`` (rows that were fitted), ``deviation`` (sum over
    dimensions of (n * x - S)^2; null where a long cannot hold it),
    ``deviation_text`` (the same, always), ``whitened`` (a number per
    component), ``explained`` (a share per component) and ``identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out.
    Shorter vectors go on with zero entries to the length of the longest;
    entries beyond 2^62 / 1024 count as that. Components without variance have
    null coordinates and no share; there are as many components as dimensions,
    ``wanted`` at most, so none for empty vectors. Equal rows count each. Ties
    of eigenvalues give some orthogonal axes of their common space, the same for
    all rows. An empty table gives no rows.
    """
    spark = table.sparkSession
    held = table.select(F.struct("*").alias("row"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    usable = held.filter(F.col("vector").isNotNull() & finite)
    dims = usable.agg(F.max(F.size("vector"))).first()[0] or 0
    only = usable.select("vector")
    fit = fit_scatter(only, dims) if dims else Fit(0, (), ())
    found = components(spark, fit, wanted)
    error = identity_error(only, fit, found)
    shown = min(wanted, dims)
    schema = T.StructType(
        [
            usable.schema["row"],
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("deviation_text", T.StringType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
            T.StructField("explained", T.ArrayType(T.DoubleType())),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    shares = [c.explained for c in found] + [None] * (shown - len(found))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = _centred(_vectors(batch.column("vector"), dims), fit)
            exact = _deviations(centred) if dims else [0] * batch.num_rows
            rows = _whitened(centred, found).tolist() if found else [[] for _ in exact]
            padding = [None] * (shown - len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([fit.n] * len(exact), pa.int64()),
                    pa.array([v if v < 2**63 else None for v in exact], pa.int64()),
                    pa.array([str(v) for v in exact], pa.string()),
                    pa.array([r + padding for r in rows], pa.list_(pa.float64())),
                    pa.array([shares] * len(exact), pa.list_(pa.float64())),
                    pa.array([error] * len(exact), pa.float64()),
                ],
                names=schema.fieldNames(),
            )

    return arrow_map(usable, step, schema)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = whiten(table)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "axis")
    return found.select("row.vec_id", "n", "deviation", "deviation_text", "identity_error", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation",
        F.col("axis.whitened").alias("whitened"), F.col("axis.explained").alias("explained"), "identity_error",
        "deviation_text",
    )
