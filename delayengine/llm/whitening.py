"""Embedding whitening through the exact characteristic polynomial of the integer scatter matrix.

1. Entries c become integers floor(1024 c). Tasks sum their vectors and products exactly (float64 products while
   these stay below 2^53, Python integers beyond); Spark sums the cells as decimals. M = n sum(xx') - S S' is n^2 V, in integers.
2. The polynomial of M is found modulo as many 31-bit primes as its coefficients may need, by reduction to Hessenberg form;
   Spark deals the primes out. Chinese remaindering gives the integers themselves.
3. All roots are real, so the sign changes in the coefficients of p(x + a) count the roots above a exactly (Descartes).
   Bisection by this count isolates a root, by the sign of p refines it to ``BITS`` bits of the trace.
4. A component spans the null space of M - root: inverse iteration with integers of more than twice that length.
   A root of multiplicity m (not told apart at ``BITS`` bits) gets m orthonormal vectors of its null space. One task for each component.

What reaches the driver is of the order of dimensions squared, whatever the number of rows; ``MAX_DIMENSIONS`` bounds it.

Rows are left out if their vector is null, empty, or has an entry that is null, not finite, or of 2^52 or more. Remaining vectors
of different lengths are an error. Components without variance are left out, so a table with one distinct vector gives no row, nor does an
empty one. Repeated rows count each time, ids may be null or repeated. ``deviation`` is null where it needs over 63 bits. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.session import stage

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000  # fixed values: x = floor(SCALE c) + SHIFT
BITS = 192
GUARD = 160
MAX_DIMENSIONS = 4096
_EXACT = 1 << 53
_LOW = 60  # sums travel as two decimals: the bits above, and these
_CELLS = "dims int, cell long, high decimal(38,0), low decimal(38,0)"


class Component(NamedTuple):
    """An eigenvalue of V, its part of V's trace, and its unit vector."""

    variance: float
    explained: float
    vector: np.ndarray


class Whitening(NamedTuple):
    rows: int
    sums: list[int]  # of floor(SCALE c)
    components: list[Component]


# --- Rows as integers ---------------------------------------------------------------


def integers(vectors: pa.Array) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Which rows remain; for each length of a remaining vector floor(SCALE c), one row for each vector in order."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(values) < 2.0**52)
    keep = (lengths > 0) & (np.bincount(owner[bad], minlength=len(lengths)) == 0)
    found = {}
    for d in np.unique(lengths[keep]).tolist():
        own = keep & (lengths == d)
        found[d] = np.floor(values[own[owner]] * SCALE).astype(np.int64).reshape(-1, d)
    return keep, found


def products(x: np.ndarray) -> np.ndarray:
    """x'x as Python integers."""
    largest = int(np.abs(x).max(initial=1))
    step = _EXACT // (largest * largest)
    if not step:
        return x.astype(object).T @ x.astype(object)
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for start in range(0, len(x), step):
        part = x[start:start + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        for d, x in integers(batch.column(0))[1].items():
            if d > MAX_DIMENSIONS:
                raise ValueError(f"vectors of {d} entries; at most {MAX_DIMENSIONS} are taken")
            own = totals.setdefault(d, [0, np.zeros(d, object), np.zeros((d, d), object)])
            own[0] += len(x)
            own[1] = own[1] + x.astype(object).sum(0)
            own[2] = own[2] + products(x)
    for d, (n, sums, square) in totals.items():
        i, j = np.triu_indices(d)
        cells = np.concatenate([i * d + j, -1 - np.arange(d + 1)])  # cell -1 - d holds the number of rows
        values = [divmod(int(v), 1 << _LOW) for v in (*square[i, j], *sums, n)]
        parts = [pa.array([Decimal(v[k]) for v in values], pa.decimal128(38, 0)) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cells), d), pa.int32()), pa.array(cells, pa.int64()), *parts], ["dims", "cell", "high", "low"]
        )


def scatter(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sum, and n^2 times their covariance, exactly. ``vectors`` has one column."""
    cells = vectors.mapInArrow(_summed, _CELLS).groupBy("dims", "cell").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    found = cells.collect()  # d (d + 1) / 2 + d + 1 numbers
    kinds = sorted({r.dims for r in found})
    if len(kinds) > 1:
        raise ValueError(f"vectors of different lengths: {kinds}")
    if not kinds:
        return 0, [], np.zeros((0, 0), object)
    d = kinds[0]
    value = {r.cell: (int(r.high) << _LOW) + int(r.low) for r in found}
    n, sums = value[-1 - d], [value[-1 - i] for i in range(d)]
    matrix = np.zeros((d, d), object)
    for i in range(d):
        for j in range(i, d):
            matrix[i, j] = matrix[j, i] = n * value[i * d + j] - sums[i] * sums[j]
    return n, sums, matrix


# --- The characteristic polynomial --------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all n below 3 * 10^9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The largest primes below 2^31 whose product has more than ``bits`` bits."""
    found, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def _hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Each a[i] modulo p[i] brought to Hessenberg form by similarity; all matrices at once."""
    a, q = a.copy(), p[:, None, None]
    for k in range(a.shape[1] - 2):
        below = a[:, k + 1:, k] != 0
        pivot = below.argmax(1) + k + 1
        for m in np.flatnonzero(below.any(1) & (pivot != k + 1)):
            i = pivot[m]
            a[m, [k + 1, i]] = a[m, [i, k + 1]]
            a[m][:, [k + 1, i]] = a[m][:, [i, k + 1]]
        inverse = np.array([pow(x, -1, m) if x else 0 for x, m in zip(a[:, k + 1, k].tolist(), p.tolist(), strict=True)])
        factor = a[:, k + 2:, k] * inverse[:, None] % p[:, None]
        a[:, k + 2:, k:] = (a[:, k + 2:, k:] - factor[:, :, None] * a[:, None, k + 1, k:] % q) % q
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2:] * factor[:, None, :] % q).sum(2)) % p[:, None]
    return a


def polynomials_modulo(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """For each prime the coefficients of det(xI - matrix), from the constant one up."""
    d, p = len(matrix), np.array(primes, np.int64)
    h = _hessenberg(np.stack([(matrix % m).astype(np.int64) for m in primes]), p)
    q = p[:, None]
    leading = np.zeros((len(p), d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    leading[:, 0, 0] = 1
    for k in range(1, d + 1):
        weights, chain = np.zeros((len(p), k), np.int64), np.ones(len(p), np.int64)
        weights[:, k - 1] = h[:, k - 1, k - 1]
        for i in range(k - 2, -1, -1):
            chain = chain * h[:, i + 1, i] % p
            weights[:, i] = h[:, i, k - 1] * chain % p
        less = (weights[:, :, None] * leading[:, :k] % p[:, None, None]).sum(1) % q
        leading[:, k, 1:] = leading[:, k - 1, :-1]
        leading[:, k] = (leading[:, k] - less) % q
    return leading[:, d]


def remaindered(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The integers of least absolute value with these remainders; one list of remainders for each prime."""
    product = math.prod(primes)
    parts = [product // p for p in primes]
    weights = [part * pow(part, -1, p) for part, p in zip(parts, primes, strict=True)]
    out = []
    for column in zip(*residues, strict=True):
        value = sum(w * int(c) for w, c in zip(weights, column, strict=True)) % product
        out.append(value - product if value > product // 2 else value)
    return out


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """det(xI - matrix) of a symmetric matrix without negative eigenvalues, from the constant coefficient up."""
    d = len(matrix)
    mean = int(matrix.trace()) // d + 2  # the coefficients' absolute values sum to at most (1 + trace / d)^d
    primes = primes_for(d * mean.bit_length() + 2)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in batch.column(0).to_pylist():
                own = primes[low:low + 8]
                found = polynomials_modulo(shared.value, own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], ["prime", "coefficients"]
                )

    groups = spark.range(0, len(primes), 8, min(-(-len(primes) // 8), spark.sparkContext.defaultParallelism))
    rows = groups.mapInArrow(run, "prime long, coefficients array<long>").collect()  # a row for each prime
    return remaindered([r.coefficients for r in rows], [r.prime for r in rows])


# --- Roots --------------------------------------------------------------------------


def above(polynomial: list[int], point: int) -> int:
    """How many roots of a polynomial with real roots only are greater than ``point``."""
    c = list(polynomial)
    for low in range(len(c) - 1):
        for i in range(len(c) - 2, low - 1, -1):
            c[i] += point * c[i + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _positive(polynomial: list[int], point: int) -> bool | None:
    value = 0
    for c in reversed(polynomial):
        value = value * point + c
    return None if not value else value > 0


def root(polynomial: list[int], top: int, k: int) -> tuple[int, int, int]:
    """The k-th largest positive root (from 1) up to 1, as the upper end of its unit interval, the roots above it, and those in it."""
    low, high = 0, top + 1
    upper, lower = 0, above(polynomial, 0)  # roots above high and above low
    while high - low > 1:
        middle = (low + high) // 2
        if lower - upper == 1:  # isolated: the sign tells whether an odd number of roots lies above
            sign = _positive(polynomial, middle)
            count = upper if sign is None or sign == (upper % 2 == 0) else lower
        else:
            count = above(polynomial, middle)
        if count >= k:
            low, lower = middle, count
        else:
            high, upper = middle, count
    return high, upper, lower - upper


# --- Components ---------------------------------------------------------------------


def _unit(v: np.ndarray, bits: int) -> np.ndarray:
    """v scaled to length 2^bits."""
    spare = max(0, 2 * bits - min(int(abs(v).max()).bit_length(), 2 * bits))
    v = np.array([int(x) << spare for x in v], object)
    length = math.isqrt(int((v * v).sum()))
    return np.array([(int(x) << bits) // length for x in v], object)


def null_vectors(matrix: np.ndarray, value: int, scale: int, count: int) -> list[np.ndarray]:
    """``count`` orthonormal vectors that ``matrix`` - value / 2^scale all but sends to 0, by inverse iteration in integers."""
    d, bits = len(matrix), BITS + GUARD
    a = np.array([[int(x) << (scale + GUARD) for x in row] for row in matrix], object)
    for i in range(d):
        a[i, i] -= value << GUARD
    order, factors = list(range(d)), np.zeros((d, d), object)
    for k in range(d):  # elimination with row exchange
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        if best != k:
            a[[k, best]], factors[[k, best]] = a[[best, k]], factors[[best, k]]
            order[k], order[best] = order[best], order[k]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < d:
            factors[k + 1:, k] = (a[k + 1:, k] << bits) // a[k, k]
            a[k + 1:, k + 1:] -= (factors[k + 1:, k, None] * a[None, k, k + 1:]) >> bits
    own = max(bits, int(abs(a).max()).bit_length())
    starts = np.random.default_rng(d).integers(1, 1 << 30, (count, d))
    found = [_unit(s.astype(object), bits) for s in starts]
    for _ in range(2):
        done: list[np.ndarray] = []
        for v in found:
            y = v[order]
            for k in range(d - 1):
                y[k + 1:] -= (factors[k + 1:, k] * y[k]) >> bits
            for k in range(d - 1, -1, -1):
                y[k] = (int(y[k]) << own) // int(a[k, k])
                y[:k] -= (a[:k, k] * y[k]) >> own
            y = _unit(y, bits)
            for _ in range(2):
                for other in done:
                    y = y - (other * (int((y * other).sum()) >> bits) >> bits)
                y = _unit(y, bits)
            done.append(y)
        found = done
    return [np.array([int(x) / (1 << bits) for x in v]) for v in found]


def components(spark: SparkSession, n: int, matrix: np.ndarray, count: int = COMPONENTS) -> list[Component]:
    """The first components of matrix / n^2 by falling eigenvalue; those without variance are left out."""
    trace = int(matrix.trace()) if len(matrix) else 0
    if not trace:
        return []
    divisor = math.gcd(*(int(x) for x in matrix.ravel()))
    small = np.array([[int(x) // divisor for x in row] for row in matrix], object)
    top = trace // divisor
    polynomial = characteristic(spark, small)
    positive = len(polynomial) - 1 - next(i for i, c in enumerate(polynomial) if c)
    scale = max(0, BITS - top.bit_length())
    # the roots times 2^scale
    fine = [c << (scale * (len(polynomial) - 1 - i)) for i, c in enumerate(polynomial)]
    wanted = min(count, positive)
    shared = spark.sparkContext.broadcast((fine, small))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                fine, small = shared.value
                value, before, together = root(fine, top << scale, k)
                vector = null_vectors(small, value, scale, together)[k - 1 - before]
                vector = vector if vector[np.abs(vector).argmax()] > 0 else -vector
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([str(value)]), pa.array([vector.tolist()], pa.list_(pa.float64()))], ["k", "value", "vector"]
                )

    rows = spark.range(1, wanted + 1, 1, wanted).mapInArrow(run, "k long, value string, vector array<double>").collect()  # one for each component
    out = []
    for row in sorted(rows):
        value = int(row.value)
        out.append(Component(value * divisor / (n * n << scale), value / (top << scale), np.array(row.vector)))
    return out


# --- Whitening ----------------------------------------------------------------------


def fit(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> Whitening:
    """Sums and components of all remaining vectors."""
    n, sums, matrix = scatter(vectors.select(column))
    return Whitening(n, sums, components(vectors.sparkSession, n, matrix, count))


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key``, ``deviation`` and the array ``whitened`` of each remaining row."""
    n, d = model.rows, len(model.sums)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        axes = np.stack([c.vector for c in model.components], 1) if model.components else np.zeros((d, 0))
        spread = np.array([n * math.sqrt(c.variance) for c in model.components])
        for batch in batches:
            keep, found = integers(batch.column(1))
            x = found.get(d, np.zeros((0, d), np.int64))
            if len(x) < keep.sum():
                raise ValueError("vectors of another length than those of the fit")
            largest = int(np.abs(x).max(initial=0)) * n + max((abs(s) for s in model.sums), default=0)
            away = x.astype(object) * n - np.array(model.sums, object) if largest >> 62 else x * n - np.array(model.sums, np.int64)
            if d * largest * largest >> 62:
                away = away.astype(object)
            far = [int(v) if v < 1 << 63 else None for v in (away * away).sum(1)]
            values = (away.astype(np.float64) @ axes / spread).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), pa.array(far, pa.int64()), pa.array(values, pa.list_(pa.float64()))],
                [key, "deviation", "whitened"],
            )

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, column).mapInArrow(run, f"`{key}` {kind}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, n: int, count: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` less the identity."""
    at = [F.col("whitened")[i] for i in range(count)]
    means = rows.agg(*[F.avg(w) for w in at]).first()
    away = [w - F.lit(m) for w, m in zip(at, means, strict=True)]
    places = [(i, j) for i in range(count) for j in range(i, count)]
    sums = rows.agg(*[F.sum(away[i] * away[j]) for i, j in places]).first()
    return max(abs(s / n - (i == j)) for (i, j), s in zip(places, sums, strict=True))


def whitened_table(vectors: DataFrame) -> DataFrame:
    """One row for each remaining ``vec_id`` and component: its whitened value, with the fit's figures beside it."""
    model = fit(vectors)
    count = len(model.components)
    rows = stage(whiten(vectors, model), "whitened")
    error = identity_error(rows, model.rows, count) if count else None
    shares = F.array(*[F.lit(c.explained) for c in model.components]).cast("array<double>")
    long = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return long.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.rows).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
