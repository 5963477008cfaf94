"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter n * sum(x x') - S S' is a matrix of whole numbers and everything up to the
eigenvectors can be exact:

1. Tasks add up n, S and sum(x x'): products of 20-bit limbs in double precision, few enough at a time to be exact,
   then Python's whole numbers. Spark adds the cells as decimals, or as text where they are longer than 38 digits.
2. The characteristic polynomial modulo many primes below 2 ** 31: Hessenberg form by similarity, then the recurrence of
   its leading minors. Primes are rows of a Spark table. Chinese remainders give the coefficients; the number of primes
   follows from a bound on them that the trace gives (no eigenvalue is negative).
3. Roots: all are real, so the number of roots above a is the number of sign changes in the coefficients of p(t + a),
   with multiplicity, by exact arithmetic. Halving isolates the largest roots to `DIGITS` bits; roots that stay together
   count as one of higher multiplicity.
4. Components: inverse iteration on the null space of scatter - root, in whole numbers scaled by 2 ** `PRECISION`; a
   multiple root gets as many orthogonal vectors as its multiplicity.

The driver sees the scatter, residues and components: numbers that depend on the dimension only.

Defined cases: rows are left out where the vector is null, empty or holds null or non-finite entries; where lengths differ, the length
that most vectors have (the greater of equals) counts and others are left out; entries beyond +-2 ** 52 / 1024 are outside the range
of `x` and leave their row out as well; a null id, repeated ids and repeated rows count row by row; components with
eigenvalue 0 have no whitened values and give no rows, so equal vectors or an empty table give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb, gcd, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from benchloom.llm.common import quoted

SCALE, SHIFT = 1024, 100_000
RANGE = 2.0**52
LIMB = 20
DIGITS = 200
PRECISION = 320


# ------------------------------------------------------------------ whole numbers from vectors

def matrix_of(column: pa.Array, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(which rows count, floor(1024 * entries) of those rows as doubles)."""
    lengths = np.diff(column.offsets.to_numpy())
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    if size is not None:
        valid &= lengths == size
    entries = column.values.cast(pa.float64())
    good = entries.is_valid().to_numpy(zero_copy_only=False)
    values = np.floor(entries.fill_null(np.nan).to_numpy() * SCALE)
    good &= np.abs(values) <= RANGE
    offsets = column.offsets.to_numpy()
    bad = np.concatenate([[0], np.cumsum(~good)])
    valid &= bad[offsets[1:]] == bad[offsets[:-1]]
    if size is None:
        return valid, values
    at = offsets[:-1][valid][:, None] + np.arange(size)[None, :]
    return valid, values[at]


def dimension(vectors: DataFrame, name: str) -> int | None:
    """The length that most of the vectors that count have, the greater of equals."""

    def run(batches):
        for b in batches:
            valid, _ = matrix_of(b.column(0), None)
            sizes, n = np.unique(np.diff(b.column(0).offsets.to_numpy())[valid], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(n, pa.int64())], names=["size", "n"])

    sizes = vectors.select(quoted(name)).mapInArrow(run, "size int, n long").groupBy("size").agg(F.sum("n").alias("n"))
    best = sizes.agg(F.max(F.struct("n", "size")).alias("b")).first().b
    return best.size if best else None


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x of whole numbers below 2 ** 53, as an array of Python's whole numbers."""
    limbs, rest = [], np.abs(x)
    sign = np.sign(x)
    while rest.any() or not limbs:
        limbs.append(sign * np.mod(rest, 2.0**LIMB))
        rest = np.floor(rest / 2.0**LIMB)
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    rows = 1 << (53 - 2 * LIMB)  # sums of so many products of two limbs are exact
    for at in range(0, len(x), rows):
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a[at : at + rows].T @ b[at : at + rows]).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def scatter(vectors: DataFrame, name: str, size: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, sum of products) of floor(1024 * entry), exact."""
    schema = StructType([StructField("i", IntegerType()), StructField("j", IntegerType()), StructField("low", LongType()), StructField("high", StringType())])
    upper = np.triu_indices(size + 1)

    def run(batches):
        total = np.zeros((size + 1, size + 1), dtype=object)
        for b in batches:
            _, x = matrix_of(b.column(0), size)
            if len(x):
                total += exact_products(np.hstack([x, np.ones((len(x), 1))]))
        cells = total[upper]
        # 18 digits at a time are added as numbers; what is above them as decimals
        low = [int(c) % 10**18 for c in cells]
        yield pa.RecordBatch.from_arrays([
            pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(low, pa.int64()),
            pa.array([str(int(c) // 10**18) for c in cells], pa.string()),
        ], names=schema.names)

    cells = vectors.select(quoted(name)).mapInArrow(run, schema)
    sums = cells.groupBy("i", "j").agg(
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high")
    )
    total = np.zeros((size + 1, size + 1), dtype=object)
    for r in sums.collect():  # (size + 1) * (size + 2) / 2 rows
        total[r.i, r.j] = total[r.j, r.i] = int(r.high) * 10**18 + int(r.low)
    return int(total[size, size]), [int(v) for v in total[size, :size]], total[:size, :size]


# ------------------------------------------------------------------ characteristic polynomial

def primes_below(limit: int, n: int) -> list[int]:
    """The n largest primes below `limit` (at most 2 ** 32)."""

    def is_prime(p: int) -> bool:
        if p < 2 or any(p % q == 0 for q in (2, 3, 5, 7, 11, 13) if q != p):
            return False
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for a in (2, 3, 5, 7):  # enough below 3,215,031,751
            x = pow(a, d, p)
            if x in (1, p - 1) or a % p == 0:
                continue
            for _ in range(s - 1):
                x = x * x % p
                if x == p - 1:
                    break
            else:
                return False
        return True

    out, p = [], limit - 1
    while len(out) < n:
        if is_prime(p):
            out.append(p)
        p -= 1
    return out


def polynomial_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - m) modulo a prime below 2 ** 31, the constant first."""
    h = m.copy()
    n = len(h)
    for c in range(n - 2):
        below = np.flatnonzero(h[c + 1 :, c])
        if not len(below):
            continue
        k = c + 1 + int(below[0])
        if k != c + 1:
            h[[c + 1, k]] = h[[k, c + 1]]
            h[:, [c + 1, k]] = h[:, [k, c + 1]]
        factor = h[c + 2 :, c] * pow(int(h[c + 1, c]), -1, p) % p
        h[c + 2 :] = (h[c + 2 :] - factor[:, None] * h[c + 1][None, :] % p) % p
        # the inverse from the right keeps the matrix similar; products are reduced before they are added
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2 :] * factor[None, :] % p).sum(axis=1)) % p
    minors = [np.array([1], dtype=np.int64)]
    for k in range(n):
        own = np.zeros(k + 2, dtype=np.int64)
        own[1:] = minors[k]
        own[:-1] = (own[:-1] - int(h[k, k]) * minors[k]) % p
        product = 1
        for i in range(1, k + 1):
            product = product * int(h[k - i + 1, k - i]) % p
            if not product:
                break
            factor = product * int(h[k - i, k]) % p
            own[: k - i + 1] = (own[: k - i + 1] - factor * minors[k - i]) % p
        minors.append(own % p)
    return [int(v) for v in minors[n]]


def characteristic_polynomial(spark, m: np.ndarray) -> list[int]:
    """Exact coefficients of det(t - m) for a symmetric matrix of whole numbers without negative eigenvalues."""
    n = len(m)
    trace = max(1, int(sum(m[i, i] for i in range(n))))
    bound = max(comb(n, k) * trace**k // n**k + 1 for k in range(n + 1))  # symmetric functions of roots with this sum
    count = (2 * bound + 1).bit_length() // 30 + 1
    primes = primes_below(1 << 31, count)
    shared = spark.sparkContext.broadcast([[int(v) for v in row] for row in m])
    schema = StructType([StructField("p", LongType()), StructField("residues", BinaryType())])

    def run(batches):
        whole = np.array(shared.value, dtype=object)
        for b in batches:
            p = b.column(0).to_pylist()
            found = [np.array(polynomial_mod((whole % q).astype(np.int64), q), np.int64).tobytes() for q in p]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(found, pa.binary())], names=schema.names)

    tasks = min(count, 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    value, modulus = [0] * (n + 1), 1
    for r in rows.mapInArrow(run, schema).collect():  # `count` rows of n + 1 residues
        inverse = pow(modulus, -1, r.p)
        for k, residue in enumerate(np.frombuffer(r.residues, np.int64).tolist()):
            value[k] += modulus * ((residue - value[k]) * inverse % r.p)
        modulus *= r.p
    return [v - modulus if 2 * v > modulus else v for v in value]


# ------------------------------------------------------------------ roots and components

def changes(values: list[int]) -> int:
    signs = [v > 0 for v in values if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def roots_above(poly: list[int], at: int, bits: int) -> int:
    """How many roots of a polynomial with real roots only lie above at / 2 ** bits, with multiplicity."""
    n = len(poly) - 1
    shifted = [c << (bits * (n - k)) for k, c in enumerate(poly)]  # roots times 2 ** bits
    for i in range(n):
        for k in range(n - 1, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    return changes(shifted)


def largest_roots(poly: list[int], want: int, digits: int = DIGITS) -> list[tuple[Fraction, int]]:
    """(root, multiplicity) from the largest on, until `want` positive roots are covered; `digits` bits right."""
    top = 1
    while roots_above(poly, top, 0):
        top *= 2
    positive = roots_above(poly, 0, 0)
    want = min(want, positive)
    out: list[tuple[Fraction, int]] = []
    found = 0
    stack = [(0, top, 0, positive, 0)]  # (low, high, bits, roots above low, roots above high): the largest part on top
    while stack and found < want:
        low, high, bits, above_low, above_high = stack.pop()
        if above_low == above_high:
            continue
        if low.bit_length() >= digits and high - low == 1:
            out.append((Fraction(low + high, 2 << bits), above_low - above_high))
            found += above_low - above_high
            continue
        if above_low - above_high == 1 and low > 0:
            low, high, bits = _refined(poly, low, high, bits, digits, above_high % 2 == 0)
            out.append((Fraction(low + high, 2 << bits), 1))
            found += 1
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        above = roots_above(poly, middle, bits)
        stack.append((low, middle, bits, above_low, above))
        stack.append((middle, high, bits, above, above_high))
    return out


def _refined(poly: list[int], low: int, high: int, bits: int, digits: int, positive_above: bool) -> tuple[int, int, int]:
    """Halve an interval (low, high] / 2 ** bits with one root until `digits` bits are right, by the sign of the polynomial."""
    n = len(poly) - 1
    while high - low > 1 or low.bit_length() < digits:
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        value = 0
        for k in range(n, -1, -1):
            value = value * middle + (poly[k] << (bits * (n - k)))
        if value == 0 or (value > 0) == positive_above:
            high = middle
        else:
            low = middle
    return low, high, bits


def null_vectors(m: np.ndarray, root: Fraction, count: int, precision: int = PRECISION) -> np.ndarray:
    """`count` orthonormal vectors of the eigenvalue `root` (multiplicity `count`) by inverse iteration, one a column.

    Whole numbers stand for multiples of 2 ** -precision, relative to the largest entry of the matrix.
    """
    n = len(m)
    scale = max(1, int(np.abs(m).max()))
    one = 1 << precision
    a = [[((int(m[i, j]) << precision) // scale) - (int(root * one / scale) if i == j else 0) for j in range(n)] for i in range(n)]
    order = list(range(n))
    for c in range(n):  # elimination with row exchanges; factors are kept below the diagonal
        k = max(range(c, n), key=lambda r: abs(a[r][c]))
        a[c], a[k] = a[k], a[c]
        order[c], order[k] = order[k], order[c]
        a[c][c] = a[c][c] or 1  # the smallest number instead of a zero pivot: that is what the iteration blows up
        pivot, top = a[c][c], a[c]
        for r in range(c + 1, n):
            row = a[r]
            if row[c]:
                f = row[c] = (row[c] << precision) // pivot
                row[c + 1 :] = [v - (f * t >> precision) for v, t in zip(row[c + 1 :], top[c + 1 :], strict=True)]

    def solve(b: list[int]) -> list[int]:
        x = [b[k] for k in order]
        for r in range(n):
            x[r] -= sum(f * v for f, v in zip(a[r][:r], x, strict=False)) >> precision
        for r in range(n - 1, -1, -1):
            x[r] = ((x[r] << precision) - sum(f * v for f, v in zip(a[r][r + 1 :], x[r + 1 :], strict=True))) // a[r][r]
        return x

    def unit(x: list[int]) -> list[int]:
        low = max(0, max(map(abs, x)).bit_length() - 2 * precision)
        x = [v >> low for v in x]
        norm = isqrt(sum(v * v for v in x)) or 1
        return [(v << precision) // norm for v in x]

    rng = np.random.default_rng(7)
    block = [unit([int(v) << precision - 20 for v in rng.integers(-(1 << 20), 1 << 20, n)]) for _ in range(count)]
    for _ in range(3):
        fresh: list[list[int]] = []
        for x in map(solve, block):
            x = unit(x)
            for _ in range(2):
                for f in fresh:
                    dot = sum(p * q for p, q in zip(x, f, strict=True)) >> precision
                    x = [p - (dot * q >> precision) for p, q in zip(x, f, strict=True)]
            fresh.append(unit(x))
        block = fresh
    return np.array([[v / one for v in x] for x in block]).T


class Components:
    """What whitening needs: n, sums, eigenvalues of the covariance (as fractions) and unit eigenvectors (columns)."""

    def __init__(self, n: int, sums: list[int], values: list[Fraction], vectors: np.ndarray, trace: Fraction):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        self.floor = np.array([s // n for s in sums], dtype=np.float64)
        self.rest = np.array([(s % n) / n for s in sums])

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.floor) - self.rest) @ self.vectors / np.sqrt(np.array([float(v) for v in self.values]))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n * x - S) ** 2 over the dimensions of each row, exact."""
        gaps, rest = (x - self.floor).astype(np.int64), [s % self.n for s in self.sums]
        fits = len(x) == 0 or (int(np.abs(gaps).max()) + 1) * self.n <= isqrt((1 << 63) // len(rest)) - 1
        kind = np.int64 if fits else object
        scaled = gaps.astype(kind) * self.n - np.array(rest, dtype=kind)
        return [int(v) for v in (scaled * scaled).sum(axis=1)]


def fit(vectors: DataFrame, name: str = "embedding", components: int = 8) -> tuple[Components | None, int | None]:
    """(components, dimension); None where nothing can be whitened."""
    size = dimension(vectors, name)
    if size is None:
        return None, None
    n, sums, products = scatter(vectors, name, size)
    s = np.array(sums, dtype=object)
    m = n * products - s[:, None] * s[None, :]
    trace = int(sum(m[i, i] for i in range(size)))
    if trace == 0:
        return None, size
    shared = gcd(*map(int, m.reshape(-1)))
    small = m // shared
    roots = largest_roots(characteristic_polynomial(vectors.sparkSession, small), components)
    values, columns = [], []
    for root, many in roots:
        columns.append(null_vectors(small, root, many))
        values += [root * shared / n**2] * many
    kept = min(components, len(values))
    return Components(n, sums, values[:kept], np.hstack(columns)[:, :kept], Fraction(trace, n**2)), size


def identity_error(vectors: DataFrame, name: str, size: int, fitted: Components) -> float:
    """Largest entry of |covariance of the whitened vectors - identity|, every batch centred at its own mean."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(fitted)
    k = len(fitted.values)
    fields = [f"m{i}" for i in range(k)] + [f"c{i}_{j}" for i in range(k) for j in range(k)]
    schema = StructType([StructField("n", LongType())] + [StructField(f, DoubleType()) for f in fields])

    def run(batches) -> Iterator[pa.RecordBatch]:
        n, mean, inner = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            _, x = matrix_of(b.column(0), size)
            if not len(x):
                continue
            w = shared.value.whiten(x)
            own = w.mean(axis=0)
            gap, both = own - mean, n + len(w)
            inner += (w - own).T @ (w - own) + np.outer(gap, gap) * n * len(w) / both
            mean, n = mean + gap * len(w) / both, both
        numbers = [n, *mean, *inner.reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in [int(n), *map(float, numbers[1:])]], names=schema.names)

    parts = vectors.select(quoted(name)).mapInArrow(run, schema)
    total = parts.agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(f"m{i}")).alias(f"m{i}") for i in range(k)],
        *[F.sum(F.col(f"c{i}_{j}") + F.col("n") * F.col(f"m{i}") * F.col(f"m{j}")).alias(f"c{i}_{j}") for i in range(k) for j in range(k)],
    ).first()
    mean = np.array([total[f"m{i}"] for i in range(k)]) / total.n
    inner = np.array([[total[f"c{i}_{j}"] for j in range(k)] for i in range(k)]) / total.n - np.outer(mean, mean)
    return float(np.abs(inner - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", name: str = "embedding", components: int = 8) -> DataFrame:
    """One row per vector that counts and component: vec_id, component, n, deviation (null where it needs more than 63
    bits), deviation_digits (the same in decimal), whitened, explained, identity_error."""
    spark = vectors.sparkSession
    vectors = vectors.select(quoted(vec_id).alias("vec_id"), quoted(name).cast("array<double>").alias("embedding"))
    schema = StructType([
        vectors.schema["vec_id"], StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()),
        StructField("deviation_digits", StringType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
        StructField("identity_error", DoubleType()),
    ])
    fitted, size = fit(vectors, "embedding", components)
    if fitted is None:
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, "embedding", size, fitted)
    shared = spark.sparkContext.broadcast(fitted)
    k = len(fitted.values)

    def run(batches) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            valid, x = matrix_of(b.column(1), size)
            rows = len(x)
            ids = b.column(0).filter(pa.array(valid))
            deviations = [d for d in own.deviations(x) for _ in range(k)]
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                pa.array(np.full(rows * k, own.n), pa.int64()), pa.array([d if d < 1 << 63 else None for d in deviations], pa.int64()),
                pa.array(list(map(str, deviations)), pa.string()), pa.array(own.whiten(x).reshape(-1), pa.float64()),
                pa.array(np.tile(own.explained, rows), pa.float64()), pa.array(np.full(rows * k, error), pa.float64()),
            ], names=schema.names)

    return vectors.mapInArrow(run, schema)
