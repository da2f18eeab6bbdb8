"""Embedding whitening by an exact characteristic polynomial.

Entries become integers, x = floor(1024 c) + 100000. One pass sums n, S and the
products of x exactly (limbs small enough for exact float products; carries are
added as decimals), which gives the integer scatter n sum(x x') - S S' = n^2 V.
Its characteristic polynomial is found modulo primes of 31 bits, each reduced to
Hessenberg form by itself in a Spark task, and put together by Chinese
remaindering: as many primes as the bound of the coefficients asks for.

All roots of that polynomial are real, so the sign changes of its Taylor shift
to a place count the roots above it exactly (Descartes' rule). Bisection on that
count isolates the largest roots, with their multiplicity; a simple root is then
refined by the polynomial's sign, to 128 bits.
A root's components span the null space of scatter - root: inverse iteration in
fixed point of four times that width, orthogonal within a multiple root. They are unit
vectors, rounded to doubles at the end. A second pass whitens all rows.

Defined results: rows whose vector is NULL, or holds a NULL, NaN or infinite
entry are dropped; so are vectors of another length than most have (ties: the
longest). Repeated rows count as often as they occur, a NULL id is kept.
Components of eigenvalue 0 are left out, as whitening divides by its root: with
equal vectors, empty ones or no rows there is no component, and no row. A
``deviation`` beyond 63 bits is NULL (``deviation_text`` always has its digits).
Entries so large that x passes 62 bits raise an error of their own. Other
columns are not read.
"""

from __future__ import annotations

from math import isqrt, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import written

SCALE, SHIFT = 1024, 100_000  # fixed values of the integer form
LIMB = 15


# ------------------------------------------------------------------ exact sums
def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 c), without the shift, as long."""
    y = np.floor(vectors.astype(np.float64) * SCALE)
    if y.size and np.abs(y).max() >= 2.0 ** 62:
        raise ValueError("an entry times 1024 passes 62 bits")
    return y.astype(np.int64)


def exact_products(y: np.ndarray) -> np.ndarray:
    """Y'Y as Python integers: limbs of 15 bits, so that the products of 2^20 rows stay below 2^53."""
    limbs, rest = [], y
    while True:
        top = not rest.size or (np.abs(rest).max() < 1 << LIMB)
        limbs.append(rest.astype(np.float64) if top else (rest & ((1 << LIMB) - 1)).astype(np.float64))
        if top:
            break
        rest = rest >> LIMB
    out = np.zeros((y.shape[1],) * 2, object)
    for lo in range(0, len(y), 1 << 20):
        part = [x[lo:lo + (1 << 20)] for x in limbs]
        for i, a in enumerate(part):
            for j, b in enumerate(part):
                out += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return out


def vectors_of(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _sums(d: int):
    """(vector) -> (i, j, high, low): the sums y_i (j = -1) and y_i y_j of a task, value = high 2^60 + low; (-1, -1): the rows."""
    def run(batches):
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            y = whole_numbers(vectors_of(batch.column(0), d))
            n += len(y)
            sums += y.astype(object).sum(axis=0) if len(y) else 0
            products += exact_products(y)
        if n:
            cells = [(-1, -1, n), *((i, -1, sums[i]) for i in range(d)), *((i, j, products[i, j]) for i in range(d) for j in range(i + 1))]
            i, j, value = zip(*cells)
            kind = pa.decimal128(38, 0)
            from decimal import Decimal
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v) >> 60) for v in value], kind),
                 pa.array([Decimal(int(v) & ((1 << 60) - 1)) for v in value], kind)], names=["i", "j", "high", "low"])
    return run


def exact_scatter(rows: DataFrame, vector: str, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S (of x) and the integer matrix n sum(x x') - S S' of clean vectors. The driver gets one row for each of its cells."""
    cells = (rows.select(vector).mapInArrow(_sums(d), "i int, j int, high decimal(38,0), low decimal(38,0)")
             .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    value = {(r["i"], r["j"]): (int(r["high"]) << 60) + int(r["low"]) for r in cells}
    n = value.get((-1, -1), 0)
    y = [value.get((i, -1), 0) for i in range(d)]
    scatter = [[0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i + 1):
            scatter[i][j] = scatter[j][i] = n * value.get((i, j), 0) - y[i] * y[j]  # the shift cancels
    return n, [s + n * SHIFT for s in y], scatter


# ------------------------------------------------------------------ characteristic polynomial
def primes_below(top: int):
    """Primes downward from ``top``, by trial with the bases that decide 32-bit numbers."""
    def is_prime(m: int) -> bool:
        s, t = m - 1, 0
        while s % 2 == 0:
            s, t = s // 2, t + 1
        for base in (2, 7, 61):  # fixed values: enough below 4,759,123,141
            x = pow(base, s, m)
            if x in (1, m - 1):
                continue
            for _ in range(t - 1):
                x = x * x % m
                if x == m - 1:
                    break
            else:
                return False
        return True
    m = top - 1 - (top % 2)
    while m > 61:
        if is_prime(m):
            yield m
        m -= 2


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of det(t - matrix) modulo a prime below 2^31, by Hessenberg reduction.

    Columns are cleared below the subdiagonal by similar row and column steps
    (a zero pivot is swapped with a row and column that has another); the
    polynomials of the leading blocks then follow from each other.
    """
    h = matrix.astype(np.int64) % p
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        s = k + 1 + int(below[0])
        if s != k + 1:
            h[[k + 1, s]] = h[[s, k + 1]]
            h[:, [k + 1, s]] = h[:, [s, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1][None, :] % p) % p
        # the matching column step: column k + 1 gains the sum of factor times the later columns
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor[None, :] % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polys[k - 1, :-1]
        new = (new - h[k - 1, k - 1] * polys[k - 1]) % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            new = (new - chain * int(h[i - 1, k - 1]) % p * polys[i - 1]) % p
        polys[k] = new
    return polys[d]


def characteristic_polynomial(spark, scatter: list[list[int]]) -> list[int]:
    """Integer coefficients, lowest first, of det(t - scatter); one Spark row for each prime."""
    d = len(scatter)
    # the roots are 0 or above and sum to the trace, so no coefficient passes (1 + trace / d)^d 2^d
    bound = 2 * (2 * (1 + sum(scatter[i][i] for i in range(d)) // max(1, d) + 1)) ** d + 1
    primes, product = [], 1
    for p in primes_below(1 << 31):
        if product > bound:
            break
        primes.append(p)
        product *= p
    texts = [[str(x) for x in row] for row in scatter]

    def run(batches):
        exact = np.array([[int(x) for x in row] for row in texts], object).reshape(d, d)
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_modulo((exact % p).astype(np.int64), p).tolist() for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    rows = (spark.range(0, len(primes), 1, tasks).select(F.element_at(F.lit(primes), (F.col("id") + 1).cast("int")).alias("p"))
            .mapInArrow(run, "p long, c array<long>").collect())
    out = [0] * (d + 1)
    for r in rows:
        p = r["p"]
        rest = product // p
        unit = rest * pow(rest, -1, p)
        for k, c in enumerate(r["c"]):
            out[k] = (out[k] + c * unit) % product
    return [c - product if c > product // 2 else c for c in out]


# ------------------------------------------------------------------ roots
def taylor_shift(poly: list[int], at: int) -> list[int]:
    """Coefficients of poly(t + at)."""
    c = list(poly)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += at * c[k + 1]
    return c


def roots_above(poly: list[int], at: int) -> int:
    """Number of roots above ``at``, with multiplicity, of a polynomial that has real roots only: sign changes of the shift."""
    signs = [c > 0 for c in taylor_shift(poly, at) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(poly: list[int], at: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * at + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], most: int, bits: int) -> list[tuple[int, int, int]]:
    """(root, multiplicity, scale): the largest positive roots, at least ``most`` in all if there are so many, as root / 2^scale
    from below, to a relative 2^-bits.

    Roots that agree to that width count as one of their joint multiplicity.
    """
    d = len(poly) - 1
    top = max(1, -poly[d - 1]) + 1 if d else 1  # the trace
    total = roots_above(poly, 0)
    out, above, hi = [], 0, top
    scale, scaled = 0, poly
    while above < min(most, total):
        # place with more than ``above`` roots over it, just below the next root
        lo, up = 0, hi << scale if not out else out[-1][0]
        found, single = None, 0
        while True:
            while up - lo > 1 and (lo == 0 or (up - lo).bit_length() + bits > lo.bit_length()):
                mid = (lo + up) // 2
                if single:  # one simple root in (lo, up]: the sign at lo tells the side
                    over = sign_at(scaled, mid) == single
                else:
                    over = (count := roots_above(scaled, mid)) > above
                    if over and count == above + 1:
                        single = sign_at(scaled, mid)  # 0: mid is the next root itself
                if over:
                    lo = mid
                else:
                    up = mid
            if lo and (up - lo).bit_length() + bits <= lo.bit_length():
                found = lo
                break
            # no integer between: finer steps, t = s / 2^64
            scale += 64
            scaled = [c << (64 * (d - k)) for k, c in enumerate(scaled)]
            lo, up = lo << 64, up << 64
            out = [(r << 64, m, scale) for r, m, _ in out]
        count = roots_above(scaled, found) - above
        out.append((found, count, scale))
        above += count
    return out


def null_vectors(scatter: list[list[int]], root: int, scale: int, count: int, bits: int) -> list[list[int]]:
    """Unit vectors of the null space of scatter - root / 2^scale, as fixed point numbers of ``bits``: inverse iteration.

    The elimination with row pivots is done once; each of ``count`` starting
    vectors is solved for twice, made orthogonal to the earlier ones and scaled.
    """
    d, one = len(scatter), 1 << bits
    norm = max(1, sum(scatter[i][i] for i in range(d)))
    fixed = lambda num, den: (num << bits) // den
    a = np.array([[fixed((x << scale) - (root if i == j else 0), norm << scale) for j, x in enumerate(row)] for i, row in enumerate(scatter)], object).reshape(d, d)
    steps = []
    for k in range(d):
        s = max(range(k, d), key=lambda i: abs(a[i, k]))
        if s != k:
            a[[k, s]] = a[[s, k]]
        if a[k, k] == 0:
            a[k, k] = 1  # the root is exact: a least step beside it
        factor = np.array([(x << bits) // a[k, k] for x in a[k + 1:, k]], object)
        if k + 1 < d:
            a[k + 1:, k:] -= (factor[:, None] * a[k, k:][None, :]) >> bits
        steps.append((s, factor))

    def unit(v):
        big = max(abs(x) for x in v) or 1
        v = [(x << bits) // big for x in v]
        length = isqrt(sum(x * x for x in v)) or 1
        return [(x << bits) // length for x in v]

    def solve(v):
        v = np.array(v, object)
        for k, (s, factor) in enumerate(steps):
            v[k], v[s] = v[s], v[k]
            if k + 1 < d:
                v[k + 1:] -= (factor * v[k]) >> bits
        for k in range(d - 1, -1, -1):
            v[k] = ((v[k] - ((a[k, k + 1:] @ v[k + 1:]) >> bits if k + 1 < d else 0)) << bits) // a[k, k]
        return unit(list(v))

    def apart(v, others):
        for _ in (0, 1):
            for u in others:
                dot = sum(x * y for x, y in zip(u, v)) >> bits
                v = [x - (dot * y >> bits) for x, y in zip(v, u)]
            v = unit(v)
        return v

    found: list[list[int]] = []
    for m in range(count):
        v = unit([one // (1 + (7 * i + 3 * m) % 11) + (one if i == m else 0) for i in range(d)])
        for _ in (0, 1):
            v = apart(solve(apart(v, found)), found)
        found.append(v)
    return found


def components_of(spark, n: int, scatter: list[list[int]], most: int, bits: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) by falling eigenvalue, eigenvalues of the covariance, and their shares of the trace."""
    poly = characteristic_polynomial(spark, scatter)
    trace = sum(scatter[i][i] for i in range(len(scatter)))
    vectors, values, shares = [], [], []
    for root, count, scale in largest_roots(poly, most, bits):
        # the working width holds the root's distance from 0 and the squares of its own error
        for v in null_vectors(scatter, root, scale, count, 4 * bits):
            vectors.append([float(x / (1 << 4 * bits)) if abs(x) < 1 << 1000 else (x >> (4 * bits - 200)) / 2.0 ** 200 for x in v])
            values.append(((root << 60) // ((n * n) << scale)) / 2.0 ** 60 if root >> scale < n * n << 40 else (root >> scale) / (n * n))
            shares.append(((root << 80) // (trace << scale)) / 2.0 ** 80)
    k = min(most, len(vectors))
    return np.array(vectors[:k]).reshape(k, len(scatter)).T, np.array(values[:k]), np.array(shares[:k])


# ------------------------------------------------------------------ the operator
def clean_vectors(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows whose vector is complete, finite and of the usual length, and that length."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    v = F.transform(vector, lambda c: c.cast("double"))
    clean = rows.withColumn(vector, v).where(F.col(vector).isNotNull() & F.forall(vector, entry))
    usual = clean.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = usual["d"] if usual else 0
    return clean.where(F.size(vector) == d), d


def _whitened(d: int, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray):
    total = [int(s) for s in sums]

    def run(batches):
        scaled, root = vectors, np.sqrt(values)
        for batch in batches:
            y = whole_numbers(vectors_of(batch.column(1), d))
            off = [s - n * SHIFT for s in total]
            most = max((abs(int(x)) for x in (y.min(initial=0), y.max(initial=0))), default=0)
            if 4 * d * (2 * n * max(1, most)) ** 2 < 1 << 62:
                gap = n * y - np.array(off, np.int64)
                deviation = [int(x) for x in (gap * gap).sum(axis=1)]
            else:
                gap = n * y.astype(object) - np.array(off, object)
                deviation = [int(x) for x in (gap * gap).sum(axis=1)]
                gap = np.array([[x / n for x in row] for row in gap], np.float64) * n
            white = (gap.astype(np.float64) / n) @ scaled / root
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x if x < 1 << 63 else None for x in deviation], pa.int64()),
                 pa.array([str(x) for x in deviation]), pa.array(list(white), pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "deviation_text", "white"])
    return run


def whiten(rows: DataFrame, most: int = 8, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row for each clean vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error`` (of the covariance of all whitened rows), ``deviation_text``."""
    spark = rows.sparkSession
    rows, d = clean_vectors(rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("_v")), "_v")
    rows = written(rows, "vectors")
    n, sums, scatter = exact_scatter(rows, "_v", d)
    vectors, values, shares = components_of(spark, n, scatter, most) if n and d else (np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    k = len(values)
    kind = rows.schema["vec_id"].dataType.simpleString()
    white = written(rows.select("vec_id", "_v").mapInArrow(
        _whitened(d, n, sums, vectors, values), f"vec_id {kind}, deviation long, deviation_text string, white array<double>"), "white") \
        if k else spark.createDataFrame([], f"vec_id {kind}, deviation long, deviation_text string, white array<double>")
    error = None
    if k:
        means = white.select(*(F.avg(F.get("white", F.lit(i))).alias(f"m{i}") for i in range(k))).first()
        centred = [F.get("white", F.lit(i)) - F.lit(means[i]) for i in range(k)]
        cov = white.select(*((F.sum(centred[i] * centred[j]) / F.lit(n)).alias(f"c{i}_{j}") for i in range(k) for j in range(i + 1))).first()
        error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i + 1))
    share = F.lit([float(x) for x in shares]) if k else F.array().cast("array<double>")
    return (white.select("vec_id", "deviation", "deviation_text", F.posexplode("white").alias("_p", "whitened"))
            .select("vec_id", (F.col("_p") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("_p")).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_text"))
