"""Embedding whitening through an exact characteristic polynomial (operator 12).

Every entry c of a usable vector becomes the integer x = floor(1024 * c) +
100000.  With n vectors and per-dimension sums S the matrix

    A = n * sum(z z') - T T',   z = x - m,  m = S rounded to n,  T = S - n * m

is an integer matrix and equals n * n times the covariance V of x; nothing in
it is rounded.  The components come from A in three exact or high-precision
steps:

1. Characteristic polynomial: for each of enough primes below 2 ** 31, A is
   brought to Hessenberg form modulo the prime and its polynomial is read off;
   the integer coefficients are put together by Chinese remaindering.  The
   bound on the coefficients (the trace's powers times binomials) says how many
   primes are enough.  Primes are rows of a Spark job.
2. Root isolation: all roots are real, so the number of roots above a point is
   exactly the number of sign changes of the polynomial shifted to that point
   (Descartes' rule).  Bisection on integers (of a scaled polynomial) isolates
   the largest roots with their multiplicities, to at least 2 ** -80 of each.
3. Null-space inverse iteration: (A - e I) is factored in fixed-point integers
   of a few hundred bits and start vectors are solved twice; a root of
   multiplicity r takes r start vectors, kept orthogonal.

Spark does the rest: sums and products are partial sums per task (integers cut
into 32-bit digits that Spark adds as long), projections are one pass, and the
whitened covariance is measured on the whitened rows themselves.  The driver
holds matrices of dimension x dimension only.

Defined results: rows with a null vector, a null or a non-finite entry are
left out; shorter vectors count as padded with zeros; entries are held within
+-2 ** 52; null and repeated ids are rows like others; components whose
eigenvalue is exactly zero are not returned (nothing can be scaled to variance
one), so one vector, or n equal ones, give no rows, and neither does an empty
table.  Equal eigenvalues keep their numbers; any orthonormal basis of their
space may stand for them.  ``deviation`` is null where the exact value does
not fit a long; ``deviation_exact`` (decimal) always holds it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 52
DIGIT = 32
ROOT_BITS = 80


# ---- vectors and exact sums -------------------------------------------------

def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v array<double>`` of rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (df.filter(v.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")))


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    """x of a batch's vectors as an integer matrix, without the shift by 100000."""
    off = col.offsets.to_numpy()
    flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
    off = off - off[0]
    c = np.zeros((len(col), dims))
    sizes = np.diff(off)
    if (sizes == dims).all():
        c[:] = flat.reshape(len(col), dims)
    else:
        row = np.repeat(np.arange(len(col)), sizes)
        c[row, np.arange(len(flat)) - np.repeat(off[:-1], sizes)] = flat
    return np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64)


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """Places and digits of an integer; the sign goes to every digit."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << DIGIT) - 1))
        value >>= DIGIT
        place += 1


def _product(z: np.ndarray) -> np.ndarray:
    """z' z as exact integers (object matrix): limbs small enough for float products."""
    most = int(np.abs(z).max(initial=0))
    width = (52 - max(len(z), 1).bit_length()) // 2
    limbs, rest = [], z
    while True:
        if most < (1 << width):
            limbs.append(rest.astype(np.float64))
            break
        limbs.append((rest & ((1 << width) - 1)).astype(np.float64))
        rest, most = rest >> width, (most >> width) + 1
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << (width * (i + j)))
    return total


SUMS = "kind int, i int, j int, place int, digit long"


def _add_up(parts: DataFrame) -> dict[tuple[int, int, int], int]:
    """Integers by (kind, i, j) from digit sums."""
    out: dict[tuple[int, int, int], int] = {}
    for r in parts.groupBy("kind", "i", "j", "place").agg(F.sum("digit").alias("digit")).collect():
        k = (r["kind"], r["i"], r["j"])
        out[k] = out.get(k, 0) + (r["digit"] << (DIGIT * r["place"]))
    return out


def _sum_rows(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    rows = [(k, i, j, p, d) for k, i, j, value in found for p, d in _digits(value)]
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=["kind", "i", "j", "place", "digit"])


def moments(rows: DataFrame) -> tuple[int, list[int]]:
    """``n`` and the per-dimension sums of x - 100000 (as long as the longest vector)."""
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if not dims:
        return 0, []

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for b in batches:
            for at in range(0, b.num_rows, 1024):  # 1024 * 2 ** 52 fits a long
                z = _matrix(b.column(0).slice(at, 1024), dims)
                n, total = n + len(z), total + z.sum(axis=0).astype(object)
        yield _sum_rows([(0, 0, 0, n)] + [(1, i, 0, int(s)) for i, s in enumerate(total)])

    got = _add_up(rows.select("v").mapInArrow(add, SUMS))
    return got.get((0, 0, 0), 0), [got.get((1, i, 0), 0) for i in range(dims)]


def scatter(rows: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """The integer matrix n * n * covariance, centred before multiplying."""
    dims = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, centre, strict=True)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                total = total + _product(_matrix(b.column(0).slice(at, 8192), dims) - centre)
        yield _sum_rows([(2, i, j, int(total[i, j])) for i in range(dims) for j in range(i, dims)])

    got = _add_up(rows.select("v").mapInArrow(add, SUMS))
    a = [[0] * dims for _ in range(dims)]
    for i in range(dims):
        for j in range(i, dims):
            a[i][j] = a[j][i] = n * got.get((2, i, j), 0) - rest[i] * rest[j]
    return a


# ---- characteristic polynomial ------------------------------------------------

def _is_prime(n: int) -> bool:
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):  # enough below 3.2 thousand million
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2 ** 31, downwards, with a product above ``2 ** bits``."""
    out, p, product = [], (1 << 31) - 1, 1
    while product.bit_length() <= bits + 1:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (lowest first, monic) of det(t I - a) modulo the prime ``p``."""
    h, d = a % p, len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        at = m + int(below[0])
        if at != m:
            h[[m, at]] = h[[at, m]]
            h[:, [m, at]] = h[:, [at, m]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        # Rows below lose u times row m; column m gains the columns below times u.
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(axis=1)) % p
    polys = [np.zeros(d + 1, np.int64)]
    polys[0][0] = 1
    for k in range(1, d + 1):
        last = polys[-1]
        q = (np.roll(last, 1) - int(h[k - 1, k - 1]) * last % p) % p
        run = 1
        for i in range(1, k):
            run = run * int(h[k - i, k - i - 1]) % p
            if not run:
                break
            q = (q - run * int(h[k - i - 1, k - 1]) % p * polys[k - i - 1] % p) % p
        polys.append(q)
    return polys[d]


def polynomial(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Exact coefficients of det(t I - A), lowest first, for a positive semidefinite A."""
    d = len(a)
    trace = sum(a[i][i] for i in range(d))
    # e_k <= C(d, k) * (trace / d) ** k for non-negative roots.
    bits = max((math.comb(d, k) * (trace // d + 1) ** k).bit_length() for k in range(d + 1))
    text = [[str(x) for x in row] for row in a]

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exact = [[int(x) for x in row] for row in text]
        for f in frames:
            for p in f["p"]:
                m = np.array([[x % int(p) for x in row] for row in exact], np.int64)
                yield pd.DataFrame({"p": [int(p)], "c": [polynomial_mod(m, int(p)).tolist()]})

    ps = primes(bits + 1)
    work = spark.createDataFrame([(p,) for p in ps], "p long").repartition(min(len(ps), 32))
    value, modulus = [0] * (d + 1), 1
    for r in work.mapInPandas(residues, "p long, c array<long>").collect():
        p, inverse = r["p"], pow(modulus, -1, r["p"])
        value = [v + modulus * ((c - v) * inverse % p) for v, c in zip(value, r["c"], strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


# ---- roots and components -------------------------------------------------------

def roots_above(coefficients: list[int], at: int) -> int:
    """Number of roots above ``at``, of a polynomial with real roots only."""
    c = list(coefficients)
    for i in range(len(c) - 1):  # Horner's scheme shifts the polynomial to ``at``
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _above_zero(c: list[int]) -> int:
    """Number of positive roots, counted by multiplicity."""
    return len(c) - 1 - next(i for i, x in enumerate(c) if x)


def _value_sign(c: list[int], at: int) -> int:
    v = reduce(lambda acc, x: acc * at + x, reversed(c), 0)
    return (v > 0) - (v < 0)


def largest_roots(c: list[int], count: int, bits: int = ROOT_BITS) -> list[tuple[int, int, int]]:
    """Largest positive roots ``(r, scale bits, multiplicity)``, root = r / 2 ** scale.

    Stops once ``count`` roots, multiplicities included, are covered.
    """
    d, out, covered = len(c) - 1, [], 0
    count = min(count, _above_zero(c))
    high = max(-c[-2], 1)  # the sum of all roots
    while covered < count:
        scale, q, low, top, alone = 0, c, 0, high, False
        while True:
            # Bisect to a unit bracket (low, top] of the largest root not covered.
            while top - low > 1:
                mid = (low + top) // 2
                if alone:  # one simple root in the bracket: the sign tells its side
                    above = _value_sign(q, mid) == (-1) ** (covered + 1)
                else:
                    n = roots_above(q, mid)
                    above, alone = n > covered, n == covered + 1
                low, top = (mid, top) if above else (low, mid)
            if low.bit_length() > bits:
                break
            step = bits + 1 - low.bit_length()  # a finer unit
            scale += step
            q = [x << (scale * (d - i)) for i, x in enumerate(c)]
            low, top = low << step, top << step
        many = 1 if alone else roots_above(q, low) - covered
        out.append((2 * low + 1, scale + 1, many))
        covered += many
        high = (top >> scale) + 1
    return out


def null_space(a: list[list[int]], root: int, scale: int, many: int) -> np.ndarray:
    """``many`` orthonormal rows spanning the eigenspace of ``root / 2 ** scale``."""
    d = len(a)
    bits = 256 + 2 * max(abs(x) for row in a for x in row).bit_length()
    m = np.array([[x << bits for x in row] for row in a], object)
    for i in range(d):
        m[i, i] -= (root << bits) >> scale
    size = max(int(np.abs(m).max()).bit_length() - bits, 1)
    m = np.array([[int(x) >> size for x in row] for row in m], object)  # entries below one
    rng = np.random.default_rng(7)
    rhs = np.array([[int(x) << (bits - 20) for x in row]
                    for row in rng.integers(-(1 << 20), 1 << 20, (d, many))], object)
    upper, perm, factor = m, list(range(d)), np.zeros((d, d), object)
    for k in range(d):
        at = k + int(np.argmax([abs(x) for x in upper[k:, k]]))
        if at != k:
            upper[[k, at]] = upper[[at, k]]
            factor[[k, at]] = factor[[at, k]]
            perm[k], perm[at] = perm[at], perm[k]
        if upper[k, k] == 0:
            upper[k, k] = 1  # an exact root: the smallest number stands for zero
        for i in range(k + 1, d):
            if upper[i, k]:
                f = (upper[i, k] << bits) // upper[k, k]
                factor[i, k] = f
                upper[i, k:] -= (f * upper[k, k:]) >> bits

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[perm].copy()
        for i in range(d):
            for k in range(i):
                if factor[i, k]:
                    y[i] = y[i] - ((factor[i, k] * y[k]) >> bits)
        for i in range(d - 1, -1, -1):
            for k in range(i + 1, d):
                y[i] = y[i] - ((upper[i, k] * y[k]) >> bits)
            y[i] = np.array([(int(v) << bits) // int(upper[i, i]) for v in y[i]], object)
        return y

    for _ in range(2):
        rhs = solve(rhs)
        # Gram-Schmidt in fixed point, each vector scaled to about one.
        for j in range(many):
            for _again in range(2):
                v = rhs[:, j]
                top = max(abs(int(x)) for x in v).bit_length()
                v = np.array([(int(x) << bits) >> top for x in v], object)
                for o in range(j):
                    w = rhs[:, o]
                    dot = int((v * w).sum()) >> bits
                    v = v - ((dot * w) >> bits)
                norm = math.isqrt(int((v * v).sum()))
                v = np.array([(int(x) << bits) // max(norm, 1) for x in v], object)
                rhs[:, j] = v
    return np.array([[int(x) / (1 << bits) for x in rhs[:, j]] for j in range(many)])


def components(spark: SparkSession, a: list[list[int]], count: int) -> tuple[list[float], np.ndarray]:
    """Shares of the trace (relative eigenvalues) and unit rows, largest first.

    ``a`` is an integer covariance times any positive factor.
    """
    g = reduce(math.gcd, (x for row in a for x in row), 0)
    if not g:
        return [], np.zeros((0, len(a)))
    a = [[x // g for x in row] for row in a]
    trace = sum(a[i][i] for i in range(len(a)))
    found = largest_roots(polynomial(spark, a), count)
    text = [[str(x) for x in row] for row in a]

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exact = [[int(x) for x in row] for row in text]
        for f in frames:
            for k, root, scale, many in f.itertuples(index=False):
                v = null_space(exact, int(root), int(scale), int(many))
                yield pd.DataFrame({"k": [k] * len(v), "v": v.tolist()})

    work = spark.createDataFrame([(k, str(r), s, m) for k, (r, s, m) in enumerate(found)],
                                 "k int, root string, scale int, many int").repartition(len(found), "k")
    spaces: dict[int, list] = {}
    for r in work.mapInPandas(solve, "k int, v array<double>").collect():
        spaces.setdefault(r["k"], []).append(r["v"])
    shares, rows = [], []
    for k, (r, s, _) in enumerate(found):
        for v in spaces[k]:
            shares.append(r / (trace << s))
            rows.append(v)
    return shares[:count], np.array(rows[:count])


# ---- whitening --------------------------------------------------------------------

def _projector(n: int, sums: list[int], a: list[list[int]], shares: list[float], vectors: np.ndarray):
    """A function from integer rows to whitened rows."""
    variance = [s * (sum(a[i][i] for i in range(len(a))) / (n * n)) for s in shares]
    m = [(2 * s + n) // (2 * n) for s in sums]
    centre = np.array(m, np.int64)
    rest = np.array([(s - n * c) / n for s, c in zip(sums, m, strict=True)])
    turn = (vectors / np.sqrt(np.array(variance))[:, None]).T
    return lambda z: ((z - centre) - rest) @ turn


OUT = ("vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), "
       "whitened double, explained double, identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           count: int = 8) -> DataFrame:
    """One row per usable vector and component (see module text)."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    n, sums = moments(rows)
    if not n:
        return spark.createDataFrame([], OUT)
    a = scatter(rows, n, sums)
    shares, vectors = components(spark, a, count)
    if not shares:
        return spark.createDataFrame([], OUT)
    dims, k = len(sums), len(shares)
    project = _projector(n, sums, a, shares, vectors)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Count, mean and centred products of the task's rows.
        held, mean, prod = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = project(_matrix(b.column(0), dims))
            if not len(w):
                continue
            own = w.mean(axis=0)
            c = w - own
            step = own - mean
            total = held + len(w)
            prod += c.T @ c + np.outer(step, step) * (held * len(w) / total)
            mean, held = mean + step * (len(w) / total), total
        if held:
            yield pa.RecordBatch.from_pydict({"n": pa.array([held], pa.int64()),
                                              "mean": pa.array([mean.tolist()]),
                                              "prod": pa.array([prod.ravel().tolist()])})

    parts = rows.select("v").mapInArrow(spread, "n long, mean array<double>, prod array<double>")
    # The tasks' parts are added by Spark; centred on the grand mean.
    flat = parts.select("n", "mean", F.posexplode("prod").alias("e", "p")).select(
        "e", "p", "n", F.col("mean")[(F.col("e") / k).cast("int")].alias("a"),
        F.col("mean")[F.col("e") % k].alias("b"))
    got = flat.groupBy("e").agg(F.sum("p").alias("p"), F.sum(F.col("n") * F.col("a") * F.col("b")).alias("ab"),
                                F.sum(F.col("n") * F.col("a")).alias("a"),
                                F.sum(F.col("n") * F.col("b")).alias("b"),
                                F.sum("n").alias("n")).collect()
    error = max(abs((r["p"] + r["ab"] - r["a"] * r["b"] / r["n"]) / r["n"] - (r["e"] // k == r["e"] % k))
                for r in got)
    m = [(2 * s + n) // (2 * n) for s in sums]
    centre = np.array(m, np.int64)
    rest = [s - n * c for s, c in zip(sums, m, strict=True)]
    rest_sq = sum(t * t for t in rest)

    def deviations(z: np.ndarray) -> list[int]:
        """n * n * |z|^2 - 2 n z.T + |T|^2, exactly."""
        most = max(int(np.abs(z).max(initial=0)), 1)
        if most * most * dims < 1 << 62 and most * n * dims < 1 << 62:
            sq, dot = (z * z).sum(axis=1).tolist(), (z @ np.array(rest, np.int64)).tolist()
        else:
            wide = z.astype(object)
            sq, dot = (wide * wide).sum(axis=1), wide @ np.array(rest, object)
        return [n * n * int(s) - 2 * n * int(d) + rest_sq for s, d in zip(sq, dot, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = _matrix(b.column(1), dims)
            w, dev, size = project(z), deviations(z - centre), b.num_rows
            twice = np.repeat(np.arange(size), k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(twice)),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                 pa.array(np.full(size * k, n)),
                 pa.array([x if x < 1 << 63 else None for x in dev], pa.int64()).take(pa.array(twice)),
                 pa.array([Decimal(x) if x < 10 ** 38 else None for x in dev],
                          pa.decimal128(38, 0)).take(pa.array(twice)),
                 pa.array(w.ravel()), pa.array(np.tile(shares, size)),
                 pa.array(np.full(size * k, error))],
                names=[c.split(" ")[0] for c in OUT.split(", ")])

    return rows.mapInArrow(run, OUT)
