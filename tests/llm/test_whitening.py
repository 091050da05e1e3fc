import math
from fractions import Fraction

import numpy as np
import pytest

from fareflow.llm import whitening as W


def integers(rows):
    dims = max(len(v) for v in rows)
    return [[math.floor(1024 * float(c)) + 100_000 for c in list(v) + [0.0] * (dims - len(v))] for v in rows]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 1.5) for i, v in enumerate(rows)],
                               "vec_id long, embedding array<float>, component string, n double")
    return W.whiten(df.repartition(3), **kw).toPandas()


def check(got, rows, count=8):
    """Against plain linear algebra and exact rational deviations."""
    x = integers(rows)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    c = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums)] for r in x])
    v = c.T @ c / n
    e = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = got["component"].max()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(wide.T @ wide / n - np.eye(k)).max() < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    share = got.drop_duplicates("component").set_index("component")["explained"].sort_index().to_numpy()
    assert np.allclose(share, e[:k] / np.trace(v), rtol=1e-9)
    # The directions behind the whitened rows are eigenvectors of the covariance.
    back = c.T @ wide / n
    assert np.abs(v @ back - back * e[:k]).max() < 1e-7 * max(e[0], 1)
    dev = got.drop_duplicates("vec_id").sort_values("vec_id")["deviation"].astype("int64").tolist()
    assert dev == [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert (got["n"] == n).all()


def test_equals_plain_linear_algebra(spark):
    rng = np.random.default_rng(0)
    rows = (rng.normal(size=(300, 12)) * np.linspace(0.05, 1, 12)).astype("float32").tolist()
    got = run(spark, rows)
    assert len(got) == 300 * 8
    check(got, rows)


def test_equal_eigenvalues(spark):
    # Points of a cross: all directions have the same variance.
    rows = [[s if i == j else 0.0 for i in range(6)] for j in range(6) for s in (1.0, -1.0)]
    got = run(spark, rows, count=4)
    assert sorted(got["component"].unique()) == [1, 2, 3, 4]
    check(got, rows)


def test_fewer_components_than_dimensions(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-3, 4, (40, 3)) / 8.0
    rows = np.hstack([base, base[:, :2], np.ones((40, 2))]).tolist()  # rank 3 of 7
    got = run(spark, rows)
    assert got["component"].max() == 3
    check(got, rows)


def test_unusable_rows_and_small_tables(spark):
    rows = [[0.5, 1.0], None, [1.0, None], [float("nan"), 0.0], [float("inf"), 1.0], [0.25], [0.0, 0.0],
            [0.25], []]
    df = spark.createDataFrame([(i if i else None, v) for i, v in enumerate(rows)],
                               "vec_id long, embedding array<float>")
    got = W.whiten(df).toPandas()
    assert (got["n"] == 5).all() and len(got) == 5 * 2
    assert got["vec_id"].isna().sum() == 2
    for few in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[], []]):
        df = spark.createDataFrame(list(enumerate(few)), "vec_id long, embedding array<float>")
        assert W.whiten(df).collect() == []
        assert W.whiten(df).columns == [c.split(" ")[0] for c in W.OUT.split(", ")]


def test_wide_values_are_exact(spark):
    rows = [[1e9, 2.0, -3e11], [-1e9, 1.0, 5e10], [4e8, 0.5, 1e3], [2e8, 0.0, 7.0]]
    got = run(spark, rows)
    x = integers([np.float32(r).tolist() for r in rows])
    sums = [sum(c) for c in zip(*x)]
    want = [sum((4 * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert [int(d) for d in got.drop_duplicates("vec_id").sort_values("vec_id")["deviation_exact"]] == want


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for top in (10, 2 ** 20, 2 ** 45, 2 ** 53):
        z = rng.integers(-top, top + 1, (50, 4))
        wide = z.astype(object)
        assert (W._product(z) == wide.T @ wide).all()


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_modulo_a_prime(seed):
    rng = np.random.default_rng(seed)
    p = 10_007
    a = rng.integers(0, p, (5, 5))
    a[rng.integers(0, 5, 4), rng.integers(0, 5, 4)] = 0

    def det(m):
        if not m:
            return 1
        return sum((-1) ** j * m[0][j] * det([r[:j] + r[j + 1:] for r in m[1:]]) for j in range(len(m)))
    c = W.polynomial_mod(a.copy(), p)
    for t in range(8):
        m = [[(t if i == j else 0) - int(a[i][j]) for j in range(5)] for i in range(5)]
        assert det(m) % p == sum(int(x) * t ** i for i, x in enumerate(c)) % p


def test_roots_with_multiplicity():
    c = [1]
    for r in (7, 7, 7, 3, 3, 1, 0, 0):  # product of (t - r)
        c = [(c[i - 1] if i else 0) - r * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    assert W.roots_above(c, 2) == 5 and W.roots_above(c, 7) == 0 and W.roots_above(c, 0) == 6
    got = W.largest_roots(c, 5)
    assert [(round(r / 2 ** s, 12), m) for r, s, m in got] == [(7.0, 3), (3.0, 2)]
    assert len(W.largest_roots(c, 50)) == 3


def test_primes_cover_the_bits():
    ps = W.primes(300)
    assert len(set(ps)) == len(ps) and math.prod(ps) > 2 ** 300
    assert all(all(p % q for q in range(2, 1000)) for p in ps)
