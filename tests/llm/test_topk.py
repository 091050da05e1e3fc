import math

import numpy as np

from fareflow.llm import topk


def brute(rows, k=5):
    q = {}
    vs = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, a in vs:
        if i % 50 == 0:
            s = sorted(((-sum(x * y for x, y in zip(a, b)), j) for j, b in vs if j != i))[:k]
            q[i] = [(r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return q


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows],
                               "vec_id long, embedding array<float>, query_id string, score int")
    v = topk.quantize(df, "vec_id", "embedding")
    got = {}
    for r in topk.top_k(v.filter("vec_id % 50 = 0"), v, **kw).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {k: sorted(x) for k, x in got.items()}


def test_equals_brute_force_on_a_grid(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).astype("float32").tolist()) for i in range(260)]
    rows += [(300 + i, rows[7][1]) for i in range(8)]  # ties
    assert run(spark, rows, queries_per_cell=2, vectors_per_cell=60) == brute(rows)
    assert run(spark, rows) == brute(rows)


def test_unusable_vectors_and_small_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
            (50, [0.5, -1.0]), (None, [1.0, 1.0]), (4, [float("inf"), 0.0]), (5, [0.25, 0.25])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0])]) == {}


def test_pruning_is_exact_with_ties():
    rng = np.random.default_rng(2)
    for _ in range(30):
        v = rng.integers(-3, 4, (64, 300))
        q = rng.integers(-3, 4, 64)
        ids = np.arange(300)
        at, s = topk.branch_and_bound(q, 5, v, ids, 5, block=8)
        want = sorted((-int(q @ v[:, j]), j) for j in range(300) if j != 5)[:5]
        assert [(-int(x), int(ids[a])) for a, x in zip(at, s)] == want
