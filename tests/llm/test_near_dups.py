import random

from fareflow.llm import near_dups as N
from fareflow.llm.components import connected_components


def grams(t):
    w = (t or "").encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    s = [grams(t) for _, t in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and s[i] and s[j]
             and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j])] for i in range(n)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in link[i]:
            root[max(find(i), find(j), key=lambda x: (rows[x][0], x))] = \
                min(find(i), find(j), key=lambda x: (rows[x][0], x))
    return sorted((rows[i][0], min(rows[j][0] for j in range(n) if find(j) == find(i)), len(link[i]))
                  for i in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "b", 2) for d, t in rows],
                                 "doc_id long, text string, node int, bands string, n_chars int")


def make(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    base = [[rng.choice(vocab) for _ in range(rng.randrange(30, 300))] for _ in range(n)]
    rows = []
    for b in base:
        rows.append(" ".join(b))
        for _ in range(rng.randrange(4)):
            c = list(b)
            for _ in range(rng.randrange(4)):
                c[rng.randrange(len(c))] = rng.choice(vocab)
            rows.append(" ".join(c))
    big = [rng.choice(vocab) for _ in range(200)]
    for _ in range(60):
        c = list(big)
        c[rng.randrange(200)] = rng.choice(vocab)
        rows.append(" ".join(c))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark):
    rows = make(1, 60)
    rows += [(10_000, None), (10_001, ""), (10_002, "  \n"), (10_003, "a b"), (10_004, "a  b"),
             (10_005, "a b c d e"), (3, rows[3][1]), (10_006, "x " * 9000)]
    got = sorted((r.doc_id, r.class_id, r.n_links)
                 for r in N.near_duplicates(frame(spark, rows), block=16).collect())
    assert got == brute(rows)


def test_keep_one(spark):
    rows = make(2, 20) + [(5000, None), (5001, None), (None, "a b c"), (None, "a b c")]
    d = frame(spark, rows)
    out = N.keep_one(d)
    assert out.columns == d.columns
    want = {c for _, c, _ in brute([r for r in rows if r[0] is not None])}
    got = [r.doc_id for r in out.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 1
    assert N.keep_one(d.limit(0)).count() == 0


def test_bands_reach_the_recall():
    b, r = N.bands_for()
    assert 1 - (1 - 0.8 ** r) ** b >= N.RECALL and b * r <= N.MAX_HASHES


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}
