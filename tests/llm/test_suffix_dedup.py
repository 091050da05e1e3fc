import hashlib
import random
import tracemalloc

import numpy as np

from fareflow.llm import suffix_dedup as S


def brute(rows, length):
    first = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, r in raws:
        if i is not None:
            for p in range(len(r) - length + 1):
                w = r[p:p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, r in raws:
        gone = bytearray(len(r))
        if i is not None:
            for p in range(len(r) - length + 1):
                if first[r[p:p + length]] < i:
                    gone[p:p + length] = b"\1" * length
        left = bytes(c for c, g in zip(r, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(r), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows],
                               "doc_id long, text string, chunk int, row string")
    out = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in S.dedup(df, **kw).collect()]
    return sorted(out, key=str)


def words(rng, n, k=5):
    return " ".join("".join(rng.choice("abcé"[:k]) for _ in range(rng.randrange(1, 6))) for _ in range(n))


def sample():
    rng = random.Random(1)
    shared = [words(rng, 60) for _ in range(4)]
    line = "Licensed under the Apache License, Version 2.0."
    rows = []
    for i in range(70):
        t = words(rng, rng.randrange(0, 90))
        if i % 3 == 0:
            t += shared[i % 4] + words(rng, 9)
        if i % 5 == 0:
            t = line + "\n" + t
        rows.append((i * 7 % 71, t))
    base = words(rng, 200)
    for i in range(30):
        w = base.split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(200)] = "changed" + str(rng.randrange(5))
        rows.append((300 + i, " ".join(w)))
    rows += [(400 + i, "An " * 150) for i in range(4)] + [(500, "x" * 49), (501, "x" * 50), (502, "x" * 51)]
    rows += [(600, None), (601, ""), (None, base), (602, base), (602, base), (603, rows[3][1])]
    rows += [(rows[5][0], base[:120]), (700, "é" * 40 + "ü" * 30), (699, "é" * 40 + "ö" * 30)]
    return rows


def test_equals_brute_force(spark):
    rows = sample()
    assert run(spark, rows, chunk_bytes=4000) == brute(rows, S.LENGTH)


def test_one_chunk_and_other_lengths(spark):
    rows = sample()[:60]
    assert run(spark, rows) == brute(rows, S.LENGTH)
    assert run(spark, rows, length=30, chunk_bytes=3000) == brute(rows, 30)


def test_empty_table_and_kept_text(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d " * 20, "x"), (2, "q " + "a b c d " * 20, "y")],
                               "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept_text, r["row"]["lang"]) for r in S.dedup(df, with_text=True).collect()}
    assert got == {1: ("a b c d " * 20, "x"), 2: ("q", "y")}


def test_deep_shallow_sorts():
    rng = np.random.default_rng(0)
    for shallow in (1, 2, 3, 9):
        chars = rng.integers(0, 2, (500, 6)).astype(np.uint64)
        group = rng.integers(0, 4, 500)
        order, new = S.deep_shallow(chars, group, shallow)
        rows = [(int(g), tuple(c)) for g, c in zip(group[order], chars[order].tolist())]
        assert rows == sorted(rows)
        assert new.tolist() == [k == 0 or rows[k] != rows[k - 1] for k in range(500)]


def test_blind_trie():
    rng = random.Random(5)
    for _ in range(50):
        s = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randrange(1, 60))]
        got = S.blind_trie_order(s)
        assert [s[c[0]] for c in got] == sorted(set(s))
        assert all(len({s[i] for i in c}) == 1 for c in got) and sum(map(len, got)) == len(s)


def test_characters_need_little_room():
    rng = np.random.default_rng(3)
    buf = rng.integers(97, 99, 300_000, dtype=np.uint8)
    starts, sizes = np.arange(0, 200_000, 2), rng.integers(1, 81, 100_000)
    tracemalloc.start()
    got = S._chars(buf, starts, sizes, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * got.nbytes
    for i in (0, 4_999, 5_000, 99_999):
        text = buf[starts[i]:starts[i] + sizes[i]].tobytes().ljust(80, b"\0")
        assert got[i].astype(">u8").tobytes() == text
