import hashlib
import random

from fareflow.llm import chunk_dedup as C


def brute(rows):
    """Sequential version: chunks of equal bytes belong to the smallest id."""
    owner = {}
    cut = {}
    for i, t in rows:
        raw, at = (t or "").encode(), 0
        cut[i, t] = []
        for e in C.chunk_ends(raw):
            cut[i, t].append(raw[at:e])
            at = e
        if i is not None:
            for p in cut.get((i, t), []):
                owner[p] = min(owner.get(p, i), i)
    out = []
    for i, t in rows:
        kept, seen = [], set()
        for p in cut.get((i, t), []):
            if i is None or (owner[p] == i and p not in seen):
                kept.append(p)
            seen.add(p)
        raw = (t or "").encode()
        left = b"".join(kept)
        out.append((i, len(cut.get((i, t), [])), len(raw), len(raw) - len(left),
                    hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows],
                               "doc_id long, text string, start int, lost string")
    return sorted(((r.doc_id, r.n_chunks, r.n_bytes, r.n_removed, r.kept_sha256, r.text)
                   for r in C.dedup(df).collect()), key=str)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(n))


def test_equals_sequential_version(spark):
    rng = random.Random(1)
    shared = words(rng, 120)
    rows = [(i, words(rng, rng.randrange(0, 200))
             + (shared if i % 3 == 0 else "") + words(rng, 20)) for i in range(60)]
    rows += [(100, rows[5][1]), (101, rows[5][1]), (5, rows[5][1]), (200, None), (201, ""),
             (None, rows[5][1]), (202, "z" * 30_000), (203, "ab " * 4000)]
    got = run(spark, rows)
    assert got == brute(rows)
    full = {r[0]: r for r in got}
    assert full[100][3] == full[100][2] and full[5][3] < full[5][2]
    # The shared passage goes from all but the first document, up to its edge chunks.
    assert all(full[i][3] > len(shared.encode()) - 2 * C.MAX_BYTES for i in range(3, 60, 3))


def test_insertions_shift_only_nearby_chunks():
    rng = random.Random(2)
    raw = words(rng, 3000).encode()
    other = raw[:500] + b"INSERTED" + raw[500:]
    cut = lambda r: {r[a:b] for a, b in zip([0, *C.chunk_ends(r)], C.chunk_ends(r))}
    assert len(cut(raw) - cut(other)) <= 3


def test_gear_hash_equals_rolling_form():
    rng = random.Random(3)
    raw = bytes(rng.randrange(256) for _ in range(300))
    import numpy as np
    h, out = 0, []
    for b in raw:
        h = ((h << 1) + int(C._GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    assert C.gear_hashes(np.frombuffer(raw, np.uint8)).tolist() == out


def test_chunk_sizes():
    rng = random.Random(4)
    raw = bytes(rng.randrange(256) for _ in range(50_000)) + b"a" * 5000
    e = C.chunk_ends(raw)
    sizes = [b - a for a, b in zip([0, *e], e)]
    assert e[-1] == len(raw) and max(sizes) <= C.MAX_BYTES and min(sizes[:-1]) >= C.MIN_BYTES


def test_empty_table(spark):
    assert run(spark, []) == []
