import random
import zlib

import numpy as np
import pytest

from fareflow.llm import toxicity as T
from fareflow.llm.queries import op13_toxicity, read_table


def plain_buckets(text, bits):
    """The same hash, one n-gram at a time."""
    s = " " + " ".join((text or "").lower().split()) + " " if (text or "").split() else \
        " " + (" " if text else "") + " "
    m, out = 1 << 32, set()
    for n in T.SIZES:
        for i in range(len(s) - n + 1):
            h = ord(s[i]) * int(T._B) % m
            for c in s[i + 1:i + n]:
                h = (h * int(T._A) % m) ^ (ord(c) * int(T._B) % m)
            out.add((h * int(T._C) % m) >> (32 - bits))
    return out


@pytest.mark.parametrize("text", ["", None, "a", "Ab  cd\n\nab CD ab", "straße 🙂 x" * 5])
def test_buckets_are_the_distinct_ngrams(text):
    got = T.Buckets(16)(text)
    assert len(set(got.tolist())) == len(got)
    if text and text.strip() == text:
        assert set(got.tolist()) == plain_buckets(text, 16)


def test_long_texts_are_hashed_whole(monkeypatch):
    text = " ".join(f"w{i * 7919 % 997}" for i in range(3000))
    want = set(T.Buckets(16)(text).tolist())
    monkeypatch.setattr(T, "WINDOW", 100)
    assert set(T.Buckets(16)(text).tolist()) == want


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        ws = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(2):
                ws.insert(rng.randrange(len(ws)), "zork" + rng.choice(words))
        rows.append((i, " ".join(ws), toxic))
    return rows


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "xx", 5) for i, t in rows],
                                 "doc_id long, text string, toxic string, shard int")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, text int")


def test_learns_and_holds_out(spark):
    rows = corpus(900)
    docs, labels = frames(spark, [(i, t) for i, t, _ in rows], [(i, y, 0) for i, _, y in rows])
    got = {r.doc_id: r for r in T.score(docs, labels, bits=16).collect()}
    assert len(got) == 900
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i], y) for i, _, y in rows if got[i].held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    # Labels of held-out rows do not matter.
    swapped = [(i, 1 - y if got[i].held_out else y, 0) for i, _, y in rows]
    again = {r.doc_id: r.score for r in T.score(docs, frames(spark, [], swapped)[1], bits=16).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_shards_and_bound(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_FEATURES", 3000)
    rows = corpus(900, seed=1)
    docs, labels = frames(spark, [(i, t) for i, t, _ in rows], [(i, y, 0) for i, _, y in rows])
    train = T.training_rows(docs, labels, shard_rows=100)
    inside = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(900))
    assert train.count() == inside
    few = T.training_rows(docs, labels, train_rows=200).count()
    assert 120 < few < 280
    w, b = T.fit(train, bits=16)
    buckets = T.Buckets(16)
    z = [float(w[f].sum() / np.sqrt(max(len(f), 1)) + b) for f in (buckets(t) for _, t, _ in rows)]
    assert np.mean([(x >= 0) == bool(y) for x, (_, _, y) in zip(z, rows)]) > 0.9


def test_odd_rows(spark):
    docs, labels = frames(
        spark, [(None, "a text"), (1, None), (2, ""), (2, "twice"), (2, "twice"), (3, "zork")],
        [(None, 1, 0), (2, None, 0), (2, 0, 0), (3, 1, 0), (3, 0, 0), (3, 1, 0)])
    rows = T.score(docs, labels, bits=12).collect()
    assert len(rows) == 6
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    assert len({r.score for r in rows if r.doc_id == 2}) <= 2


def test_without_labels(spark):
    docs, labels = frames(spark, [(1, "x"), (2, None)], [])
    assert [(round(r.score, 6), r.predicted) for r in T.score(docs, labels, bits=12).collect()] == [(0.25, 0)] * 2
    one_kind = frames(spark, [], [(i, 0, 0) for i in range(1, 3)])[1]
    assert all(r.predicted == 0 for r in T.score(docs, one_kind, bits=12).collect())
    empty, labels = frames(spark, [], [(1, 1, 0)])
    assert T.score(empty, labels, bits=12).collect() == []


def test_held_out_accuracy_on_a_given_table(spark, sf_mid):
    """Ranking of held-out labelled rows (area under the curve)."""
    scored = op13_toxicity(spark, sf_mid).filter("held_out")
    rows = scored.join(read_table(spark, sf_mid, "labels").select("doc_id", "toxic"), "doc_id").collect()
    pos, neg = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert auc > 0.8, auc
