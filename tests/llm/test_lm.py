import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from fareflow.llm import lm


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                                 "doc_id long, text string, n int, score int")


def texts(n, seed=1):
    rng = random.Random(seed)
    langs = [[f"{x}{i}{e}" for i in range(60)] for x, e in (("a", "ung"), ("b", "tion"))]
    out = []
    for i in range(n):
        words = langs[rng.randrange(2)]
        out.append((i, " ".join(rng.choice(words) if rng.random() < 0.9 else f"r{rng.randrange(900)}ung"
                                for _ in range(rng.randrange(5, 120)))))
    return out


def test_base_equals_brute_force_and_model_beats_it(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN_WORDS", 40)
    monkeypatch.setattr(lm, "WORD_CLASSES", 30)
    rows = texts(900) + [(1000, None), (1001, ""), (1002, "A B\x0bC\x1fÄ"), (None, "a b"), (5, "x y"),
                         (7, "x y"), (7, "x y")]
    got = lm.score(frame(spark, rows).coalesce(1)).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update(lm.tokens(t))
    total, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(lm.tokens(t)), sum(c[w] > 0 for w in lm.tokens(t)),
                   round(sum(math.log10((c[w] + 1) / (total + v + 1)) for w in lm.tokens(t)), 6))
                  for i, t in rows)
    assert want == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6))
                          for r in got)
    assert {r.train_tokens for r in got} == {total}
    test = [r for r in got if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
    assert all(r.score < 0 for r in got)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    k = 12
    m = lm.Model(*(rng.normal(size=s).astype(np.float32)
                   for s in ((k + 1, 16), (k + 1, 16), (k, 16), (k,))))
    z = lm.log_normalisers(m)
    for a, b in ((0, 3), (k, k), (5, k)):
        s = (m.before1[a] + m.before2[b]) @ m.target.T + m.bias
        assert np.exp(s - z[a, b]).sum() == pytest.approx(1, abs=1e-4)
    back = lm.Model.unpack(m.pack())
    assert all((x == y).all() for x, y in zip((m.before1, m.before2, m.target, m.bias),
                                              (back.before1, back.before2, back.target, back.bias)))


def test_training_approaches_the_true_distribution():
    rng = np.random.default_rng(1)
    k, n = 8, 60_000
    table = rng.dirichlet(np.full(k, 0.4), k)
    seq = [0]
    for _ in range(n):
        seq.append(int(rng.choice(k, p=table[seq[-1]])))
    cls = np.array(seq)
    vocab = lm.Vocabulary({}, {}, np.bincount(cls, minlength=k), np.zeros(k, int), n, k, 0.5)
    m = lm.new_model(vocab)
    opt = lm._Adagrad([m.before1, m.before2, m.target, m.bias], 0.3)
    one, two = lm.contexts(cls, np.array([0]), k)
    p = np.bincount(cls, minlength=k) / len(cls)
    for _ in range(10):
        lm.train_steps(m, opt, p, cls, one, two, rng, lm.Training())
    z = lm.log_normalisers(m)
    s = np.einsum("ij,ij->i", m.before1[one] + m.before2[two], m.target[cls]) + m.bias[cls] - z[one, two]
    entropy = -np.mean(np.log(table[cls[:-1], cls[1:]]))
    unigram = -np.mean(np.log(p[cls]))
    assert -s.mean() < entropy + 0.25 * (unigram - entropy)


def test_no_training_rows_and_empty_table(spark):
    i = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.score(frame(spark, [(i, "a b")])).collect()
    assert len(r) == 1 and r[0].train_tokens == 0 and r[0].base_score == 0 and r[0].n_known == 0
    assert lm.score(frame(spark, [])).collect() == []
