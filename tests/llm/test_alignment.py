import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from fareflow.llm import alignment
from fareflow.llm.queries import read_table, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def gpt_bytes():
    own = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, k = {}, 0
    for b in range(256):
        if b in own:
            table[chr(b)] = b
        else:
            table[chr(256 + k)] = b
            k += 1
    return table


def brute(texts):
    """The contract, token by token and pair by pair."""
    tok, sp, table = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), gpt_bytes()
    tok.encode_special_tokens = True
    docs = []
    for t in texts:
        want, empty = (" " + (t or "")).encode(), ([], [], [], "")
        if not t:
            docs.append(empty)
            continue
        a, b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        ab = [bytes(table[c] for c in tok.id_to_token(i)) for i in a]
        bb = []
        for i in b:
            p = sp.id_to_piece(i)
            bb.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode())
        if b"".join(ab) != want or b"".join(bb) != want:
            docs.append(empty)
            continue
        ends = lambda ps: [sum(map(len, ps[:k + 1])) for k in range(len(ps))]
        ae, be = ends(ab), ends(bb)
        shared = sorted(set(ae) & set(be))
        groups = [",".join(str(i) for i, e in zip(a, ae) if s < e <= f) + "|"
                  + ",".join(str(i) for i, e in zip(b, be) if s < e <= f)
                  for s, f in zip([0, *shared], shared)]
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(ae[i] - len(ab[i]), be[j] - len(bb[j])) < min(ae[i], be[j])]
        docs.append((a, b, links, ";".join(groups)))
    count = Counter(x for d in docs for x in d[2])
    top = Counter()
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return [(len(a), len(b), len(g.split(";")) if g else 0, len(links),
             sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for a, b, links, g in docs]


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, row string, pairs int").repartition(3)
    rows = alignment.align(df, A, B).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return [tuple(r)[1:] for r in rows]


def made_texts():
    rng = random.Random(3)
    parts = ["the", "straße", "naïve", "don't", "1234", "  ", "\n\n", "\t", "日本語", "🙂", "é", "a.b,c",
             "<s>", "<|endoftext|>", "▁", " ", "x" * 40, "'ll", "Ünïcödé", "—", "\r\n", "\x85", "½", "ﬁ"]
    return ["".join(rng.choice(parts) + rng.choice([" ", "", " "]) for _ in range(rng.randint(1, 30)))
            for _ in range(150)]


def test_equals_brute_force(spark):
    texts = made_texts() + [None, "", " ", "word", "word", "a▁b", "long " * 3000]
    got = run(spark, texts)
    assert got == brute(texts)
    assert got[150][:4] == (0, 0, 0, 0) and got[150][6] == ""


def test_small_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS_PER_BLOCK", 50)
    monkeypatch.setattr(alignment, "PAIRS_PER_SHARD", 400)
    texts = made_texts()[:60]
    assert run(spark, texts) == brute(texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, A, B).collect() == []


def test_given_table(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    rows = docs.orderBy("doc_id").collect()
    short = [r.text for r in rows if r.text is None or len(r.text) < 1500][:80]
    assert run(spark, short) == brute(short)


@pytest.mark.parametrize("seed", range(3))
def test_plain_path_gives_the_library_s_ids(seed):
    al = alignment.aligner(A, B)
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzàéîöüßñABCDEZÀÉ    \n\t.,;:!?'-0123456789()…“”"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    assert all(alignment._PLAIN.fullmatch(t) for t in texts)
    want = [e.ids for e in al.a.whole.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in al.a.encode(texts)] == want


def test_windows_beyond_the_memo(monkeypatch):
    al = alignment.Aligner(alignment.ByteLevel(A), alignment.Pieces(B))
    texts = made_texts()[:40]
    want = [(x[:3], x[3].tolist(), x[4]) for x in al.documents(texts)]
    monkeypatch.setattr(alignment, "MEMO_WINDOWS", 3)
    small = alignment.Aligner(al.a, al.b)
    for _ in range(2):
        assert [(x[:3], x[3].tolist(), x[4]) for x in small.documents(texts)] == want
    assert len(small.memo) == 3 and len(al.memo) > 3
