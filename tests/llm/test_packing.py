import numpy as np
import pytest
from tokenizers import Tokenizer

from fareflow.llm import packing
from fareflow.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def brute_ids(text):
    t = Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def check_layout(rows, docs, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_seq.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= capacity
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for d, text in docs:
        want = len(brute_ids(text))
        got = sorted(by_doc[d])
        assert [p for p, _, _ in got] == list(range(len(got)))
        assert sum(n for _, _, n in got) == want
        assert all(n == capacity for _, _, n in got[:-1])
    return len(by_seq)


@pytest.mark.parametrize("text", [
    "", " ", "Hello,  World's\n\tend", "é é ß İ Σας ΟΔΟΣ", "a b c\x1cd", "123 4.5!!",
    "<|endoftext|> x", "a<|startoftext|>b <|END <|endoftext|><|x|>", "x" * 5000, "́ a ̈"])
def test_word_cache_gives_the_tokenizers_ids(text):
    raw = packing.encode_ids(PATH, [text, None, text])
    got = np.frombuffer(raw[0], "<u4").tolist()
    assert got == brute_ids(text)[:-1]
    assert raw[1] == b"" and raw[0] == raw[2]


def test_pieces_and_layout(spark, monkeypatch):
    docs = [(1, "one two three " * 40), (2, None), (3, ""), (4, "a b c"), (4 + 1, "word " * 100),
            (6, "a b c"), (7, "x y " * 9)]
    df = spark.createDataFrame([(d, t, "z", "q") for d, t in docs],
                               "doc_id long, text string, part string, bin string")
    rows = packing.pack_documents(df, PATH, capacity=64).collect()
    n = check_layout(rows, docs, 64)
    total = sum(len(brute_ids(t)) for _, t in docs)
    assert n >= -(-total // 64)


def test_exchange_rounds_close_gaps(spark):
    rng = np.random.default_rng(3)
    lens = rng.integers(1, 40, 3000)
    df = spark.createDataFrame([(int(i), 0, 0, int(x), 0) for i, x in enumerate(lens)], packing.PIECES)
    rows = packing.pack(df, capacity=64, rows_per_partition=1000).collect()
    assert len(rows) == 3000 and len({r.doc_id for r in rows}) == 3000
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        assert sum(n for _, n in spans) <= 64
        ends = [o + n for o, n in sorted(spans)]
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]]
    low = packing.bound(packing.dual_sums(lens, 64), 64)
    assert low <= len(by) <= low + 2


def test_bins_beyond_the_pool_stay_loose(spark):
    # Half-full bins far beyond a pool of 50 rows: each level pairs some of them.
    df = spark.createDataFrame([(i, 0, 0, 33 if i < 300 else 31, 0) for i in range(600)], packing.PIECES)
    rows = packing.pack(df, capacity=64, rows_per_partition=100).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600))
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 64 and 300 <= len(fill) <= 310


def test_bounds_never_exceed_best_fit():
    rng = np.random.default_rng(0)
    for _ in range(200):
        cap = int(rng.integers(10, 200))
        x = np.sort(rng.integers(1, cap + 1, rng.integers(1, 60)))[::-1]
        bins, offs = packing.best_fit_decreasing(x, cap)
        fill = np.bincount(bins, weights=x)
        assert fill.max() <= cap
        assert packing.bound(packing.dual_sums(x, cap), cap) <= len(fill)


def test_bound_certifies_halves():
    x = np.full(7, 33)
    assert packing.bound(packing.dual_sums(x, 64), 64) == 7


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, PATH).collect() == []


def test_words_of_latin_letters_take_the_model_alone(monkeypatch):
    tok, _ = packing._tokenizer(PATH)
    letters = [chr(c) for c in range(0xC0, 0x180) if c not in (0xD7, 0xF7, 0x130)]
    words = [w for c in letters for w in (c, f"X{c}y's", f"{c}{c}9'{c},", f"'s{c}#")] + ["Großé", "plain", "'ll--é"]

    class ModelAlone:
        model = tok.model

    def ids(raw):
        return np.frombuffer(raw, "<u4").tolist()

    def whole(w):
        return tok.encode(w, add_special_tokens=False).ids

    for room in (800_000, 0):
        monkeypatch.setattr(packing, "CACHE_WORDS", room)
        out = packing._encode_words(ModelAlone(), [w.encode() for w in words], {})
        assert all(ids(out[w.encode()]) == whole(w) for w in words)
    others = ["a×b", "÷", "İx", "漢字", "é<|endoftext|>", "é"]
    out = packing._encode_words(tok, [w.encode() for w in others], {})
    assert all(ids(out[w.encode()]) == whole(w) for w in others)


def test_a_full_word_cache_changes_no_ids(monkeypatch):
    texts = ["first words here", "other words, née 12", "first words here"]
    want = [brute_ids(t)[:-1] for t in texts]
    monkeypatch.setattr(packing, "CACHE_WORDS", 2)
    monkeypatch.setitem(packing._words, PATH, {})
    packing._tokenizer(PATH)
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for t in texts for x in packing.encode_ids(PATH, [t])]
        assert got == want
    assert len(packing._words[PATH]) <= 3
