import itertools
import math
from collections import Counter

import numpy as np
import pytest

from fareflow.llm import segmentation as S
from fareflow.llm.queries import op4_segmentation, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lat():
    return S.lattice(PATH)


TEXTS = ["hello world", "a  b \nc ", " ", "  ", "x", "über 3.5% 漢字 \U0001f600\x01", "tab\tend\n\n",
         "An An An " * 50, "ends with space ", " starts", "the▁mark"]


def test_cells_equal_the_models_own_segmentation(lat):
    for t in TEXTS:
        assert lat.cells([t])[0].tolist() == lat.sp.encode(t), t
    assert lat.cells([None])[0].tolist() == []


def test_every_arc_spells_its_cell(lat):
    for cell in lat.sp.encode("international understanding tokens are here"):
        arcs = lat.arcs_of(cell)
        assert all("".join(lat.pieces[i] for i in p) == lat.pieces[cell] for p, _ in arcs)
        assert len({tuple(p) for p, _ in arcs}) == len(arcs)
        assert sum(math.exp(x) for _, x in arcs) == pytest.approx(1)


def test_samples_are_distinct_round_trip_and_repeatable(spark):
    rows = [(i, t, 9, "z") for i, t in enumerate(TEXTS)] + [(100, None, 1, ""), (101, "", 1, ""),
                                                           (0, TEXTS[0], 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank int, ids string")
    out = S.decode(S.sample(df, PATH, k=4), PATH).collect()
    again = S.sample(df.repartition(5), PATH, k=4).collect()
    assert sorted((r.doc_id, r["rank"], r.ids_crc32) for r in out) == \
        sorted((r.doc_id, r["rank"], r.ids_crc32) for r in again)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in rows:
        got = sorted(by[i], key=lambda r: r["rank"])
        assert all(r.decoded == (t or "").replace("▁", " ") for r in got)
        if i:
            assert len({tuple(r.ids) for r in got}) == len(got)
            g = [r.perturbed for r in got]
            assert g == sorted(g, reverse=True)
    assert len(by[101]) == 1 and by[101][0].n_pieces == 0 and by[101][0].inclusion == 1
    assert S.sample(df.limit(0), PATH).collect() == []


def brute_paths(lat, text):
    cells = [lat.arcs_of(c) for c in lat.sp.encode(text)]
    out = {}
    for combo in itertools.product(*cells):
        out[tuple(i for p, _ in combo for i in p)] = sum(x for _, x in combo)
    return out


def test_all_segmentations_when_k_is_large(lat):
    text = "her on"
    want = brute_paths(lat, text)
    search = S._Search(lat, lat.cells([text]), np.array([7], np.uint64), len(want) + 5)
    got = search.run()[0]
    ids = [tuple(np.frombuffer(b"".join(lat._arcs[i] for i in p.tolist()), "<u4").tolist()) for p, *_ in got]
    assert sorted(ids) == sorted(want) and np.isneginf(search.bound[0])
    assert all(lp == pytest.approx(want[i]) for i, (_, lp, _) in zip(ids, got))


def test_frequencies_match_sampling_without_replacement(lat):
    text = "tion"
    want = brute_paths(lat, text)
    names = list(want)
    p = np.exp([want[n] for n in names])
    n = 6000
    cells = lat.cells([text]) * n
    keys = np.random.default_rng(3).integers(0, 2**63, n).astype(np.uint64)
    search = S._Search(lat, cells, keys, 2)
    pairs = Counter()
    for paths in search.run():
        pairs[tuple(tuple(np.frombuffer(b"".join(lat._arcs[i] for i in x.tolist()), "<u4").tolist())
                    for x, *_ in paths)] += 1
    for i, j in itertools.permutations(range(len(names)), 2):
        q = p[i] * p[j] / (1 - p[i])
        seen = pairs[names[i], names[j]] / n
        assert abs(seen - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3


def test_query_returns_the_ids_and_decodes_them(spark, sf_small):
    out = op4_segmentation(spark, sf_small)
    assert dict(out.dtypes)["ids"] == "array<int>"
    rows = out.collect()
    assert rows and all(r.round_trip and len(r.ids) == r.n_pieces for r in rows)


def test_round_trip_compares_with_the_text(lat):
    texts = ["hello world", "hello there"]
    keys = np.array([1, 2], np.uint64)
    rows = S._rows(lat, lat.cells([texts[0]] * 2), [0, 1], texts, keys, 1, True).to_pylist()
    assert [r["round_trip"] for r in rows] == [True, False]


def whole_lattice(lat, text):
    """Every spelling of a text with pieces, and its probability."""
    text = "▁" + text.replace(" ", "▁")
    found = [[] for _ in text] + [[]]
    found[0] = [((), 0.0)]
    for at in range(len(text)):
        for end in range(at + 1, len(text) + 1):
            i = lat.ids.get(text[at:end])
            if i is not None:
                found[end] += [((*p, i), s + lat.sharpness * lat.weight[i]) for p, s in found[at]]
    total = np.logaddexp.reduce([s for _, s in found[-1]])
    return {p: s - total for p, s in found[-1]}


def test_spellings_across_the_models_own_cut_are_there(lat):
    """All segmentations of the text, not only those inside the model's own pieces."""
    text = "tion o"
    assert len(lat.sp.encode(text)) > 2
    want = whole_lattice(lat, text)
    assert len(want) > len(brute_paths(lat, text))
    rows = S._rows(lat, [lat.words(text)], [1], [text], np.array([7], np.uint64), len(want) + 5, True).to_pylist()
    assert sorted(tuple(r["ids"]) for r in rows) == sorted(want) and all(r["round_trip"] for r in rows)
    assert all(r["log_prob"] == pytest.approx(want[tuple(r["ids"])]) and r["inclusion"] == 1 for r in rows)
    assert {tuple(lat.sp.encode(text))} <= set(want)


def test_frequencies_over_the_whole_lattice(lat):
    text = "tion"
    want = whole_lattice(lat, text)
    p, n = {k: math.exp(v) for k, v in want.items()}, 6000
    keys = np.random.default_rng(5).integers(0, 2**63, n).astype(np.uint64)
    rows = S._rows(lat, [lat.words(text)] * n, [*range(n)], [text] * n, keys, 2, True).to_pylist()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(tuple(r["ids"]))
    pairs = Counter(tuple(v) for v in by.values())
    for i, j in itertools.permutations(p, 2):
        q = p[i] * p[j] / (1 - p[i])
        assert abs(pairs[i, j] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3


def test_words_are_forgotten_and_built_again(lat, monkeypatch):
    texts = ["漢字 \U0001f600\x01 tab", "long" * 3000, "  two  marks "]
    keys = np.arange(3).astype(np.uint64)
    first = S._rows(lat, [lat.words(t) for t in texts], [0, 1, 2], texts, keys, 3, True).to_pylist()
    assert len(first) == 9 and all(r["round_trip"] for r in first)
    monkeypatch.setattr(S, "CACHE_PLACES", 10)
    lat.trim()
    assert not lat.words_
    assert S._rows(lat, [lat.words(t) for t in texts], [0, 1, 2], texts, keys, 3, True).to_pylist() == first


def arcs_from(lat, root, places):
    """Per place of a word: its arcs as (piece, place they lead to, log-probability)."""
    out = []
    for place in range(root, root + places):
        b = int(lat.begin[place])
        out.append([(int(lat.piece[a]), int(lat.next[a]) - root, float(lat.logp[a]))
                    for a in range(b, b + int(lat.n_arcs[place]))])
    return out


def test_plain_words_get_the_arcs_of_the_general_way():
    """Slices by distance from the end, a hash table and plain weights give the same lattice."""
    lat = S.Lattice(PATH, S.SHARPNESS)
    texts = ["▁internationalization", "▁▁", "▁a", "▁über", "▁▁▁x3.5%", "▁" + "tion" * 20]
    units = [lat.words(t[1:].replace("▁", " ")) for t in texts]
    lat.need(np.concatenate(units))
    fast = [arcs_from(lat, int(lat.root[u[0]]), int(lat.places[u[0]])) for u in units]
    roots, places = lat._build(texts)
    lat.need(np.zeros(0, np.int64))
    for got, root, n in zip(fast, roots.tolist(), places.tolist(), strict=True):
        want = arcs_from(lat, root, n)
        assert [[a[:2] for a in x] for x in got] == [[a[:2] for a in x] for x in want]
        assert [a[2] for x in got for a in x] == pytest.approx([a[2] for x in want for a in x], abs=1e-12)


def test_trimming_keeps_frequent_words_and_changes_no_sample(monkeypatch):
    texts = [f"the same few words and w{i * 7919} once\nthen é漢{i} more " for i in range(40)]
    keys = np.arange(40).astype(np.uint64)
    whole = S.Lattice(PATH, S.SHARPNESS)
    want = S._rows(whole, [whole.words(t) for t in texts], list(range(40)), texts, keys, 3, True).to_pylist()
    monkeypatch.setattr(S, "CACHE_PLACES", 300)
    lat, got, kept = S.Lattice(PATH, S.SHARPNESS), [], 0
    for i in range(0, 40, 4):
        lat.trim()
        kept = max(kept, "the" in lat.words_)
        assert len(lat._begin.all) <= 300
        got += S._rows(lat, [lat.words(t) for t in texts[i:i + 4]], list(range(i, i + 4)), texts[i:i + 4],
                       keys[i:i + 4], 3, True).to_pylist()
    assert kept and "w0" not in lat.words_
    by = {(r["doc_id"], r["rank"]): r for r in want}
    assert len(got) == len(want)
    for r in got:
        assert r["ids"] == by[r["doc_id"], r["rank"]]["ids"] and r["round_trip"]
        assert r["perturbed"] == pytest.approx(by[r["doc_id"], r["rank"]]["perturbed"], abs=1e-9)


def test_branches_read_no_more_of_a_long_text_than_can_win(lat):
    text = "many different words follow each other here " * 200
    search = S._Search(lat, [lat.words(text)], np.array([5], np.uint64), 3)
    path = S._Path(search, *search.fresh(np.arange(len(search.root)), search.root, 0))
    some = search.branches(path, np.array([0.5]), np.array([-1]), np.zeros(1), 0)
    assert 3 <= len(some.doc) < path.size[0] // 4


def test_spelling_is_compared_whole(lat):
    """Eight bytes at once find any piece that differs, and bytes that are missing or too many."""
    texts = ["international understanding", "", "a", "ünïcödé characteristically", "x" * 40]
    whole = [("▁" + t.replace(" ", "▁")).encode() if t else b"" for t in texts]
    ids = [lat.sp.encode(t) for t in texts]
    cases = [ids[0], ids[1], ids[2], ids[3], ids[4]], [ids[0][:-1], [], ids[2] * 2, ids[3][::-1], ids[4]], \
        [[*ids[0][:-1], ids[2][0]], ids[2], [], ids[3] + ids[4], ids[0]]
    longest = int(np.argmax(lat.n_bytes))  # differs past its first eight bytes
    assert lat.n_bytes[longest] > 8
    for rows in cases:
        pieces = np.array([i for r in rows for i in r], np.int64)
        got = S._Spelled(lat, whole).by(np.arange(5), pieces, np.array([len(r) for r in rows]))
        assert got.tolist() == [b"".join(lat.surface[i] for i in r) == w for r, w in zip(rows, whole, strict=True)]
    for cut in range(len(lat.surface[longest])):
        text = lat.surface[longest]
        text = text[:cut] + bytes([text[cut] ^ 1]) + text[cut + 1:]
        assert S._Spelled(lat, [text]).by(np.array([0]), np.array([longest]), np.array([1])).tolist() == [False]


def test_rooms_are_used_again_after_trimming(monkeypatch):
    lat = S.Lattice(PATH, S.SHARPNESS)
    texts = [" ".join(f"w{i * 7919 + j}" for j in range(900)) for i in range(6)]
    lat.need(np.concatenate([lat.words(t) for t in texts]))
    rooms = [lat._logp.room, lat._piece.room]
    assert all(len(x) < 1.5 * len(lat._logp.all) for x in rooms)
    monkeypatch.setattr(S, "CACHE_PLACES", 100)
    lat.trim()
    lat.need(np.concatenate([lat.words(t) for t in texts]))
    assert lat._logp.room is rooms[0] and lat._piece.room is rooms[1]
