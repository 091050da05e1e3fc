"""The pipeline against a sequential version of its stages, and its contract."""

import random

import numpy as np
import pytest
import test_near_dups
import test_packing
import test_quality
import test_suffix_dedup

import corpus_pipeline as CP


def corpus():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 8))) for _ in range(900)]
    rows = []
    for i in range(40):
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(20, 60)))
                 for _ in range(rng.randrange(2, 5))]
        rows.append("\n".join(lines))
    for i in range(8):
        w = rows[i].split(" ")
        w[len(w) // 2] = "edited"
        rows.append(" ".join(w))
    shared = " ".join(rng.choice(vocab) for _ in range(60))
    rows += [" ".join(rng.choice(vocab) for _ in range(80)) + " " + shared for _ in range(5)]
    rows += [rows[3], rows[3], "too short", "spam " * 200, None, "", "é" * 3000]
    rows[5] += " mail x.y@mail.example.com now"
    rows[6] += "\ncall +1 (988) 555-2485 or 4111 1111 1111 1111"
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.fixture()
def sf(spark, tmp):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or "")) for i, t in corpus()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp}/documents.parquet")
    return tmp


def redacted(text):
    for found, kind in (("x.y@mail.example.com", "[EMAIL]"), ("+1 (988) 555-2485", "[PHONE]"),
                        ("4111 1111 1111 1111", "[CARD]")):
        text = text.replace(found, kind)
    return text


def test_equals_a_sequential_version(spark, sf):
    rows = corpus()
    kept = [(i, t) for i, t in rows
            if (b := test_quality.brute_base(t))[0] >= 50 and 100 * b[4] <= 50 * b[0]]
    first = {c for _, c, _ in test_near_dups.brute(kept)}
    unique = [(i, t) for i, t in kept if i in first]
    cut = dict(removed(unique))
    want = {i: redacted(cut[i]) for i, _ in unique}
    docs = CP.read_table(spark, sf, "documents")
    columns = docs.columns
    for name, stage in CP.STAGES[:-1]:
        docs = CP.keep_table(stage(spark, docs, sf), f"t-{name}")
        assert docs.columns == columns, name
    got = {r.doc_id: r.text for r in docs.collect()}
    assert got == want
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = CP.run(spark, sf).collect()
    assert test_packing.check_layout(packed, list(want.items()), 4096) >= 1


def removed(rows, length=50):
    first = {}
    for i, t in rows:
        r = t.encode()
        for p in range(len(r) - length + 1):
            w = r[p:p + length]
            first[w] = min(first.get(w, i), i)
    for i, t in rows:
        r = t.encode()
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - length + 1):
            if first[r[p:p + length]] < i:
                gone[p:p + length] = True
        yield i, bytes(c for c, g in zip(r, gone) if not g).decode("utf-8", "ignore")


def test_empty_table(spark, tmp):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp}/documents.parquet")
    assert CP.run(spark, tmp).collect() == []


def test_stage_list():
    assert [n for n, _ in CP.STAGES] == ["quality_rules", "ngram_join", "suffix_array_dedup",
                                         "redact_pii", "best_fit_packing"]
    assert test_suffix_dedup.S.LENGTH == 50


def test_stages_keep_columns_with_any_name(spark):
    from fareflow.llm import near_dups, pii, quality
    text = " ".join(f"word{i}" for i in range(60)) + " mail a.b@c.org"
    names = ["__key", "__id", "__cuts", "__new", "row", "row_key", "id", "key", "cuts", "new",
             "removed", "kept", "a.b"]
    df = spark.createDataFrame([(1, text, "s", len(text), *names), (2, None, None, 0, *names)],
                               "doc_id long, text string, source string, n_chars long, "
                               + ", ".join(f"`{n}` string" for n in names))
    for out in (quality.apply_rules(df), near_dups.keep_one(df), pii.redact(df)):
        assert out.columns == df.columns
        got = {r["doc_id"]: r for r in out.collect()}
        assert 1 in got
        for r in got.values():
            assert [r[n] for n in names] == names
        assert got[1]["n_chars"] == len(got[1]["text"])


def test_few_rows_cuts_batches_in_order():
    import pyarrow as pa
    from fareflow.llm.common import few_rows
    b = pa.RecordBatch.from_arrays([pa.array(range(11))], names=["x"])
    got = [x.column(0).to_pylist() for x in few_rows(iter([b, b.slice(0, 0), b.slice(9)]), 4)]
    assert got == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10], [9, 10]]
