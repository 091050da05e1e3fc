"""Every operator is registered and returns the agreed columns over a whole table."""

import pytest

import __spark_entry__ as E
from fareflow.llm import queries as Q
from fareflow.plans.verify import compare, duckdb_connection

COLUMNS = {
    "op1_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
                         "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op5_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                      "train_tokens bigint, base_score double, score double",
    "op6_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op7_ngram_join": "doc_id bigint, class_id bigint, n_links bigint",
    "op8_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                        "kept_sha256 string",
    "op9_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
               "base_sha256 string, spans string",
    "op10_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                    "sequence_id bigint, offset bigint",
    "op11_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                      "n_best bigint, count_sum bigint, groups_sha256 string",
    "op12_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                      "explained double, identity_error double",
    "op13_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
}
PER_ROW = {"op1_quality_rules": "documents", "op2_chunk_dedup": "documents", "op3_main_text": "pages",
           "op5_lm_scoring": "documents", "op7_ngram_join": "documents",
           "op8_suffix_dedup": "documents", "op9_pii": "documents",
           "op11_alignment": "documents", "op13_toxicity": "documents"}


def test_names():
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_runs_over_the_whole_table(spark, sf_small, name):
    df = Q.QUERIES[name](spark, sf_small)
    have = dict(df.dtypes)
    for col in COLUMNS.get(name, "").split(", "):
        if col:
            c, kind = col.split(" ")
            assert have[c] == kind, (c, have[c])
    n = df.count()
    if name in PER_ROW:
        assert n == Q.read_table(spark, sf_small, PER_ROW[name]).count()
    assert n > 0


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_oracle(spark, sf_small, name):
    r = compare(spark, name, Q.QUERIES[name], Q.ORACLES[name], sf_small, duckdb_connection(sf_small))
    assert r["ok"], r
