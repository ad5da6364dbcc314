"""Every query on its registered table; those with SQL against DuckDB."""

import re

import duckdb
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from logsift.llm import queries as Q
from tests.llm.helpers import words

SF = "/root/testdata/sf0.01"
# Columns of the contracts.
COLUMNS = {
    "op1_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op4_embedding_dedup": "vec_id n_links component_id kept",
    "op5_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op6_token_files": "doc_id start n_tokens ids_crc32",
    "op7_quality": "doc_id held_out score predicted",
    "op8_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op10_suffix_tree_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_substring_dedup": "doc_id n_words n_removed kept_sha256",
}


def test_registered():
    names = set(entry.queries())
    for n in range(1, 14):
        assert len([x for x in names if re.match(rf"op{n}_", x)]) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "encoding"]


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_full_result(spark, name):
    got = Q.QUERIES[name](spark, SF)
    assert set(COLUMNS.get(name, "doc_id").split()) <= set(got.columns)
    table = "embeddings" if name.startswith("op4_") else "documents"
    rows = got.toPandas()
    if name == "op11_hard_negatives":  # rows are anchors with a positive and a negative
        assert len(rows) > 0 and (rows.anchor_id % 50 == 0).all() and rows["rank"].between(1, 3).all()
    else:
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    sql = Q.ORACLE_SQL.get(name)
    if sql:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark", "labels"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = con.sql(sql).df()
        columns = sorted(rows.columns)
        assert columns == sorted(want.columns)
        mine, theirs = (x[columns].sort_values(columns).reset_index(drop=True).astype(str) for x in (rows, want))
        assert mine.equals(theirs)


def test_pipeline_against_single_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in Q.op7_quality(spark, SF).filter("predicted = 1").collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    text = dict(con.sql("SELECT doc_id, text FROM documents").fetchall())
    sets = {}
    for i in sorted(good):
        w = words(text[i])
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for n, a in enumerate(order):
        for b in order[n + 1:]:
            if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    unique = {i for i in sets if find(i) == i}
    clean = {r.doc_id for r in Q.op1_decontaminate(spark, SF).filter("NOT contaminated").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(unique & clean)
    sp = sentencepiece.SentencePieceProcessor(model_file=Q.PIECES)
    assert all(list(r.ids) == sp.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) for r in got)
    assert docs.count() > len(got) > 500
