"""The pipeline's stages and the registered corpus queries on the smallest tables."""

import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skewkit.llm import queries

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries().keys()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "language id", "n-gram jaccard join", "benchmark decontamination", "packing"]


def test_jaccard_join_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    wanted = sorted(con.sql(queries.JACCARD_SQL).fetchall())
    assert sorted(tuple(r) for r in queries.op2_ngram_jaccard_join(spark, SF).collect()) == wanted


def test_leaks_equal_their_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    wanted = sorted(con.sql(queries.LEAKS_SQL).fetchall())
    found = queries.op3_benchmark_decontamination(spark, SF)
    assert found.columns == con.sql(queries.LEAKS_SQL).columns
    assert sorted(tuple(r) for r in found.collect()) == wanted and wanted


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    current, left = docs, ids
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(spark, stage(spark, current, SF), "test-stage")
        assert after.columns == docs.columns, name
        kept = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept < left or name == "language id" and kept <= left, name
        assert len(kept) > 0.7 * len(left), name
        current, left = after, kept
    # the classifier has learned from the rows of label 0 that are not held out, and keeps none of them
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert not [i for i in left if labels.get(i) == 0 and zlib.crc32(str(i).encode()) % 5]
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == left


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_have_contract_columns(spark, name):
    wanted = {
        "op1": "page_id url text n_chars", "op2": "doc_id class_id n_links", "op3": "doc_id item_id similarity",
        "op4": "doc_id held_out lang_pred score", "op5": "conv_id turn text position", "op6": "doc_id license coverage",
        "op7": "doc_id held_out score predicted", "op8": "doc_id start n_tokens ids_crc32",
        "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op10": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op12": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
        "op13": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"}[name.split("_")[0]].split()
    out = queries.QUERIES[name](spark, SF)
    assert set(wanted) <= set(out.columns)
    if name.split("_")[0] in ("op2", "op4", "op7", "op8", "op9", "op11", "op13"):
        assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
