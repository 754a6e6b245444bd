"""Every query over the smallest tables: SQL where there is some, else held-out accuracy or row counts."""

import duckdb
import pytest

import corpus_pipeline
from episodica.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "conversations"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        expected = db.execute(SQL[name]).to_arrow_table()
    order = expected.column_names
    as_rows = lambda table: sorted(zip(*(table.column(c).to_pylist() for c in order)), key=str)
    got = QUERIES[name](spark, FOLDER).toArrow()
    assert sorted(got.column_names) == sorted(order) and as_rows(got) == as_rows(expected)


@pytest.mark.parametrize("name", ["op2_mix_sources", "op3_quality", "op6_pieces", "op7_jaccard_join", "op8_language", "op10_toxicity"])
def test_one_row_per_document(spark, name):
    assert QUERIES[name](spark, FOLDER).select("doc_id").distinct().count() == 200


def test_language_is_right_on_held_out_rows(spark):
    langs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language"](spark, FOLDER).filter("held_out").join(langs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_pipeline_runs_through(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(rows[0].asDict())
