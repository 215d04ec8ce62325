"""The registered queries against SQL over whole tables, and the pipeline against its operators in plain Python."""

import plain
import pytest
from compare import connect, duckdb_rows, spark_rows
from conftest import DATA
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from moodmart.llm.oracle import ORACLE
from moodmart.llm.queries import QUERIES

FOLDER = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_all_are_registered():
    names = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected = duckdb_rows(database, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected and rows


def test_native_operators_run_no_python(spark):
    for name in ("op4_secrets", "op10_fingerprints"):
        plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_pipeline_stages(spark, tmp_path):
    """Each stage's result on what the one before has kept."""
    folder = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        out = f"{tmp_path}/{name}"
        step(spark, docs, folder).write.parquet(out)
        before = [(row["doc_id"], row["text"]) for row in docs.collect()]
        docs = spark.read.parquet(out)
        after = {row["doc_id"]: row["text"] for row in docs.collect()}
        if name == "language":
            assert len(after) >= 0.97 * len(before)
        elif name == "lines":
            wanted = {doc_id: kept for doc_id, _, _, kept in plain.line_dedup(before)}
            assert {doc_id: plain.sha(text) for doc_id, text in after.items()} == wanted
            assert docs.where(F.col("n_chars") != F.char_length("text")).isEmpty()
        elif name == "near_duplicates":
            assert set(after) == {class_id for _, class_id, _ in plain.classes(before)}
        elif name == "decontaminate":
            items = [(row["item_id"], row["text"]) for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert set(after) == {row[0] for row in plain.contamination(before, items) if not row[-1]}
        if name == "mixing":
            assert docs.columns == [*columns, "copies"]
            assert 0 < len(after) <= len(before)
        else:
            assert docs.columns == columns


def test_pipeline_run(spark):
    found = corpus_pipeline.run(spark, f"{DATA}/sf0.001")
    assert found.count() > 0 and "copies" in found.columns
