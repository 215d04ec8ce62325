"""What the plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from moodmart import schemas as S
from moodmart.operators import joins, merge, scoring
from moodmart.plans import gold, silver
from moodmart.workloads import inputs
from moodmart.workloads.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(query(spark, FOLDER)) for name, query in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_joins(plans, name):
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin", plans[name])


@pytest.mark.parametrize("name", ["article", "dim_article", "pro_reactions", "fan_reactions", "reaction", "fact_title"])
def test_dimension_joins_do_not_move_facts(plans, name):
    assert "BroadcastHashJoin" in plans[name]
    assert "SortMergeJoin" not in plans[name] and "ShuffledHashJoin" not in plans[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_single_partition_only_for_small_things(plans, name):
    """A window or shuffle to one partition may only stand above the stored distinct names, a global count or a sum."""
    for found in re.finditer(r"Exchange SinglePartition.*\n(.*)", plans[name]):
        assert re.search(r"HashAggregate|Scan ExistingRDD\[team_name", found.group(1)), found.group(0)


def test_latest_row_is_chosen_before_the_shuffle(plans):
    for name in ("dedup_latest", "article", "build_articles"):
        partial = plans[name].index("Partial")
        assert plans[name].index("WindowGroupLimit") < plans[name].index("Exchange hashpartitioning") < partial


def test_scoring_shuffles_nothing(plans):
    assert "Exchange" not in plans["lexicon_sentiment"]
    assert "Exchange" in plans["lexicon_sentiment_joined"]


def test_extraction_is_one_narrow_pass(plans):
    for name in ("html_fields", "extracted_articles"):
        assert "Exchange" not in plans[name]
        assert plans[name].count("script|style") == 1, "the page is cleaned once"


def test_trend_shuffles_counts_only(spark, tmp_path):
    """From stored tables: the scans read four narrow columns each, and only counted cells are shuffled."""
    facts = {}
    for name, schema in (("reaction", S.FACT_REACTION), ("title", S.FACT_TITLE)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        facts[name] = spark.read.schema(schema).parquet(str(tmp_path / name))
    articles = spark.createDataFrame([], S.ARTICLES)
    trend = gold.sentiment_trend(facts["reaction"], facts["title"], gold.dim_sentiment(spark), gold.dim_date(articles))
    plan = plan_of(trend)
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert len(schemas) == 2
    for read in schemas:
        assert {column.split(":")[0] for column in read.split(",")} == {
            "fk_sentiment_id", "fk_team_id", "fk_date_id", "is_subjective",
        }
    counted = plan.index("partial_count(1)")
    assert plan.rindex("Exchange hashpartitioning(fk_sentiment_id") < counted


def test_columns_are_pruned(plans):
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plans["html_fields"]
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plans["lexicon_sentiment"]
    assert "ReadSchema: struct<o_orderdate:timestamp>" in plans["dim_date"].replace("timestamp_ntz", "timestamp")


def test_small_batches_do_not_shuffle_history(plans):
    for name in ("upsert", "bronze_merge"):
        assert "BroadcastHashJoin" in plans[name] and "LeftAnti" in plans[name]
        assert "Exchange hashpartitioning" not in plans[name]


def test_large_sides_are_salted_and_not_broadcast(spark):
    documents = inputs.table(spark, FOLDER, "documents").select(F.col("source").alias("key"), "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = plan_of(joins.dimension_join(documents, documents.select("key").distinct(), "key", max_rows=1))
        merged = plan_of(merge.upsert(documents, documents, "key", max_rows=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in (joined, merged):
        assert re.search(r"SortMergeJoin \[key#\d+, _salt#\d+\]", plan)
        # all that is broadcast are the hot keys
        for found in re.finditer(r"BroadcastExchange .*\n(.*)\n(.*)\n(.*)", plan):
            assert "_rows" in found.group(0)


def test_only_touched_months_are_scanned(spark, tmp_path):
    from moodmart.plans import refresh as R

    warehouse = R.Warehouse(str(tmp_path))
    articles = inputs.articles(spark, FOLDER).withColumn("published_month", F.date_format("publishedDate", "yyyy-MM"))
    articles.write.partitionBy("published_month").parquet(warehouse.articles)
    stored = R.read_table(spark, warehouse.articles, R._STORED_ARTICLES)
    keys = stored.where("publishedDate >= '2025-01-01'").select("id", "publishedDate")
    touched = R.in_months_of(keys, stored)
    assert touched.count() == articles.where("published_month = '2025-01'").count() > 0
    assert re.search(r"PartitionFilters: \[.*published_month#\d+ = 2025-01", plan_of(touched))


def test_filters_stay_above_the_extraction(spark):
    pages = inputs.dated_pages(spark, FOLDER)
    plan = plan_of(silver.extract_articles(pages, inputs.DATED_PAGE).where("id is not null and title like 'A%'"))
    assert plan.count("script|style") == 1


def test_lexicon_is_read_once_per_scoring(spark):
    documents = inputs.table(spark, FOLDER, "documents").select("doc_id", "text")
    plan = plan_of(scoring.label_scores(scoring.score_texts(documents, "text", inputs.lexicon(spark))))
    assert plan.count("split(lower(") == 1
