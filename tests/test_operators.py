"""Joins, merges, numbering, scoring and the trend, on small tables and against plain Python."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from moodmart.operators import joins, merge, scoring
from moodmart.operators.numbering import number_sorted
from moodmart.plans import bronze, gold
from moodmart.session import stage
from moodmart.workloads import inputs

DAY = dt.date


def values(frame):
    return [tuple(row) for row in frame.collect()]


def ordered(frame):
    return sorted(values(frame), key=repr)


# --- joins ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has one key, another third has none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(3000).select(key.alias("key"), F.col("id").alias("value"))


SMALL = [("hot", 1), ("k1", 2), ("k1", 3), (None, 4), ("unused", 5)]


@pytest.mark.parametrize("rows_per_task", [1, 7, 100, 10_000])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_equals_join(spark, skewed, how, rows_per_task):
    small = spark.createDataFrame(SMALL, "key string, x int")
    assert ordered(joins.salted_join(skewed, small, "key", how, rows_per_task)) == ordered(
        skewed.join(small, "key", how)
    )


def partition_sizes(spark, frame):
    """Rows per shuffle partition of the join, without broadcasts and without help from adaptive execution."""
    return [row["count"] for row in frame.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_salted_join_spreads_a_hot_key_and_null_keys(spark, skewed):
    small = spark.createDataFrame([("hot", 1)], "key string, x int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        plain = partition_sizes(spark, skewed.join(small, "key", "left"))
        salted = partition_sizes(spark, joins.salted_join(skewed, small, "key", "left", rows_per_task=20))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(plain) == sum(salted) == 3000
    assert max(plain) >= 1000 and max(salted) < 600


def test_only_hot_keys_are_copied(spark, skewed):
    hot = {row["key"]: row["_tasks"] for row in joins._hot_keys(skewed, "key", 100)[0].collect()}
    assert hot == {"hot": 10}


def test_salted_join_refuses_other_joins(spark, skewed):
    with pytest.raises(ValueError):
        joins.salted_join(skewed, skewed, "key", "outer")


def test_dimension_join_measures(spark, skewed):
    small = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, x int")
    expected = ordered(skewed.join(small, "key", "left"))
    assert ordered(joins.dimension_join(skewed, small, "key", "left")) == expected
    assert ordered(joins.dimension_join(skewed, small, "key", "left", max_rows=1)) == expected
    assert ordered(joins.dimension_join(skewed, small, "key", "left", max_bytes=10)) == expected
    assert joins.measure(small) == joins.Size(2, 2 * (8 + 16 + 16) + 5)


# --- merges -----------------------------------------------------------------------------------------------------------


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, value string")


LIMITS = [{}, {"max_rows": 0}]


@pytest.mark.parametrize("limits", LIMITS)
def test_upsert(spark, limits):
    merged = merge.upsert(keyed(spark, ("1", "a"), ("2", "b")), keyed(spark, ("2", "B"), ("3", "c")), "id", **limits)
    assert ordered(merged) == [("1", "a"), ("2", "B"), ("3", "c")]


@pytest.mark.parametrize("limits", LIMITS)
def test_upsert_keeps_duplicates_and_null_keys(spark, limits):
    history = keyed(spark, ("1", "a"), ("1", "a"), (None, "n"), ("2", "b"))
    batch = keyed(spark, ("2", "B"), ("2", "BB"), (None, "N"))
    expected = [("1", "a"), ("1", "a"), ("2", "B"), ("2", "BB"), (None, "N"), (None, "n")]
    assert ordered(merge.upsert(history, batch, "id", **limits)) == sorted(expected, key=repr)


@pytest.mark.parametrize("limits", LIMITS)
def test_upsert_twice_is_upsert_once(spark, limits):
    history, batch = keyed(spark, ("1", "a"), ("2", "b")), keyed(spark, ("2", "B"), ("3", "c"))
    once = merge.upsert(history, batch, "id", **limits)
    assert ordered(merge.upsert(once, batch, "id", **limits)) == ordered(once)


def test_union_matches_columns_by_name(spark):
    swapped = keyed(spark, ("1", "a")).select("value", "id")
    assert ordered(merge.union_all(keyed(spark, ("2", "b")), swapped)) == [("1", "a"), ("2", "b")]
    with pytest.raises(ValueError):
        merge.union_all(keyed(spark, ("1", "a")), keyed(spark, ("1", "a")).withColumnRenamed("id", "key"))
    with pytest.raises(ValueError):
        merge.union_all(keyed(spark, ("1", "a")), keyed(spark, ("1", "a")).withColumn("id", F.lit(1)))


def test_dedup_latest(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), (None, 1, "n"), (None, 2, "m"), ("b", 1, "w")],
        "id string, at int, value string",
    )
    kept = merge.dedup_latest(rows, "id", [F.col("at").desc(), F.col("value")])
    assert ordered(kept) == [("a", 3, "y"), ("b", 1, "w"), (None, 2, "m")]


def test_landing_keys_tell_teams_apart(spark):
    raw = spark.createDataFrame([("t1", 1, "HTTP error 500"), ("t2", 1, "HTTP error 500")], "teamName string, page int, html string")
    moment = F.lit("2024-10-03 10:46:15")
    landed = bronze.land_pages(raw.limit(1), bronze.stamp_pages(raw, moment), F.lit("2024-10-03 11:00:00"))
    assert landed.count() == 2
    old = bronze.stamp_pages(raw, moment, key_on_html_only=True)
    landed = bronze.land_pages(raw.limit(1), old, F.lit("2024-10-03 11:00:00"), key_on_html_only=True)
    assert landed.count() == 1
    assert landed.columns == ["_hashedId", "_extractedDate", "teamName", "page", "html"]


# --- numbering --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limits", LIMITS)
def test_number_sorted(spark, limits):
    names = [f"team {number}" for number in random.Random(1).sample(range(10_000), 500)]
    rows = spark.createDataFrame([(name,) for name in names * 3], "name string")
    expected = [(place, name) for place, name in enumerate(sorted(names), start=1)]
    assert sorted(values(number_sorted(rows, "name", "team_id", **limits))) == expected


# --- scoring ----------------------------------------------------------------------------------------------------------


def plain_score(content, lexicon):
    hits = [lexicon[word] for word in re.findall(r"[^\W\d_]+", (content or "").lower()) if word in lexicon]
    if not hits:
        return 0.0, 0.0
    return tuple(sum(weight[place] for weight in hits) / len(hits) / 100 for place in (0, 1))


TEXTS = ["Good good BAD", "nothing here", "", None, "éclair, good! 3bad_good", "bad" * 3, "Bad.\nGood-bad"]
WEIGHTS = {"good": (70, 60), "bad": (-65, 90), "éclair": (33, 10)}


@pytest.mark.parametrize("limits", LIMITS)
def test_scores(spark, limits):
    lexicon = spark.createDataFrame([(w, p, s) for w, (p, s) in WEIGHTS.items()], scoring_schema())
    texts = spark.createDataFrame([(place, text) for place, text in enumerate(TEXTS * 2)], "id int, text string")
    found = {row["id"]: (row["sentiment_score"], row["subjectivity_score"]) for row in
             scoring.score_texts(texts, "text", lexicon, **limits).collect()}
    assert found == {place: plain_score(text, WEIGHTS) for place, text in enumerate(TEXTS * 2)}


def scoring_schema():
    return "word string, polarity_h int, subjectivity_h int"


@pytest.mark.parametrize("limits", LIMITS)
def test_scores_with_a_long_lexicon(spark, limits):
    """Far more words than buckets, so that words share them."""
    source = random.Random(2)
    letters = "abcdefghij"
    weights = {"".join(source.choices(letters, k=5)): (source.randint(-100, 100), source.randint(0, 100)) for _ in range(20_000)}
    lexicon = spark.createDataFrame([(w, p, s) for w, (p, s) in weights.items()], scoring_schema())
    texts = [" ".join("".join(source.choices(letters, k=5)) for _ in range(40)) for _ in range(50)]
    rows = spark.createDataFrame([(place, text) for place, text in enumerate(texts)], "id int, text string")
    found = {row["id"]: (row["sentiment_score"], row["subjectivity_score"]) for row in
             scoring.score_texts(rows, "text", lexicon, **limits).collect()}
    assert found == {place: plain_score(text, weights) for place, text in enumerate(texts)}


@pytest.mark.parametrize("weights", [(None, 1), (1, None), (101, 1), (1, -1)])
@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_a_word_without_weights_in_range_is_an_error(spark, weights, limits):
    lexicon = spark.createDataFrame([("good", 70, 60), ("odd", *weights)], scoring_schema())
    texts = spark.createDataFrame([("good odd",)], "text string")
    with pytest.raises(Exception, match="no weight in range in the lexicon: odd"):
        scoring.score_texts(texts, "text", lexicon, **limits).collect()


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_upper_case_and_empty_words_of_a_lexicon(spark, limits):
    """Texts are lower-cased and words are not, so a word in capitals is never met; an empty one is left out."""
    lexicon = spark.createDataFrame([("good", 70, 60), ("BAD", -65, 40), ("", None, None)], scoring_schema())
    texts = spark.createDataFrame([("Good BAD bad  ",), ("",), (None,)], "text string")
    found = scoring.score_texts(texts, "text", lexicon, **limits)
    assert ordered(found) == [("", 0.0, 0.0), ("Good BAD bad  ", 0.7, 0.6), (None, 0.0, 0.0)]


def test_the_texts_stay_where_they_are_under_a_large_lexicon(spark):
    lexicon = spark.createDataFrame([("good", 70, 60)], scoring_schema())
    texts = spark.createDataFrame([(n, f"good {n}") for n in range(50)], "n long, text string")
    plan = scoring.score_texts(texts, "text", lexicon, max_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_lexicon_that_fits_moves_sums_and_no_words(spark, monkeypatch):
    lexicon = spark.createDataFrame([("good", 70, 60), ("bad", -65, 40)], scoring_schema())
    texts = spark.createDataFrame([(n, f"good {n} " + " ".join(f"w{k}" for k in "abcdefghij")) for n in range(20)], "n long, text string")
    stored = []
    monkeypatch.setattr(scoring, "stage", lambda frame: stored.append(stage(frame)) or stored[-1])
    assert {row["sentiment_score"] for row in scoring.score_texts(texts, "text", lexicon, max_rows=0).collect()} == {0.7}
    assert sorted(frame.count() for frame in stored) == [2, 20]


@pytest.mark.parametrize("rows_per_task", [1, 5, 1000])
def test_scores_when_the_lexicon_is_shuffled(spark, monkeypatch, rows_per_task):
    lexicon = spark.createDataFrame([(w, p, s) for w, (p, s) in WEIGHTS.items()], scoring_schema())
    texts = spark.createDataFrame([(place, text) for place, text in enumerate(TEXTS * 2)], "id int, text string")
    monkeypatch.setattr(scoring, "fits_broadcast", lambda frame: False)
    scored = scoring.score_texts(texts, "text", lexicon, max_rows=0, rows_per_task=rows_per_task)
    found = {row["id"]: (row["sentiment_score"], row["subjectivity_score"]) for row in scored.collect()}
    assert found == {place: plain_score(text, WEIGHTS) for place, text in enumerate(TEXTS * 2)}


def test_measured_bytes_include_binary_values(spark):
    frame = spark.createDataFrame([(bytearray(1000), "x")], "b binary, t string")
    assert joins.measure(frame) == joins.Size(1, 1000 + 1 + 3 * 16)


def test_a_word_listed_twice_is_an_error(spark):
    lexicon = spark.createDataFrame([("good", 1, 1), ("good", 2, 2)], scoring_schema())
    texts = spark.createDataFrame([("good",)], "text string")
    for limits in LIMITS:
        with pytest.raises(Exception):
            scoring.score_texts(texts, "text", lexicon, **limits).collect()


# --- facts and trend --------------------------------------------------------------------------------------------------


def test_facts(spark):
    lexicon = spark.createDataFrame([("good", 70, 60), ("bad", -65, 40)], scoring_schema())
    sentiments = gold.dim_sentiment(spark)
    reactions = spark.createDataFrame(
        [("a_pro", "a", 1, "good day", DAY(2024, 1, 2), False), ("b_fan_1", "b", 2, "bad", DAY(2024, 1, 3), True)],
        "reaction_id string, fk_article_id string, fk_team_id long, content string, published_at date, is_fan boolean",
    )
    assert ordered(gold.fact_reaction(reactions, sentiments, lexicon)) == [
        ("a_pro", "a", 3, 1, DAY(2024, 1, 2), "good day", 0.7, 0.6, "subjective", False),
        ("b_fan_1", "b", 0, 2, DAY(2024, 1, 3), "bad", -0.65, 0.4, "objective", True),
    ]
    headers = spark.createDataFrame(
        [("a", 1, "plain title", DAY(2024, 1, 2))],
        "article_id string, fk_team_id long, article_title string, published_at date",
    )
    assert values(gold.fact_title(headers, sentiments, lexicon)) == [
        ("a_title", 1, 1, DAY(2024, 1, 2), "plain title", 0.0, 0.0, "objective", "title")
    ]
    assert values(gold.dim_article(headers)) == [("a", 1, "plain title", DAY(2024, 1, 2), "a_title")]


def trend_inputs(spark, facts, days):
    rows = spark.createDataFrame(
        facts, "fk_sentiment_id long, fk_team_id long, fk_date_id date, is_subjective string"
    )
    articles = spark.createDataFrame([(day,) for day in days], "publishedDate date")
    return rows, articles


def test_trend(spark):
    day, other = DAY(2024, 12, 30), DAY(2024, 1, 3)
    facts, articles = trend_inputs(
        spark,
        [(3, 4, day, "subjective"), (0, 4, day, "objective"), (3, 4, other, "objective"), (1, 5, day, "subjective"),
         (9, 5, day, None), (3, None, day, "subjective"), (3, 4, DAY(1999, 1, 1), "objective")],
        [day, day, day, other],
    )
    found = {row["trend_id"]: tuple(row)[1:] for row in
             gold.trend_of(facts, gold.dim_sentiment(spark), gold.dim_date(articles)).collect()}
    # calendar year with ISO week: the two ends of 2024 meet in week 1
    assert found == {
        "trend_4_2024_1": (4, other, 3, 1 / 3 * 100, 1 / 3 * 100, 2, 1, 0),
        "trend_5_2024_1": (5, day, 2, 100.0, 0.0, 0, 0, 1),
        None: (4, DAY(1999, 1, 1), 2, 50.0, 100.0, 2, 0, 0),
    }
    iso = gold.trend_of(facts, gold.dim_sentiment(spark), gold.dim_date(articles, iso_year=True))
    assert {row["trend_id"] for row in iso.collect()} == {"trend_4_2025_1", "trend_4_2024_1", "trend_5_2025_1", None}


def test_legacy_trend_counts_once_per_article_of_the_date(spark):
    day = DAY(2024, 1, 3)
    facts, articles = trend_inputs(spark, [(3, 4, day, "subjective")], [day] * 3)
    sentiments = gold.dim_sentiment(spark)
    total = lambda dates, legacy: gold.trend_of(facts, sentiments, dates, legacy).first()["total_articles"]
    assert total(gold.dim_date(articles), False) == 1
    assert total(gold.legacy_dim_date(articles), False) == 1
    assert total(gold.legacy_dim_date(articles), True) == 3


def test_weighted_trend_equals_the_join_it_replaces(spark):
    source = random.Random(3)
    days = [DAY(2024, 1, 1) + dt.timedelta(source.randint(0, 30)) for _ in range(60)]
    facts, articles = trend_inputs(
        spark,
        [(source.choice([0, 1, 3, 7]), source.randint(1, 3), source.choice(days + [DAY(2020, 1, 1)]),
          source.choice(["subjective", "objective", None])) for _ in range(300)],
        days,
    )
    sentiments, dates = gold.dim_sentiment(spark), gold.legacy_dim_date(articles)
    joined = (
        facts.join(dates, F.col("fk_date_id") == F.col("date_id"), "left")
        .join(sentiments, F.col("fk_sentiment_id") == F.col("sentiment_id"), "left")
        .withColumn("trend_id", F.concat(F.lit("trend_"), F.col("fk_team_id"), F.lit("_"), "year", F.lit("_"), "week_of_year"))
        .groupBy("trend_id")
        .agg(
            F.min("fk_team_id"), F.min("fk_date_id"), F.count(F.lit(1)),
            F.avg((F.col("is_subjective") == "subjective").cast("int")) * 100, F.avg("sentiment_value") * 100,
            F.count_if(F.col("sentiment_label") == "positive"), F.count_if(F.col("sentiment_label") == "negative"),
            F.count_if(F.col("sentiment_label") == "neutral"),
        )
    )
    assert ordered(gold.trend_of(facts, sentiments, dates, True)) == ordered(joined)


def test_dim_sentiment(spark):
    assert values(gold.dim_sentiment(spark)) == [("negative", 0, -1), ("neutral", 1, 0), ("positive", 3, 1)]


def test_test_lexicon_gives_every_class(spark):
    """So that no comparison of labels passes for want of cases."""
    documents = inputs.table(spark, "/root/testdata/sf0.01", "documents")
    scored = scoring.label_scores(scoring.score_texts(documents, "text", inputs.lexicon(spark)))
    assert scored.select("sentiment_label", "is_subjective").distinct().count() == 6


def test_equal_rows_of_one_key_are_split_by_adaptive_execution(spark):
    """What the hash of the row cannot spread: many rows that agree in every column."""
    big = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("key"),
        F.when(F.col("id") % 2 == 0, F.lit("x" * 50)).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("value"),
    )
    small = spark.createDataFrame([("k1",), ("k3",)], "key string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = joins.salted_join(big, small, "key", "left_anti", rows_per_task=50_000)
        assert joined.count() == 400_000 - 2 * 400
        counted = joined.groupBy().count()
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
