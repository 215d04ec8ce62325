"""Sources, sinks and the daily refresh, on tables in a fresh folder."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodmart import schemas as S
from moodmart.plans import refresh as R
from moodmart.plans import silver
from moodmart.sources import feed, tables
from moodmart.streaming.articles import refresh_new_articles
from moodmart.workloads import inputs

DAY = dt.date
PAIRS = "id string, value string"


def values(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


# --- tables -----------------------------------------------------------------------------------------------------------


def test_missing_table_is_empty(spark, tmp_path):
    frame = tables.read_table(spark, str(tmp_path / "none"), S.DIM_TEAM)
    assert frame.schema == S.DIM_TEAM and frame.count() == 0
    assert tables.read_prefix(spark, str(tmp_path), "none", S.DIM_TEAM).count() == 0


def test_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.read_table(spark, str(tmp_path / "broken"), S.DIM_TEAM).collect()


def test_write_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "table")
    teams = lambda *names: spark.createDataFrame([(n, str(n)) for n in names], S.DIM_TEAM)
    assert tables.write_table(teams(1, 2, 3), path) == 3
    assert tables.write_table(teams(4), path) == 1
    assert values(tables.read_table(spark, path, S.DIM_TEAM)) == [(4, "4")]


def test_a_table_can_be_replaced_by_rows_read_from_it(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.createDataFrame([(1, "a"), (2, "b")], S.DIM_TEAM), path)
    stored = tables.read_table(spark, path, S.DIM_TEAM)
    assert tables.write_table(stored.where("team_id = 2"), path) == 1
    assert values(tables.read_table(spark, path, S.DIM_TEAM)) == [(2, "b")]
    assert [entry.name for entry in tmp_path.iterdir()] == ["table"]


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.createDataFrame([(1, "a")], S.DIM_TEAM), path)
    broken = spark.range(1).select("id", F.raise_error(F.lit("lost")).cast("string").alias("team_name"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(broken.withColumnRenamed("id", "team_id"), path)
    assert values(tables.read_table(spark, path, S.DIM_TEAM)) == [(1, "a")]
    assert [entry.name for entry in tmp_path.iterdir()] == ["table"]


def test_a_broken_replacement_is_no_empty_table(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "empty"), S.DIM_TEAM)
    (tmp_path / "table.old-1").mkdir()
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "table"), S.DIM_TEAM)


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = lambda *rows: spark.createDataFrame(list(rows), PAIRS)
    tables.write_table(frame(("1", "a"), ("2", "b")), path, ["value"])
    stored = spark.read.parquet(path).select("id", "value").where("value = 'a'")
    grown = stored.unionByName(frame(("3", "a")))
    assert tables.write_table(grown, path, ["value"], only_touched_partitions=True) == 2
    assert values(spark.read.parquet(path).select("id", F.col("value").cast("string"))) == [("1", "a"), ("2", "b"), ("3", "a")]
    with pytest.raises(ValueError):
        tables.write_table(frame(("1", "a")), path, only_touched_partitions=True)


def test_prefix_reads_every_file_below_it(spark, tmp_path):
    root = tmp_path / "bronze"
    for folder, number in (("news/a.parquet", 1), ("news/deep/b.parquet", 2), ("news_old/c.parquet", 3), ("other/d.parquet", 4)):
        spark.createDataFrame([(number, folder)], S.DIM_TEAM).coalesce(1).write.parquet(str(root / folder))
    (root / "news" / "note.txt").write_text("not a table")
    found = tables.read_prefix(spark, str(root), "news", S.DIM_TEAM)
    assert [row[0] for row in values(found)] == [1, 2, 3]


def test_prefix_keeps_the_partitions_columns(spark, tmp_path):
    schema = S.with_column(S.DIM_TEAM, "day", T.DateType())
    frame = spark.createDataFrame([(1, "a", DAY(2025, 1, 2)), (2, "b", DAY(2025, 1, 3))], schema)
    frame.write.partitionBy("day").parquet(str(tmp_path / "bronze/news"))
    found = tables.read_prefix(spark, str(tmp_path / "bronze"), "news", schema, ["day"])
    assert values(found) == [(1, "a", DAY(2025, 1, 2)), (2, "b", DAY(2025, 1, 3))]


def test_record_counts(spark):
    assert values(tables.record_counts(spark, {"a": 3, "b": 0})) == [("a", 3), ("b", 0)]


# --- feed -------------------------------------------------------------------------------------------------------------


def test_teams_and_pages(spark, tmp_path):
    settings = tmp_path / "settings.json"
    settings.write_text(
        json.dumps({"base_url": "https://x", "nb_page": 2, "teams": {"A & B": "a-b", "C": "c"}, "other": 1}, indent=2)
    )
    teams = feed.read_teams(spark, str(settings))
    assert values(teams) == [("A & B", "a-b"), ("C", "c")]
    assert values(feed.page_list(teams, 2, "https://x")) == [
        ("A & B", 1, "https://x/a-b/?page=1"),
        ("A & B", 2, "https://x/a-b/?page=2"),
        ("C", 1, "https://x/c/?page=1"),
        ("C", 2, "https://x/c/?page=2"),
    ]
    assert feed.page_list(feed.default_teams(spark)).count() == 200


# --- refresh ----------------------------------------------------------------------------------------------------------

MARKER = "Here are some of your comments:"


def page(title, date, *paragraphs):
    body = "".join(f'<p class="ssrcss-1q0x1qg-Paragraph e1jhz7w10">{text}</p>' for text in paragraphs)
    stamp = (
        f'<span data-testid="timestamp"><span data-testid="accessible-timestamp">published at {date}</span></span>'
        if date
        else ""
    )
    return f'<article><span class="ssrcss-189b1h2-HeadlineWrap"><span>{title}</span>{stamp}</span>{body}</article>'


FIRST_RUN = [
    ("Arsenal", 1, page("Late win", "22:46 30 December", "good day")),
    ("Arsenal", 2, page("Late win", "22:46 30 December", "good day")),
    ("Arsenal", 3, page("Vote: the fans' verdict", "10:00 1 January", f"Well? {MARKER}", "Ann: good", "Bob: bad bad")),
    ("Chelsea", 1, page("Gossip", "10:00 1 January", "good")),
    ("Chelsea", 2, page("Follow A v B", "10:00 1 January", "good")),
    ("Chelsea", 3, page("No date", None, "good")),
    ("Chelsea", 4, "HTTP error 500"),
]
SECOND_RUN = [
    ("Arsenal", 1, page("Late win", "22:46 30 December", "bad day")),
    ("Everton", 1, page("New bad", "09:00 3 January", "nothing")),
]


def frames(spark):
    raw = lambda rows: spark.createDataFrame(rows, S.RAW_PAGES)
    lexicon = spark.createDataFrame([("good", 70, 60), ("bad", -65, 40)], S.LEXICON)
    return raw(FIRST_RUN), raw(SECOND_RUN), lexicon


def test_refresh(spark, tmp_path):
    first, second, lexicon = frames(spark)
    warehouse = R.Warehouse(str(tmp_path))
    counts = R.refresh(spark, warehouse, first, lexicon, F.lit("2025-01-02 06:00:00"))
    assert counts == {
        "pages": 7, "articles": 3, "rejected": 1, "dim_team": 2, "dim_date": 2, "dim_sentiment": 3, "article": 3,
        "dim_article": 3, "reaction": 3, "fact_reaction": 3, "fact_title": 3, "df_fact_sentiment_trend": 3,
    }
    stored = {row["title"]: row for row in R.read_articles(spark, warehouse).collect()}
    assert stored["Late win"]["publishedDate"] == DAY(2024, 12, 30)
    assert stored["Gossip"]["publishedDate"] == DAY(2025, 1, 1)
    trend = {row["trend_id"]: tuple(row)[1:] for row in R.read_gold(spark, warehouse, "df_fact_sentiment_trend").collect()}
    assert trend == {
        "trend_1_2024_1": (1, DAY(2024, 12, 30), 2, 50.0, 50.0, 1, 0, 1),
        "trend_1_2025_1": (1, DAY(2025, 1, 1), 3, 1 / 3 * 100, 0.0, 1, 1, 1),
        "trend_2_2025_1": (2, DAY(2025, 1, 1), 1, 0.0, 0.0, 0, 0, 1),
    }

    again = R.refresh(spark, warehouse, first, lexicon, F.lit("2025-01-02 08:00:00"))
    assert again == counts
    idle = R.refresh(spark, warehouse, first.where("false"), lexicon, F.lit("2025-01-04 08:00:00"))
    assert idle == counts | {"pages": 0, "articles": 0, "rejected": 0}

    january = sorted(path.name for path in (tmp_path / "silver/epl_news/processed_data.parquet/published_month=2025-01").iterdir())
    R.land(spark, warehouse, second, F.lit("2025-01-03 06:00:00"))
    assert R.read_pages(spark, warehouse).groupBy("extracted_date").count().count() == 2
    # only the pages of the second day, of which one replaces a December article and one is new in January
    new = R.read_pages(spark, warehouse).where("extracted_date = '2025-01-03'").where("teamName = 'Arsenal'")
    assert R.refresh_articles(spark, warehouse, new)["articles"] == 1
    untouched = sorted(path.name for path in (tmp_path / "silver/epl_news/processed_data.parquet/published_month=2025-01").iterdir())
    assert untouched == january
    assert R.refresh_articles(spark, warehouse)["articles"] == 4
    stored = {row["title"]: row["content"] for row in R.read_articles(spark, warehouse).collect()}
    assert stored["Late win"] == "bad day" and len(stored) == 4
    counts = R.refresh_gold(spark, warehouse, lexicon)
    assert counts["dim_team"] == 3 and counts["reaction"] == 4
    for table, key in (("article", "article_id"), ("reaction", "reaction_id"), ("fact_reaction", "reaction_id"),
                       ("fact_title", "title_id"), ("df_fact_sentiment_trend", "trend_id")):
        frame = R.read_gold(spark, warehouse, table)
        assert frame.count() == frame.select(key).distinct().count()


def test_stream_gives_the_articles_of_the_batch_refresh(spark, tmp_path):
    first, second, _ = frames(spark)
    streamed, batched = R.Warehouse(str(tmp_path / "s")), R.Warehouse(str(tmp_path / "b"))
    progress = str(tmp_path / "progress")
    for raw, moment in ((first, "2025-01-02 06:00:00"), (second, "2025-01-03 06:00:00")):
        for warehouse in (streamed, batched):
            R.land(spark, warehouse, raw, F.lit(moment))
        query = refresh_new_articles(spark, streamed, progress)
        assert query.awaitTermination(120)
        R.refresh_articles(spark, batched)
        assert values(R.read_articles(spark, streamed)) == values(R.read_articles(spark, batched))
    idle = refresh_new_articles(spark, streamed, progress)
    assert idle.awaitTermination(120) and idle.lastProgress is None or idle.lastProgress["numInputRows"] == 0


def landed_files(spark, warehouse, rows, reverse):
    """One file per page, landed on one day; the order of the files' times is the order a stream takes them in."""
    import os

    raw = spark.createDataFrame(rows, S.RAW_PAGES)
    R.land(spark, warehouse, raw.repartition(len(rows), "page"), F.lit("2025-01-02 06:00:00"))
    day = next(path for path in os.scandir(warehouse.pages) if path.is_dir()).path
    pages = [(row["page"], row["file"]) for row in spark.read.parquet(day).select("page", F.input_file_name().alias("file")).collect()]
    for place, (_, name) in enumerate(sorted(pages, reverse=reverse)):
        os.utime(name.removeprefix("file://"), (1_700_000_000 + 60 * place, 1_700_000_000 + 60 * place))


SPLIT_DAY = [
    ("Arsenal", 1, page("Late win", "22:46 30 December", "from page one")),
    ("Arsenal", 2, page("Late win", "22:46 30 December", "from page two")),
    ("Arsenal", 3, page("No date", None, "x")),
    ("Arsenal", 4, page("No date either", None, "y")),
    ("Arsenal", 5, page("Nor here", None, "z")),
]


@pytest.mark.parametrize("files_per_batch,reverse", [(1, False), (1, True), (2, False), (2, True), (1000, False)])
def test_the_split_of_the_landed_files_does_not_matter(spark, tmp_path, files_per_batch, reverse):
    streamed, batched = R.Warehouse(str(tmp_path / "s")), R.Warehouse(str(tmp_path / "b"))
    for warehouse in (streamed, batched):
        landed_files(spark, warehouse, SPLIT_DAY, reverse)
    query = refresh_new_articles(spark, streamed, str(tmp_path / "progress"), files_per_batch)
    assert query.awaitTermination(300)
    R.refresh_articles(spark, batched)
    read = lambda warehouse: spark.read.parquet(warehouse.rejected).select(*S.REJECTED.fieldNames())
    assert values(read(streamed)) == values(read(batched)) and read(batched).count() == 3
    assert values(R.read_articles(spark, streamed)) == values(R.read_articles(spark, batched))
    assert R.read_articles(spark, streamed).first()["content"] == "from page one"


def test_a_page_that_gets_its_key_later_is_no_longer_rejected(spark, tmp_path):
    from moodmart.functions.html import PageSelectors

    warehouse = R.Warehouse(str(tmp_path))
    raw = spark.createDataFrame([("Arsenal", 1, page("Late win", "22:46 30 December", "x"))], S.RAW_PAGES)
    R.land(spark, warehouse, raw, F.lit("2025-01-02 06:00:00"))
    assert R.refresh_articles(spark, warehouse, selectors=PageSelectors(timestamp_testid="wrong"))["rejected"] == 1
    assert R.refresh_articles(spark, warehouse) == {"articles": 1, "rejected": 0}
    assert spark.read.schema(S.REJECTED).parquet(warehouse.rejected).count() == 0


def test_a_page_without_markup_is_landed_once(spark, tmp_path):
    warehouse = R.Warehouse(str(tmp_path))
    raw = spark.createDataFrame([("Arsenal", 1, None), (None, None, "x")], S.RAW_PAGES)
    for _ in range(2):
        assert R.land(spark, warehouse, raw, F.lit("2025-01-02 06:00:00")) == 2
    assert R.read_pages(spark, warehouse).count() == 2


def test_legacy_failed_pages_only(spark):
    first, _, _ = frames(spark)
    pages = first.select(
        F.lit("k").alias("_hashedId"), F.lit("2025-01-02 06:00:00").cast("timestamp_ntz").alias("_extractedDate"), "*"
    )
    kept = silver.extract_articles(pages, legacy_failed_pages_only=True)
    assert values(kept.select("teamName", "title", "content", "id")) == [("Chelsea", "No title found", "No content found", None)]


# --- invariants on the test tables ------------------------------------------------------------------------------------


def test_trend_invariants(spark):
    from moodmart.workloads.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    trend = QUERIES["sentiment_trend"](spark, folder).collect()
    counts = {row["table_name"]: row["num_records"] for row in QUERIES["record_counts"](spark, folder).collect()}
    assert len({row["trend_id"] for row in trend}) == len(trend) == counts["df_fact_sentiment_trend"]
    assert sum(row["total_articles"] for row in trend) == counts["fact_reaction"] + counts["fact_title"]
    for row in trend:
        positive, negative = row["total_positive_articles"], row["total_negative_articles"]
        assert positive + negative + row["total_neutral_articles"] == row["total_articles"]
        assert row["trend_value"] == pytest.approx(100 * (positive - negative) / row["total_articles"])
        assert 0 <= row["subjectivity_level"] <= 100
    scores = QUERIES["fact_reaction"](spark, folder)
    assert scores.where("abs(sentiment_score) > 1 OR subjectivity_score NOT BETWEEN 0 AND 1").count() == 0
    assert scores.select("reaction_id").distinct().count() == counts["reaction"] == counts["fact_reaction"]
    assert inputs.articles(spark, folder).count() == counts["article"] == counts["fact_title"]
