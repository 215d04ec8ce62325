"""The daily refresh: land pages, bring the articles up to date, rebuild the star schema.

Only the edges between layers are stored. Every job reads stored tables, so dimensions have a known size, and a table
that several jobs need is computed once.
"""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodmart import fixed_values as V
from moodmart import schemas as S
from moodmart.functions.dates import run_timestamp
from moodmart.operators.joins import measure
from moodmart.operators.merge import union_all, unmatched, upsert
from moodmart.plans import bronze, gold, silver
from moodmart.session import stage
from moodmart.sources.tables import last_commit, partition_name, read_table, write_table

LANDED = S.with_column(S.PAGES, "extracted_date", T.DateType())
_STORED_ARTICLES = S.with_column(S.STORED_ARTICLES, "published_month", T.StringType())
_STORED_REJECTED = S.with_column(S.REJECTED, "extracted_date", T.DateType())

GOLD_TABLES = {
    "dim_team": S.DIM_TEAM,
    "dim_date": S.DIM_DATE,
    "dim_sentiment": S.DIM_SENTIMENT,
    "article": S.ARTICLE,
    "dim_article": S.DIM_ARTICLE,
    "reaction": S.REACTION,
    "fact_reaction": S.FACT_REACTION,
    "fact_title": S.FACT_TITLE,
    V.TREND_TABLE_NAME: S.SENTIMENT_TREND,
}


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of one feed are."""

    root: str
    feed: str = V.FEED_NAME

    @property
    def pages(self) -> str:
        """Landed pages, one partition per day of fetching."""
        return f"{self.root}/bronze/{self.feed}"

    @property
    def articles(self) -> str:
        """Articles, one partition per month of publication."""
        return f"{self.root}/silver/{self.feed}/processed_data.parquet"

    @property
    def rejected(self) -> str:
        return f"{self.root}/silver/{self.feed}/rejected.parquet"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{self.feed}/{table}.parquet"


def read_pages(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return read_table(spark, warehouse.pages, LANDED)


def read_articles(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return read_table(spark, warehouse.articles, _STORED_ARTICLES).select(*S.ARTICLES.fieldNames())


def read_gold(spark: SparkSession, warehouse: Warehouse, table: str) -> DataFrame:
    return read_table(spark, warehouse.gold(table), GOLD_TABLES[table])


def _moment(spark: SparkSession, run_ts: Column | None) -> datetime:
    return spark.range(1).select((run_timestamp() if run_ts is None else run_ts).cast("timestamp_ntz")).first()[0]


def read_day(spark: SparkSession, warehouse: Warehouse, day: date) -> DataFrame:
    """The pages landed on one day; no other day's files are listed."""
    folder = partition_name(spark, extracted_date=day)
    return read_table(spark, warehouse.pages, LANDED, partitions=[folder]).where(F.col("extracted_date") == F.lit(day))


def land(
    spark: SparkSession, warehouse: Warehouse, raw: DataFrame, run_ts: Column | None = None, batch: str | None = None
) -> int:
    """Add fetched rows ``teamName, page, html`` to the day's pages; returns how many the day has then.

    Files are added, and of what the day has already only the keys are read. Pages that it has already are replaced, and
    only then its partition is written again. A ``batch`` that has a name is landed once: the names of a day's batches
    are kept with the table, and landing one of them again changes nothing.
    """
    # one moment for all rows and for the partition they go to
    moment = _moment(spark, run_ts)
    day = str(moment.date())
    state = last_commit(spark, warehouse.pages)
    batches = state.note.get("batches", {}) if state else {}
    if batch is not None and batch in batches:
        return read_day(spark, warehouse, moment.date()).count()
    # Names of earlier days go, so that the manifest does not grow with the history
    note = {"batches": {name: of for name, of in batches.items() if of >= day} | ({batch: day} if batch else {})}
    stamped = stage(bronze.stamp_pages(raw, F.lit(moment)))
    today = read_day(spark, warehouse, moment.date())
    again = stamped.select("_hashedId").join(today.select("_hashedId"), "_hashedId", "left_semi")
    target = {"partition_by": ["extracted_date"], "note": note}
    if again.isEmpty():
        added = stamped.withColumn("extracted_date", F.to_date("_extractedDate"))
        write_table(added, warehouse.pages, append=True, **target)
    else:
        merged = upsert(today.select(*S.PAGES.fieldNames()), stamped, "_hashedId")
        merged = merged.withColumn("extracted_date", F.to_date("_extractedDate"))
        write_table(merged, warehouse.pages, only_touched_partitions=True, **target)
    return read_day(spark, warehouse, moment.date()).count()


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def in_months_of(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored articles of the months that occur in ``keys``.

    The months are names of partitions, at most twelve per year of publication. They go into the plan as literals, so
    other partitions are not even listed.
    """
    months = keys.select(_month(F.col("publishedDate")).alias("month")).distinct().collect()
    return stored.where(F.col("published_month").isin([row["month"] for row in months]))


def refresh_articles(
    spark: SparkSession,
    warehouse: Warehouse,
    pages: DataFrame | None = None,
    maintain: Callable[[DataFrame, DataFrame], object] | None = None,
    **options,
) -> dict[str, int]:
    """Bring the article table up to date from ``pages`` (by default all landed ones).

    A key contains the publication date, so an article can only replace one of its own month. Months without new
    articles are neither read nor written: cost follows the pages given, not the history. The stored articles keep the
    fetch they are from and the same order decides in every run, so it does not matter how landed pages are dealt out
    to runs. Pages given again are judged again: whatever was rejected of them before is replaced.

    ``maintain`` gets the stored articles of the touched months and what replaces them, before they are replaced; a run
    broken off after it is to pass them again under the same number (:class:`moodmart.plans.maintained.MaintainedTrend`).
    """
    if pages is None:
        pages = read_pages(spark, warehouse)
    found = silver.articles_from_pages(pages, **options)
    stored = in_months_of(found.keys, read_table(spark, warehouse.articles, _STORED_ARTICLES))
    merged = silver.merge_articles(stored, found)
    if maintain is not None:
        merged = stage(merged)
        maintain(stored, merged)
    return {
        "articles": store_articles(warehouse, merged),
        "rejected": _store_rejected(spark, warehouse, pages, found.rejected),
    }


def store_articles(warehouse: Warehouse, articles: DataFrame) -> int:
    """Replace the months of the given articles (``STORED_ARTICLES``)."""
    dated = articles.select(*S.STORED_ARTICLES.fieldNames(), _month(F.col("publishedDate")).alias("published_month"))
    return write_table(
        # splits large months over several files and gathers the small ones
        dated.hint("rebalance", "published_month"),
        warehouse.articles,
        partition_by=["published_month"],
        only_touched_partitions=True,
    )


def _store_rejected(spark: SparkSession, warehouse: Warehouse, pages: DataFrame, rejected: DataFrame) -> int:
    """Replace what was rejected of the given pages. Only the days of these pages are read and written."""
    judged = stage(pages.select("_hashedId", F.to_date("_extractedDate").alias("extracted_date")).distinct())
    # As many as days of fetching among the pages
    days = [row[0] for row in judged.select("extracted_date").distinct().collect()]
    stored = read_table(spark, warehouse.rejected, _STORED_REJECTED).where(F.col("extracted_date").isin(days))
    key = F.concat_ws("|", "extracted_date", "_hashedId")
    others = unmatched(stored.withColumn("_key", key), judged.select(key.alias("_key")), "_key").drop("_key")
    kept = stage(union_all(rejected.withColumn("extracted_date", F.to_date("_extractedDate")), others))
    written = {row[0] for row in kept.select("extracted_date").distinct().collect()}
    # A day of which nothing is rejected any more has no rows that could replace its partition
    emptied = {row[0] for row in stored.select("extracted_date").distinct().collect()} - written
    return write_table(
        kept,
        warehouse.rejected,
        partition_by=["extracted_date"],
        only_touched_partitions=True,
        emptied=[partition_name(spark, extracted_date=day) for day in emptied],
    )


def refresh_gold(
    spark: SparkSession, warehouse: Warehouse, lexicon: DataFrame, band: float = V.NEUTRAL_BAND, iso_year: bool = False
) -> dict[str, int]:
    """Rebuild the star schema from the stored articles; returns the rows written to each table."""
    counts = {}

    def store(table: str, rows: DataFrame) -> DataFrame:
        counts[table] = write_table(rows.select(*GOLD_TABLES[table].fieldNames()), warehouse.gold(table))
        return read_gold(spark, warehouse, table)

    articles = read_articles(spark, warehouse)
    teams = store("dim_team", gold.dim_team(articles))
    dates = store("dim_date", gold.dim_date(articles, iso_year))
    sentiments = store("dim_sentiment", gold.dim_sentiment(spark))
    headers = store("article", gold.article(articles, teams))
    store("dim_article", gold.dim_article(headers))
    reactions = store("reaction", gold.reaction(articles, teams))
    size = measure(lexicon)
    reaction_facts = store("fact_reaction", gold.fact_reaction(reactions, sentiments, lexicon, band, size))
    title_facts = store("fact_title", gold.fact_title(headers, sentiments, lexicon, band, size))
    store(V.TREND_TABLE_NAME, gold.sentiment_trend(reaction_facts, title_facts, sentiments, dates))
    return counts


def refresh(
    spark: SparkSession,
    warehouse: Warehouse,
    raw: DataFrame,
    lexicon: DataFrame,
    run_ts: Column | None = None,
    **options,
) -> dict[str, int]:
    """One daily run, from fetched rows to the trend; returns the rows of every table it wrote.

    Only the pages of the run's day are extracted; earlier days are in the article table already.
    """
    moment = _moment(spark, run_ts)
    counts = {"pages": land(spark, warehouse, raw, F.lit(moment))}
    landed = read_day(spark, warehouse, moment.date())
    counts |= refresh_articles(spark, warehouse, landed, **options)
    counts |= refresh_gold(spark, warehouse, lexicon)
    return counts
