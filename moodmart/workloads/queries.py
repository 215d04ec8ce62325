"""One query per operator and job, each over whole test tables."""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmart.functions import dates as D
from moodmart.functions import html as H
from moodmart.functions import labels as L
from moodmart.functions import text as T
from moodmart.operators import filters, merge, scoring
from moodmart.operators.joins import measure
from moodmart.plans import bronze, gold, refresh, silver
from moodmart.plans.maintained import MaintainedTrend
from moodmart.session import ensure_checkpoint_dir, stage
from moodmart.sources import feed, ledger, tables
from moodmart.workloads import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _registered(query: Query) -> Query:
    """Register a query. Dates and times leave as text, so that rows compare equal whatever a client makes of them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = query(spark, folder)
        return result.select(
            *[
                F.col(name).cast("string").alias(name) if kind in ("date", "timestamp", "timestamp_ntz") else name
                for name, kind in result.dtypes
            ]
        )

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


# --- landing ----------------------------------------------------------------------------------------------------------


@_registered
def page_list(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to fetch for every team."""
    names = I.table(spark, folder, "documents").select(F.col("source").alias("team_name")).distinct()
    return feed.page_list(names.select("team_name", T.url_slug(F.col("team_name")).alias("slug")))


@_registered
def run_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Order times as Vienna wall-clock time, through winters and summers."""
    moment = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return I.table(spark, folder, "orders").select(
        "o_orderkey", D.wall_clock(moment.cast("timestamp")).alias("wall_clock")
    )


@_registered
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return I.table(spark, folder, "documents").select("doc_id", T.text_hash(F.col("text")).alias("text_hash"))


@_registered
def land_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages landed into an empty day."""
    raw = I.raw_pages(spark, folder)
    history = spark.createDataFrame([], bronze.PAGES)
    return bronze.land_pages(raw, history, F.lit(I.FETCHED_AT))


@_registered
def legacy_html_key(spark: SparkSession, folder: str) -> DataFrame:
    """Pages keyed by markup alone, so failed fetches share keys."""
    return bronze.stamp_pages(I.raw_pages(spark, folder), F.lit(I.FETCHED_AT), key_on_html_only=True)


@_registered
def daily_name(spark: SparkSession, folder: str) -> DataFrame:
    return I.table(spark, folder, "events").select("event_id", T.daily_name(F.col("ts")).alias("daily_name"))


@_registered
def bronze_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A second run on one day: every page was fetched again, and every second one had changed."""
    raw = I.raw_pages(spark, folder)
    earlier = bronze.stamp_pages(raw, F.lit("2025-01-15 05:00:00"))
    changed = F.when(F.col("page_id") % 2 == 0, F.concat("html", F.lit("<!-- 2 -->"))).otherwise(F.col("html"))
    return bronze.land_pages(raw.withColumn("html", changed), earlier, F.lit(I.FETCHED_AT))


@_registered
def upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, replaced where there is a label, with the benchmark items added."""
    documents = I.table(spark, folder, "documents")
    history = documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    labels = I.table(spark, folder, "labels").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("text"),
    )
    items = I.table(spark, folder, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), "text"
    )
    return merge.upsert(history, merge.union_all(labels, items), "id")


# --- articles ---------------------------------------------------------------------------------------------------------


@_registered
def drop_failed_pages(spark: SparkSession, folder: str) -> DataFrame:
    return filters.drop_failed_pages(I.raw_pages(spark, folder))


@_registered
def legacy_keep_http_500(spark: SparkSession, folder: str) -> DataFrame:
    return filters.legacy_keep_http_500(I.raw_pages(spark, folder))


@_registered
def html_fields(spark: SparkSession, folder: str) -> DataFrame:
    pages = I.table(spark, folder, "pages").select("page_id", "html")
    return H.with_page_fields(pages, "html", I.PLAIN_PAGE).drop("html")


@_registered
def html_fields_default(spark: SparkSession, folder: str) -> DataFrame:
    """The default selectors, over every page written in the markup they look for."""
    return H.with_page_fields(I.default_pages(spark, folder), "html").drop("html")


@_registered
def published_date(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written as page timestamps, every tenth malformed, fetched up to 500 days later."""
    key = F.col("o_orderkey")
    text = F.when(key % 10 == 0, "No date found").otherwise(
        F.concat(
            F.lit("published at "),
            (key % 24).cast("string"),
            F.lit(":"),
            F.lpad((key % 60).cast("string"), 2, "0"),
            F.lit(" "),
            F.date_format("o_orderdate", "d MMMM"),
        )
    )
    fetched = F.date_add(F.to_date("o_orderdate"), (key % 500).cast("int"))
    return I.table(spark, folder, "orders").select(
        "o_orderkey", text.alias("published_text"), D.published_date(text, fetched).alias("published_date")
    )


@_registered
def article_key(spark: SparkSession, folder: str) -> DataFrame:
    return I.table(spark, folder, "documents").select(
        "doc_id", T.article_key(F.col("source"), I.day(F.col("doc_id")), F.col("text")).alias("article_key")
    )


@_registered
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest of each group of equal documents."""
    documents = I.table(spark, folder, "documents").select(
        T.text_hash(F.col("text")).alias("text_hash"), "doc_id", "source", "lang"
    )
    return merge.dedup_latest(documents, "text_hash", [F.col("doc_id").desc()])


@_registered
def title_blocklist(spark: SparkSession, folder: str) -> DataFrame:
    titles = I.document_articles(spark, folder).select(F.col("_order").alias("doc_id"), "title")
    return filters.drop_live_coverage(titles)


@_registered
def extracted_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Fields and key of the article on every fetched page, dated or not."""
    return silver.extract_articles(I.dated_pages(spark, folder), I.DATED_PAGE).select(
        F.col("_hashedId").alias("page_id"), "teamName", "publishedDate", "title", "content", "id"
    )


@_registered
def build_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of the pages merged into earlier ones; a third of those have kept their date, hence their key."""
    pages = I.dated_pages(spark, folder)
    raw = H.with_page_fields(I.table(spark, folder, "pages"), "html", I.PLAIN_PAGE)
    earlier = raw.select(
        F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string")).alias("teamName"),
        I.day(F.col("page_id"), 14).alias("publishedDate"),
        "title",
        F.lit("earlier").alias("content"),
        F.col("page_id").alias("_page"),
    )
    key = T.article_key(F.col("teamName"), F.col("publishedDate"), F.col("title"))
    history = merge.dedup_latest(earlier.withColumn("id", key), "id", [F.col("_page").desc()]).drop("_page")
    return silver.build_articles(pages, history, selectors=I.DATED_PAGE)


@_registered
def rejected_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages without a date, which are set aside."""
    pages = I.dated_pages(spark, folder)
    return silver.rejected_pages(pages, selectors=I.DATED_PAGE).select(
        F.col("_hashedId").alias("page_id"), "teamName", "title", "content"
    )


# --- dimensions -------------------------------------------------------------------------------------------------------


@_registered
def dim_team(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_team(I.articles(spark, folder))


@_registered
def article(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    return gold.article(articles, gold.dim_team(articles))


@_registered
def dim_article(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    return gold.dim_article(gold.article(articles, gold.dim_team(articles)))


@_registered
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_date(I.orders_as_articles(spark, folder))


@_registered
def dim_date_iso_year(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_date(I.orders_as_articles(spark, folder), iso_year=True)


@_registered
def legacy_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return gold.legacy_dim_date(I.orders_as_articles(spark, folder))


@_registered
def dim_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """The sentiments, with the number of titles of each."""
    articles = I.articles(spark, folder)
    headers = gold.article(articles, gold.dim_team(articles))
    sentiments = gold.dim_sentiment(spark)
    titles = gold.fact_title(headers, sentiments, I.lexicon(spark))
    counts = titles.groupBy(F.col("fk_sentiment_id").alias("sentiment_id")).agg(F.count(F.lit(1)).alias("titles"))
    return sentiments.join(counts, "sentiment_id", "left").select(
        "sentiment_label", "sentiment_id", "sentiment_value", F.coalesce("titles", F.lit(0)).alias("titles")
    )


# --- reactions --------------------------------------------------------------------------------------------------------


@_registered
def pro_reactions(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    return gold.pro_reactions(articles, gold.dim_team(articles))


@_registered
def fan_reactions(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    return gold.fan_reactions(articles, gold.dim_team(articles))


@_registered
def reaction(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    return gold.reaction(articles, gold.dim_team(articles))


# --- scores -----------------------------------------------------------------------------------------------------------


@_registered
def lexicon_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    documents = I.table(spark, folder, "documents").select("doc_id", "text")
    return scoring.label_scores(scoring.score_texts(documents, "text", I.lexicon(spark))).drop("text")


@_registered
def lexicon_sentiment_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The same scores by the way that lexicons too large to copy take."""
    documents = I.table(spark, folder, "documents").select("doc_id", "text")
    return scoring.label_scores(scoring.score_texts(documents, "text", I.lexicon(spark), max_rows=0)).drop("text")


@_registered
def polarity_class(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("event_id") % 50
    polarity = (
        F.when(number == 0, F.lit(0.2))
        .when(number == 1, F.lit(-0.2))
        .when(number == 2, F.lit(1.0))
        .when(number == 3, F.lit(-1.0))
        .when(number == 4, F.lit(float("nan")))
        .otherwise((F.col("value") - 20) / 25)
    )
    return I.table(spark, folder, "events").select("event_id", L.polarity_class(polarity).alias("polarity_class"))


@_registered
def subjectivity_class(spark: SparkSession, folder: str) -> DataFrame:
    subjectivity = F.when(F.col("event_id") % 50 == 0, F.lit(0.5)).otherwise(F.col("value") / 40)
    return I.table(spark, folder, "events").select(
        "event_id", L.subjectivity_class(subjectivity).alias("subjectivity_class")
    )


# --- facts ------------------------------------------------------------------------------------------------------------


@_registered
def fact_reaction(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    reactions = gold.reaction(articles, gold.dim_team(articles))
    return gold.fact_reaction(reactions, gold.dim_sentiment(spark), I.lexicon(spark))


@_registered
def fact_title(spark: SparkSession, folder: str) -> DataFrame:
    articles = I.articles(spark, folder)
    headers = gold.article(articles, gold.dim_team(articles))
    return gold.fact_title(headers, gold.dim_sentiment(spark), I.lexicon(spark))


def _trend(spark: SparkSession, folder: str, iso_year: bool = False) -> DataFrame:
    # four readers, each of other columns, so the articles are written once
    articles = stage(I.articles(spark, folder))
    teams, sentiments, lexicon = gold.dim_team(articles), gold.dim_sentiment(spark), I.lexicon(spark)
    size = measure(lexicon)
    reactions = gold.fact_reaction(gold.reaction(articles, teams), sentiments, lexicon, size=size)
    titles = gold.fact_title(gold.article(articles, teams), sentiments, lexicon, size=size)
    return gold.sentiment_trend(reactions, titles, sentiments, gold.dim_date(articles, iso_year))


@_registered
def sentiment_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly sentiment per team, from articles and comments to the trend."""
    return _trend(spark, folder)


@_registered
def trend_iso_year(spark: SparkSession, folder: str) -> DataFrame:
    """The trend with the week's own year, so a week across New Year is one row."""
    return _trend(spark, folder, iso_year=True)


@_registered
def legacy_trend_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """A trend in which each event counts once per event of its day."""
    facts = I.event_facts(spark, folder)
    dates = gold.legacy_dim_date(facts.select(F.col("fk_date_id").alias("publishedDate")))
    return gold.trend_of(facts, gold.dim_sentiment(spark), dates, legacy_date_fanout=True)


@_registered
def event_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The same events, each counted once."""
    facts = I.event_facts(spark, folder)
    dates = gold.dim_date(facts.select(F.col("fk_date_id").alias("publishedDate")))
    return gold.trend_of(facts, gold.dim_sentiment(spark), dates)


def _own_folder(spark: SparkSession) -> str:
    """A folder of the query's own in the shared place; what is stored there is removed once the result is stored."""
    return f"{ensure_checkpoint_dir(spark)}/tables-{uuid4().hex}"


@_registered
def record_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table of the star schema, counted while each was stored, for tables that read back as long."""
    root = _own_folder(spark)
    warehouse = refresh.Warehouse(root)
    found = I.articles(spark, folder).withColumns(
        {"_hashedId": F.col("id"), "_extractedDate": F.lit(I.FETCHED_AT).cast("timestamp_ntz"), "page": F.lit(1)}
    )
    refresh.store_articles(warehouse, found)
    counts = refresh.refresh_gold(spark, warehouse, I.lexicon(spark))
    back = {name: refresh.read_gold(spark, warehouse, name).count() for name in counts}
    tables.drop_table(spark, root)
    if back != counts:
        raise ValueError(f"counted {counts} in writing and {back} in reading")
    return tables.record_counts(spark, counts)


@_registered
def daily_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages landed on three days, each day's files read again with all others as one table."""
    root = _own_folder(spark)
    warehouse = refresh.Warehouse(root)
    raw = I.raw_pages(spark, folder)
    for place in range(3):
        of_day = raw.where(F.pmod("page_id", F.lit(3)) == place).select("teamName", "page", "html")
        refresh.land(spark, warehouse, of_day, F.lit(f"2025-01-{15 + place} 06:30:00"))
    everything = tables.read_prefix(spark, f"{root}/bronze", warehouse.feed, refresh.LANDED, ["extracted_date"])
    result = stage(everything)
    tables.drop_table(spark, root)
    return result


@_registered
def roster_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to fetch, for the teams of a JSON settings file."""
    root = _own_folder(spark)
    names = I.table(spark, folder, "documents").select("source").distinct()
    # One setting per team
    teams = names.agg(
        F.map_from_entries(F.collect_list(F.struct("source", T.url_slug(F.col("source"))))).alias("teams")
    )
    settings = F.to_json(F.struct(F.lit("x").alias("base_url"), F.lit(1).alias("nb_page"), "teams"))
    teams.select(settings.alias("value")).coalesce(1).write.text(root)
    result = stage(feed.page_list(feed.read_teams(spark, root)))
    tables.drop_table(spark, root)
    return result


@_registered
def incremental_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of pages fetched on three days and extracted in three runs, the latest day first."""
    root = _own_folder(spark)
    warehouse = refresh.Warehouse(root)
    pages = stage(I.daily_dated_pages(spark, folder))
    for place in (2, 0, 1):
        day = pages.where(F.to_date("_extractedDate") == F.lit(f"2025-01-{15 + place}").cast("date"))
        refresh.refresh_articles(spark, warehouse, day, selectors=I.DATED_PAGE)
    result = stage(refresh.read_articles(spark, warehouse))
    tables.drop_table(spark, root)
    return result


@_registered
def articles_after_an_empty_day(spark: SparkSession, folder: str) -> DataFrame:
    """Articles after a first run that finds none, as all its fetches failed, and three runs that do."""
    root = _own_folder(spark)
    warehouse = refresh.Warehouse(root)
    pages = stage(I.daily_dated_pages(spark, folder))
    refresh.refresh_articles(spark, warehouse, pages.withColumn("html", F.lit("HTTP error 500")))
    if refresh.read_articles(spark, warehouse).count():
        raise ValueError("failed fetches gave articles")
    for place in range(3):
        day = pages.where(F.to_date("_extractedDate") == F.lit(f"2025-01-{15 + place}").cast("date"))
        refresh.refresh_articles(spark, warehouse, day, selectors=I.DATED_PAGE)
    result = stage(refresh.read_articles(spark, warehouse))
    tables.drop_table(spark, root)
    return result


def _two_runs(spark: SparkSession, folder: str, root: str) -> MaintainedTrend:
    """A trend kept up through two days of articles; the second day is applied twice.

    A team and the articles whose key begins with 0 to 3 come on the second day; of the others, those with 4 or 5 have
    another text on the first, and those with f are gone on the second.
    """
    articles = stage(I.articles(spark, folder))
    begin = F.left("id", F.lit(1))
    late = (F.col("teamName") == I.LATE_TEAM) | (begin <= "3")
    older = F.when(begin.isin("4", "5"), F.concat("content", F.lit(" the and of the"))).otherwise(F.col("content"))
    first = articles.where(~late).withColumn("content", older)
    second = articles.where(late | (begin != "f"))
    maintained, lexicon = MaintainedTrend(spark, root), I.lexicon(spark)
    maintained.apply(1, articles.where("false"), first, lexicon)
    for _ in range(2):
        maintained.apply(2, first, second, lexicon)
    return maintained


@_registered
def maintained_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The weekly trend after a day of new, changed and withdrawn articles, from signed counts of the changes alone."""
    root = _own_folder(spark)
    result = stage(_two_runs(spark, folder, root).trend())
    tables.drop_table(spark, root)
    return result


@_registered
def team_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Teams under numbers that stay: a team that comes later is numbered after the others."""
    root = _own_folder(spark)
    result = stage(_two_runs(spark, folder, root).teams())
    tables.drop_table(spark, root)
    return result


@_registered
def article_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The keys that each of the runs inserted, replaced and removed."""
    root = _own_folder(spark)
    result = stage(_two_runs(spark, folder, root).changes())
    tables.drop_table(spark, root)
    return result


@_registered
def landed_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of two days in three batches each, every batch landed twice and the first one's pages fetched again."""
    root = _own_folder(spark)
    warehouse = refresh.Warehouse(root)
    raw = I.raw_pages(spark, folder)
    columns = ("teamName", "page", "html")
    for day in (15, 16):
        for place in range(3):
            batch = raw.where(F.pmod("page_id", F.lit(3)) == place).select(*columns)
            for _ in range(2):
                refresh.land(spark, warehouse, batch, F.lit(f"2025-01-{day} 0{place + 1}:30:00"), f"{day}-{place}")
    first = raw.where(F.pmod("page_id", F.lit(3)) == 0).select(*columns)
    refresh.land(spark, warehouse, first, F.lit("2025-01-16 09:30:00"), "16-again")
    result = stage(refresh.read_pages(spark, warehouse))
    tables.drop_table(spark, root)
    return result


@_registered
def run_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table written by two runs, the second of which is recorded twice."""
    root = _own_folder(spark)
    maintained = _two_runs(spark, folder, root)
    for run, moment in ((1, "2025-01-15 06:30:00"), (2, "2025-01-16 06:30:00"), (2, "2025-01-16 06:30:00")):
        counts = {row["change"]: row["count"] for row in maintained.changes().where(F.col("run") == run).groupBy("change").count().collect()}
        ledger.record_run(spark, f"{root}/runs", run, F.lit(moment), counts)
    result = stage(ledger.read_runs(spark, f"{root}/runs").drop("recorded"))
    tables.drop_table(spark, root)
    return result
