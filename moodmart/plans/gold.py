"""The star schema: dimensions, facts and the weekly trend."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmart import fixed_values as V
from moodmart.functions.dates import date_parts
from moodmart.functions.labels import label_flag
from moodmart.functions.text import fan_key, professional_key, title_key, trend_key
from moodmart.operators.filters import keep_fan, keep_professional
from moodmart.operators.joins import Size, dimension_join
from moodmart.operators.merge import union_all
from moodmart.operators.numbering import number_sorted
from moodmart.operators.reactions import article_reactions, explode_comments
from moodmart.operators.scoring import label_scores, score_texts
from moodmart.schemas import DIM_SENTIMENT, REACTION

_TREND_COLUMNS = ("fk_sentiment_id", "fk_team_id", "fk_date_id", "is_subjective")


# --- dimensions -------------------------------------------------------------------------------------------------------


def dim_team(articles: DataFrame, **limits: int) -> DataFrame:
    """Teams numbered by name. Numbers change when the set of teams does, so make it once and pass it on."""
    names = articles.select(F.col("teamName").alias("team_name"))
    return number_sorted(names, "team_name", "team_id", **limits)


def with_team_id(rows: DataFrame, teams: DataFrame, **limits: int) -> DataFrame:
    """Replace ``teamName`` by ``fk_team_id``; rows of unknown teams go."""
    keys = teams.select(F.col("team_name").alias("teamName"), F.col("team_id").alias("fk_team_id"))
    return dimension_join(rows, keys, "teamName", "inner", **limits).drop("teamName")


def article(articles: DataFrame, teams: DataFrame) -> DataFrame:
    headers = articles.select(
        F.col("id").alias("article_id"),
        F.col("title").alias("article_title"),
        F.col("publishedDate").alias("published_at"),
        "teamName",
    )
    return with_team_id(headers, teams).select("article_id", "fk_team_id", "article_title", "published_at")


def dim_article(article_table: DataFrame) -> DataFrame:
    return article_table.withColumn("fk_title_id", title_key(F.col("article_id")))


def dim_date(articles: DataFrame, iso_year: bool = False) -> DataFrame:
    """The publication dates that occur, each once. ``iso_year`` gives the year that the ISO week belongs to."""
    dates = articles.select(F.col("publishedDate").alias("date_id")).distinct()
    return dates.select("date_id", *date_parts(F.col("date_id"), iso_year))


def legacy_dim_date(articles: DataFrame) -> DataFrame:
    """The older date dimension, with a row for every article."""
    return articles.select(F.col("publishedDate").alias("date_id")).select("date_id", *date_parts(F.col("date_id")))


def dim_sentiment(spark: SparkSession) -> DataFrame:
    """The three sentiments, as a relation the planner knows the size of."""
    rows = ", ".join(f"('{label}', {key}L, {value}L)" for label, key, value in V.SENTIMENTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS sentiments({', '.join(DIM_SENTIMENT.fieldNames())})")


# --- reactions --------------------------------------------------------------------------------------------------------


def pro_reactions(articles: DataFrame, teams: DataFrame) -> DataFrame:
    """Every professional article as one reaction."""
    rows = keep_professional(articles).select(
        professional_key(F.col("id")).alias("reaction_id"),
        F.col("id").alias("fk_article_id"),
        "teamName",
        "content",
        F.col("publishedDate").alias("published_at"),
        F.lit(False).alias("is_fan"),
    )
    return with_team_id(rows, teams).select(*REACTION.fieldNames())


def fan_reactions(articles: DataFrame, teams: DataFrame) -> DataFrame:
    """The readers' comments of every fan article."""
    rows = explode_comments(keep_fan(articles).select("id", "teamName", "publishedDate", "content")).select(
        fan_key(F.col("id"), F.col("number")).alias("reaction_id"),
        F.col("id").alias("fk_article_id"),
        "teamName",
        F.col("reaction").alias("content"),
        F.col("publishedDate").alias("published_at"),
        F.lit(True).alias("is_fan"),
    )
    return with_team_id(rows, teams).select(*REACTION.fieldNames())


def reaction(articles: DataFrame, teams: DataFrame) -> DataFrame:
    """All reactions: the rows of :func:`fan_reactions` and :func:`pro_reactions`, from one scan of the articles."""
    made = articles.select(
        F.col("id").alias("fk_article_id"),
        "teamName",
        F.col("publishedDate").alias("published_at"),
        F.inline(article_reactions(F.col("id"), F.col("title"), F.col("content"))),
    )
    return with_team_id(made, teams).select(*REACTION.fieldNames())


# --- facts ------------------------------------------------------------------------------------------------------------


def _with_sentiment_id(labelled: DataFrame, sentiments: DataFrame) -> DataFrame:
    keys = sentiments.select("sentiment_label", F.col("sentiment_id").alias("fk_sentiment_id"))
    # Three constant rows, stored or not
    return labelled.join(F.broadcast(keys), "sentiment_label", "left")


def fact_reaction(
    reactions: DataFrame,
    sentiments: DataFrame,
    lexicon: DataFrame,
    band: float = V.NEUTRAL_BAND,
    size: Size | None = None,
) -> DataFrame:
    """Scores of every reaction. They are columns of the reaction's own row; nothing is joined back to it."""
    labelled = label_scores(score_texts(reactions, "content", lexicon, size=size), band)
    return _with_sentiment_id(labelled, sentiments).select(
        "reaction_id",
        "fk_article_id",
        "fk_sentiment_id",
        "fk_team_id",
        F.col("published_at").alias("fk_date_id"),
        "content",
        "sentiment_score",
        "subjectivity_score",
        "is_subjective",
        "is_fan",
    )


def fact_title(
    article_table: DataFrame,
    sentiments: DataFrame,
    lexicon: DataFrame,
    band: float = V.NEUTRAL_BAND,
    size: Size | None = None,
) -> DataFrame:
    """Scores of every article title."""
    labelled = label_scores(score_texts(article_table, "article_title", lexicon, size=size), band)
    return _with_sentiment_id(labelled, sentiments).select(
        title_key(F.col("article_id")).alias("title_id"),
        "fk_sentiment_id",
        "fk_team_id",
        F.col("published_at").alias("fk_date_id"),
        F.col("article_title").alias("title"),
        "sentiment_score",
        "subjectivity_score",
        "is_subjective",
        F.lit("title").alias("type"),
    )


def trend_facts(reactions: DataFrame, titles: DataFrame) -> DataFrame:
    """Both fact tables as one, with the columns a trend needs."""
    return union_all(reactions.select(*_TREND_COLUMNS), titles.select(*_TREND_COLUMNS))


def sentiment_trend(
    reactions: DataFrame,
    titles: DataFrame,
    sentiments: DataFrame,
    dates: DataFrame,
    legacy_date_fanout: bool = False,
) -> DataFrame:
    """Counts and mean sentiment per team, year and week. See :func:`trend_of`."""
    return trend_of(trend_facts(reactions, titles), sentiments, dates, legacy_date_fanout)


def trend_of(
    facts: DataFrame, sentiments: DataFrame, dates: DataFrame, legacy_date_fanout: bool = False
) -> DataFrame:
    """Counts and mean sentiment of facts per team, year and week.

    Facts are counted per team, date, sentiment and subjectivity before anything is joined. These cells are few
    whatever the number of facts, and counting is combined before the shuffle, so a team or date with a third of all
    facts costs one row per input task. Everything after works on weighted cells.

    ``legacy_date_fanout`` counts each fact once per row of its date in ``dates``, as joining with a date table that
    has repeated rows does; here the repetition is a weight and the rows are never made.
    """
    cells = (
        facts.select(
            "fk_sentiment_id", "fk_team_id", "fk_date_id", label_flag(F.col("is_subjective"), "subjective").alias("_s")
        )
        .groupBy("fk_sentiment_id", "fk_team_id", "fk_date_id", "_s")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return trend_of_counts(cells, sentiments, dates, legacy_date_fanout)


def trend_of_counts(
    cells: DataFrame, sentiments: DataFrame, dates: DataFrame, legacy_date_fanout: bool = False
) -> DataFrame:
    """The trend of facts that are counted already: ``_n`` of them per team, date, sentiment and flag ``_s``."""
    calendar = dates.groupBy(F.col("date_id").alias("fk_date_id"), "year", "week_of_year").agg(
        (F.count(F.lit(1)) if legacy_date_fanout else F.lit(1).cast("long")).alias("_copies")
    )
    values = sentiments.select(F.col("sentiment_id").alias("fk_sentiment_id"), "sentiment_label", "sentiment_value")
    weighted = (
        cells.join(calendar, "fk_date_id", "left")
        .join(values, "fk_sentiment_id", "left")
        .withColumn("_n", F.col("_n") * F.coalesce("_copies", F.lit(1)))
    )

    # The key is null if any part is, and then all such rows are one group
    parts = ("fk_team_id", "year", "week_of_year")
    complete = F.lit(True)
    for part in parts:
        complete = complete & F.col(part).isNotNull()
    weighted = weighted.select(
        "*", *[F.when(complete, F.col(part)).alias(f"_{part}") for part in parts]
    )

    def mean_percent(value: str) -> Column:
        known = F.sum(F.when(F.col(value).isNotNull(), F.col("_n")))
        return F.sum(F.col(value) * F.col("_n")) / known * 100

    def count_label(label: str) -> Column:
        return F.sum(F.when(F.col("sentiment_label") == label, F.col("_n")).otherwise(0))

    return (
        weighted.groupBy(*[f"_{part}" for part in parts])
        .agg(
            F.min("fk_team_id").alias("fk_team_id"),
            F.min("fk_date_id").alias("fk_date_id"),
            F.sum("_n").alias("total_articles"),
            mean_percent("_s").alias("subjectivity_level"),
            mean_percent("sentiment_value").alias("trend_value"),
            count_label("positive").alias("total_positive_articles"),
            count_label("negative").alias("total_negative_articles"),
            count_label("neutral").alias("total_neutral_articles"),
        )
        .select(
            trend_key(*[F.col(f"_{part}") for part in parts]).alias("trend_id"),
            "fk_team_id",
            "fk_date_id",
            "total_articles",
            "subjectivity_level",
            "trend_value",
            "total_positive_articles",
            "total_negative_articles",
            "total_neutral_articles",
        )
    )
