"""The trend kept up to date by signed counts instead of a rebuild.

A trend is made of cells: the number of facts per team, date, sentiment and subjectivity. An article that changes takes
its old facts' counts off its cells and adds the new ones', so a run scores the articles that changed and nothing else,
and rewrites the months of publication that they lie in.

Teams keep their number for good: a registry appends new teams after the greatest number. So cells of a run years ago
and of today name the same team by the same number.

Every run has a number, kept with the commit of the cells. A run that is repeated, because its caller did not learn that
it was committed, changes nothing; one that broke off before its commit left nothing to undo.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodmart import fixed_values as V
from moodmart import schemas as S
from moodmart.functions.dates import date_parts
from moodmart.functions.labels import label_flag
from moodmart.operators.changes import INSERTED, REMOVED, REPLACED, change_feed, new_rows, old_rows
from moodmart.operators.joins import dimension_join, measure
from moodmart.operators.merge import union_all
from moodmart.operators.numbering import number_sorted
from moodmart.plans import gold
from moodmart.session import settle, stage
from moodmart.sources.tables import last_commit, partition_name, read_table, write_table

_KEY = ("fk_team_id", "fk_date_id", "fk_sentiment_id", "subjective")
_STORED = T.StructType(
    [
        T.StructField("fk_team_id", T.LongType()),
        T.StructField("fk_date_id", T.DateType()),
        T.StructField("fk_sentiment_id", T.LongType()),
        T.StructField("subjective", T.LongType()),
        T.StructField("facts", T.LongType()),
        T.StructField("month", T.StringType()),
    ]
)
_CHANGES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("change", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("run", T.LongType()),
    ]
)


def extend_registry(registry: DataFrame, names: DataFrame) -> DataFrame:
    """The registry (team_id, team_name) with the names (team_name) it lacks, numbered by name after its greatest number."""
    unknown = names.select("team_name").where(F.col("team_name").isNotNull()).distinct()
    unknown = dimension_join(unknown, registry.select("team_name"), "team_name", "left_anti")
    # One row
    greatest = registry.agg(F.coalesce(F.max("team_id"), F.lit(0))).first()[0]
    added = number_sorted(unknown, "team_name", "team_id").withColumn("team_id", F.col("team_id") + F.lit(greatest))
    return union_all(registry.select("team_id", "team_name"), added.select("team_id", "team_name"))


def cells_of(articles: DataFrame, teams: DataFrame, lexicon: DataFrame, band: float = V.NEUTRAL_BAND) -> DataFrame:
    """Counts of the facts of ``articles`` (``ARTICLES``) by team, date, sentiment and subjectivity."""
    sentiments, size = gold.dim_sentiment(articles.sparkSession), measure(lexicon)
    reactions = gold.fact_reaction(gold.reaction(articles, teams), sentiments, lexicon, band, size)
    titles = gold.fact_title(gold.article(articles, teams), sentiments, lexicon, band, size)
    facts = gold.trend_facts(reactions, titles).withColumn(
        "subjective", label_flag(F.col("is_subjective"), "subjective").cast("long")
    )
    return facts.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("facts"))


def signed_cells(feed: DataFrame, teams: DataFrame, lexicon: DataFrame, band: float = V.NEUTRAL_BAND) -> DataFrame:
    """What a change feed of articles adds to every cell; cells that it leaves as they were are left out."""
    gone = cells_of(old_rows(feed), teams, lexicon, band).withColumn("facts", -F.col("facts"))
    come = cells_of(new_rows(feed), teams, lexicon, band)
    return union_all(gone, come).groupBy(*_KEY).agg(F.sum("facts").alias("facts")).where(F.col("facts") != 0)


def add_cells(cells: DataFrame, signed: DataFrame) -> DataFrame:
    return union_all(cells.select(*_KEY, "facts"), signed.select(*_KEY, "facts")).groupBy(*_KEY).agg(
        F.sum("facts").alias("facts")
    ).where(F.col("facts") != 0)


def trend_of_cells(cells: DataFrame, iso_year: bool = False) -> DataFrame:
    """The trend (as :func:`moodmart.plans.gold.trend_of`) of cells."""
    dates = cells.select(F.col("fk_date_id").alias("date_id")).distinct()
    calendar = dates.select("date_id", *date_parts(F.col("date_id"), iso_year))
    return gold.trend_of_counts(
        cells.select("fk_sentiment_id", "fk_team_id", "fk_date_id", F.col("subjective").alias("_s"), F.col("facts").alias("_n")),
        gold.dim_sentiment(cells.sparkSession),
        calendar,
    )


def _month(day: str) -> Column:
    return F.date_format(F.col(day), "yyyy-MM")


@dataclass(frozen=True)
class MaintainedTrend:
    """The registry, the cells and the keys changed by each run, below ``root``."""

    spark: SparkSession
    root: str

    @property
    def _cells(self) -> str:
        return f"{self.root}/trend_cells"

    @property
    def _teams(self) -> str:
        return f"{self.root}/team_registry"

    @property
    def _changes(self) -> str:
        return f"{self.root}/article_changes"

    def teams(self) -> DataFrame:
        return read_table(self.spark, self._teams, S.DIM_TEAM)

    def cells(self) -> DataFrame:
        return read_table(self.spark, self._cells, _STORED)

    def changes(self) -> DataFrame:
        """Per run the keys of the articles inserted, replaced and removed, with their month of publication."""
        return read_table(self.spark, self._changes, _CHANGES)

    def last_run(self) -> int:
        state = last_commit(self.spark, self._cells)
        return state.note.get("run", 0) if state else 0

    def apply(self, run: int, before: DataFrame, after: DataFrame, lexicon: DataFrame, band: float = V.NEUTRAL_BAND) -> dict[str, int]:
        """Bring the trend from the articles ``before`` to those ``after`` (``ARTICLES``, one row per id) as run ``run``.

        Only the articles that may differ have to be given: those of the months a refresh touches, or all. Returns the
        numbers of keys inserted, replaced and removed, which are all 0 if the run was committed before.
        """
        counts = dict.fromkeys((INSERTED, REPLACED, REMOVED), 0)
        if run <= self.last_run():
            return counts
        columns = S.ARTICLES.fieldNames()
        feed = stage(change_feed(before.select(*columns), after.select(*columns), "id"))
        counts |= {row["change"]: row["count"] for row in feed.groupBy("change").count().collect()}
        names = union_all(old_rows(feed), new_rows(feed)).select(F.col("teamName").alias("team_name"))
        registry = settle(extend_registry(self.teams(), names))
        write_table(registry, self._teams)
        teams = self.teams()
        month = F.coalesce(_month("new.publishedDate"), _month("old.publishedDate"))
        # Cells are few whatever the number of facts, and these are of the changed articles alone
        signed = settle(signed_cells(feed, teams, lexicon, band).withColumn("month", _month("fk_date_id")))
        write_table(
            feed.select("id", "change", month.alias("month"), F.lit(run).cast("long").alias("run")),
            self._changes,
            partition_by=["run"],
            only_touched_partitions=True,
        )
        # As many as months of publication among the changed articles
        months = [row["month"] for row in signed.select("month").distinct().collect()]
        folders = [partition_name(self.spark, month=month) for month in months]
        touched = read_table(self.spark, self._cells, _STORED, partitions=folders)
        merged = settle(add_cells(touched, signed).withColumn("month", _month("fk_date_id")))
        left = {row["month"] for row in merged.select("month").distinct().collect()}
        write_table(
            merged,
            self._cells,
            partition_by=["month"],
            only_touched_partitions=True,
            emptied=[folder for month, folder in zip(months, folders) if month not in left],
            note={"run": run},
        )
        return counts

    def trend(self, iso_year: bool = False) -> DataFrame:
        return trend_of_cells(self.cells(), iso_year)
