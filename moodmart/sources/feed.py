"""The teams of the feed and the pages to fetch for each."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodmart import fixed_values as V
from moodmart.functions.text import url_slug

_CONFIG = T.StructType(
    [
        T.StructField("base_url", T.StringType()),
        T.StructField("nb_page", T.IntegerType()),
        T.StructField("teams", T.MapType(T.StringType(), T.StringType())),
    ]
)


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    """``team_name, slug`` from the ``teams`` map of a JSON settings file."""
    config = spark.read.schema(_CONFIG).option("multiLine", "true").json(path)
    return config.select(F.explode("teams").alias("team_name", "slug"))


def default_teams(spark: SparkSession) -> DataFrame:
    names = spark.createDataFrame([(name,) for name in V.TEAM_NAMES], "team_name string")
    return names.select("team_name", url_slug(F.col("team_name")).alias("slug"))


def page_list(teams: DataFrame, pages: int = V.PAGES_PER_TEAM, base_url: str = V.FEED_URL) -> DataFrame:
    """``team_name, page, url`` for pages 1 to ``pages`` of every team."""
    numbered = teams.select("team_name", "slug", F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page"))
    url = F.concat(F.lit(base_url + "/"), "slug", F.lit("/?page="), F.col("page").cast("string"))
    return numbered.select("team_name", "page", url.alias("url"))
