"""One declared schema per table; every reader is given one, so nothing is inferred."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_TEXT, _LONG, _INT, _DATE, _REAL, _FLAG = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.DoubleType(), T.BooleanType(),
)

RAW_PAGES = _schema(teamName=_TEXT, page=_INT, html=_TEXT)
PAGES = _schema(_hashedId=_TEXT, _extractedDate=T.TimestampNTZType(), teamName=_TEXT, page=_INT, html=_TEXT)
ARTICLES = _schema(teamName=_TEXT, publishedDate=_DATE, title=_TEXT, content=_TEXT, id=_TEXT)
# Stored articles say which fetch they are from, so that a later run can tell which of two is to stay
STORED_ARTICLES = _schema(
    teamName=_TEXT, publishedDate=_DATE, title=_TEXT, content=_TEXT, id=_TEXT,
    _hashedId=_TEXT, _extractedDate=T.TimestampNTZType(), page=_INT,
)
REJECTED = _schema(_hashedId=_TEXT, _extractedDate=T.TimestampNTZType(), teamName=_TEXT, title=_TEXT, content=_TEXT)
ARTICLE = _schema(article_id=_TEXT, fk_team_id=_LONG, article_title=_TEXT, published_at=_DATE)
DIM_ARTICLE = T.StructType(ARTICLE.fields + [T.StructField("fk_title_id", _TEXT, True)])
DIM_TEAM = _schema(team_id=_LONG, team_name=_TEXT)
DIM_DATE = _schema(date_id=_DATE, year=_INT, month=_INT, day=_INT, week_of_year=_INT)
DIM_SENTIMENT = _schema(sentiment_label=_TEXT, sentiment_id=_LONG, sentiment_value=_LONG)
REACTION = _schema(
    reaction_id=_TEXT, fk_article_id=_TEXT, fk_team_id=_LONG, content=_TEXT, published_at=_DATE, is_fan=_FLAG,
)
FACT_REACTION = _schema(
    reaction_id=_TEXT, fk_article_id=_TEXT, fk_sentiment_id=_LONG, fk_team_id=_LONG, fk_date_id=_DATE, content=_TEXT,
    sentiment_score=_REAL, subjectivity_score=_REAL, is_subjective=_TEXT, is_fan=_FLAG,
)
FACT_TITLE = _schema(
    title_id=_TEXT, fk_sentiment_id=_LONG, fk_team_id=_LONG, fk_date_id=_DATE, title=_TEXT,
    sentiment_score=_REAL, subjectivity_score=_REAL, is_subjective=_TEXT, type=_TEXT,
)
SENTIMENT_TREND = _schema(
    trend_id=_TEXT, fk_team_id=_LONG, fk_date_id=_DATE, total_articles=_LONG, subjectivity_level=_REAL,
    trend_value=_REAL, total_positive_articles=_LONG, total_negative_articles=_LONG, total_neutral_articles=_LONG,
)
LEXICON = _schema(word=_TEXT, polarity_h=_INT, subjectivity_h=_INT)


def same_columns(left: DataFrame, right: DataFrame) -> bool:
    """Whether two frames have the same column names and types, whatever their order and nullability."""
    return {f.name: f.dataType for f in left.schema} == {f.name: f.dataType for f in right.schema}


def with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A schema with one more column, such as the one a table is partitioned by."""
    return T.StructType([*schema.fields, T.StructField(name, kind, True)])
