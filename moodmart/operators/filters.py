"""Row filters on fetched pages and article titles. Each is one regular expression, so one pass over the column."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart import fixed_values as V


def any_pattern(patterns: Sequence[str]) -> str:
    """One expression for all patterns; ``\\s`` means any Unicode space."""
    return "(?U)" + "|".join(patterns)


def drop_failed_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Keep the pages that were fetched; a failed one holds an error text instead of markup."""
    return pages.where(~F.col(html).rlike(V.FETCH_FAILURE))


def legacy_keep_http_500(pages: DataFrame, html: str = "html") -> DataFrame:
    """The inverse that older results were made with: only pages that failed with status 500 remain."""
    return pages.where(F.col(html) == V.HTTP_500)


def drop_live_coverage(
    articles: DataFrame, title: str = "title", patterns: Sequence[str] = V.LIVE_COVERAGE_TITLES
) -> DataFrame:
    """Drop announcements of live coverage, and rows without a title."""
    return articles.where(~F.col(title).rlike(any_pattern(patterns)))


def is_professional(title: Column) -> Column:
    return ~title.rlike(any_pattern(V.NOT_PROFESSIONAL_TITLES))


def is_fan(title: Column) -> Column:
    return title.contains(V.FAN_TITLE)


def keep_professional(articles: DataFrame, title: str = "title") -> DataFrame:
    """Keep articles whose reaction is the writer's own. Not the complement of :func:`keep_fan`."""
    return articles.where(is_professional(F.col(title)))


def keep_fan(articles: DataFrame, title: str = "title") -> DataFrame:
    """Keep articles that collect readers' comments."""
    return articles.where(is_fan(F.col(title)))
