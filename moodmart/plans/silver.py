"""Articles out of landed pages."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.functions.dates import published_date
from moodmart.functions.html import PageSelectors, with_page_fields
from moodmart.functions.text import article_key, text_hash
from moodmart.operators.filters import drop_failed_pages, drop_live_coverage, legacy_keep_http_500
from moodmart.operators.merge import dedup_latest, split_by_keys, union_all, upsert
from moodmart.schemas import ARTICLES, REJECTED, STORED_ARTICLES
from moodmart.session import stage


@dataclass(frozen=True)
class Articles:
    """``accepted`` has one row per article and the fetch it is from; ``rejected`` are pages without a usable date.

    ``keys`` has ``id`` and ``publishedDate`` of the accepted articles, some more than once; unlike ``accepted`` it
    needs no shuffle.
    """

    accepted: DataFrame
    rejected: DataFrame
    keys: DataFrame


def extract_articles(
    pages: DataFrame,
    selectors: PageSelectors = PageSelectors(),
    run_year: Column | None = None,
    legacy_failed_pages_only: bool = False,
) -> DataFrame:
    """One row per fetched page, with the fields and the key of its article; narrow, so nothing is shuffled.

    Unwanted titles go before the rows are compared by key. Rows with one key have one title, so that order gives the
    same rows as the other and moves fewer.
    """
    fetched = legacy_keep_http_500(pages) if legacy_failed_pages_only else drop_failed_pages(pages)
    fields = with_page_fields(fetched, "html", selectors).drop("html")
    dated = fields.withColumn(
        "publishedDate", published_date(F.col("publishedDate"), F.col("_extractedDate"), run_year)
    )
    keyed = dated.withColumn("id", article_key(F.col("teamName"), F.col("publishedDate"), F.col("title")))
    return drop_live_coverage(keyed)


def latest_articles(extracted: DataFrame) -> DataFrame:
    """One row per key: from the newest fetch, then the lowest page, then by content hash and page key.

    The order is total and the columns it needs stay with the rows, so taking the latest of parts and then the latest of
    those gives the same rows as taking it of all at once, however the pages are split.
    """
    order = [F.col("_extractedDate").desc(), F.col("page"), text_hash(F.col("content")), F.col("_hashedId")]
    return dedup_latest(extracted, "id", order).select(*STORED_ARTICLES.fieldNames())


def articles_from_pages(pages: DataFrame, **options) -> Articles:
    """All articles on a set of landed pages. ``options`` are those of :func:`extract_articles`.

    Extraction is the costly part and its result has several readers, so it is written once, without the markup.
    """
    extracted = stage(extract_articles(pages, **options).select(*STORED_ARTICLES.fieldNames()))
    has_key = F.col("id").isNotNull()
    keyed = extracted.where(has_key)
    return Articles(
        accepted=latest_articles(keyed),
        rejected=extracted.where(~has_key).select(*REJECTED.fieldNames()),
        keys=keyed.select("id", "publishedDate"),
    )


def build_articles(pages: DataFrame, history: DataFrame, **options) -> DataFrame:
    """The article table after a run: what the pages hold, and earlier articles that are not among it."""
    found = articles_from_pages(pages, **options)
    accepted = found.accepted.select(*ARTICLES.fieldNames())
    return upsert(history.select(*ARTICLES.fieldNames()), accepted, "id", batch_keys=found.keys)


def rejected_pages(pages: DataFrame, **options) -> DataFrame:
    """Only the pages without a usable date. Nothing else reads the extraction then, so it is not written."""
    extracted = extract_articles(pages, **options)
    return extracted.where(F.col("id").isNull()).select(*REJECTED.fieldNames())


def merge_articles(stored: DataFrame, found: Articles) -> DataFrame:
    """Stored articles and those just found, one per key by the order of :func:`latest_articles`.

    Stored articles whose key was not found pass through; only the others compete.
    """
    parts = split_by_keys(stored.select(*found.accepted.columns), found.keys, "id")
    return union_all(latest_articles(union_all(parts.matched, found.accepted)), parts.unmatched)
