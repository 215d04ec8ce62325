"""Landing of fetched pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.functions.dates import run_timestamp
from moodmart.functions.text import page_key, text_hash
from moodmart.operators.merge import upsert
from moodmart.schemas import PAGES


def stamp_pages(raw: DataFrame, run_ts: Column | None = None, key_on_html_only: bool = False) -> DataFrame:
    """Fetched rows ``teamName, page, html`` with their key and the run time.

    ``key_on_html_only`` is the older key, under which equal pages of two teams replace each other.
    """
    stamp = run_timestamp() if run_ts is None else run_ts
    key = (
        text_hash(F.col("html"))
        if key_on_html_only
        else page_key(F.col("teamName"), F.col("page"), F.col("html"))
    )
    return raw.select(
        key.alias("_hashedId"),
        stamp.cast("timestamp_ntz").alias("_extractedDate"),
        "teamName",
        F.col("page").cast("int").alias("page"),
        "html",
    )


def land_pages(
    raw: DataFrame, history: DataFrame, run_ts: Column | None = None, key_on_html_only: bool = False, **limits: int
) -> DataFrame:
    """The day's pages after this run: the new ones, and the ones landed before that are not among them."""
    batch = stamp_pages(raw, run_ts, key_on_html_only)
    return upsert(history.select(*PAGES.fieldNames()), batch, "_hashedId", **limits)
