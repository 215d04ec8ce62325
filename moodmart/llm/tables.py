"""Reading the document tables, naming rows, and fixed-size filters that are sent to every task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmart.session import stage
from moodmart.sources.tables import drop_table

# A filter is at most 2^27 bits (16 MiB), whatever the number of keys in it
MAX_FILTER_BITS = 1 << 27
MIN_FILTER_BITS = 1 << 16
BITS_PER_KEY = 64

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row by its identifier and text, the same in every evaluation, with no nulls.

    Rows equal in both have one key: results that depend on the text alone may be stored once and joined to all of them.
    """
    identifier = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.struct(
        F.xxhash64(F.lit(1), identifier).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text"),
        F.xxhash64(F.lit(2), F.coalesce(F.col(text), F.lit(""))).alias("check"),
    )


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame is called so."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let_go(*staged: DataFrame) -> None:
    """Delete tables made by ``stage`` that nothing reads any more, so that a long job keeps only what it still needs.

    Whatever was derived from them must have been stored itself: a stored table has no lineage that leads back to them.
    """
    for frame in staged:
        folders = {file.rsplit("/", 1)[0] for file in frame.inputFiles()}
        for folder in folders:
            if "/staged-" not in folder:
                raise ValueError(f"{folder} was not made by stage")
            drop_table(frame.sparkSession, folder)


def stage_numbered(frame: DataFrame, name: str = "rid") -> DataFrame:
    """Store a frame with a number per row. Readers see the stored numbers, so these never change under a retry."""
    return stage(frame.withColumn(name, F.monotonically_increasing_id()))


class KeyFilter:
    """Which 64-bit keys may be in a set: one bit per key, so false positives occur and false negatives do not."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(words.size * 64 - 1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        bits = keys & self.mask
        return (self.words[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) == 1


def key_filter(keys: DataFrame, column: str) -> KeyFilter:
    """Build a filter from a stored table of distinct keys. The bits are set by the tasks; words of 64 bits are gathered."""
    wanted = max(MIN_FILTER_BITS, keys.count() * BITS_PER_KEY)
    bits = min(MAX_FILTER_BITS, 1 << (wanted - 1).bit_length())
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        keys.select(F.shiftright(place, 6).cast("int").alias("word"), (place.bitwiseAND(F.lit(63))).alias("bit"))
        .select("word", F.expr("shiftleft(1L, cast(bit as int))").alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
    )
    filled = np.zeros(bits // 64, np.int64)
    # At most 2^21 words, by the cap on the filter's size
    gathered = words.toArrow()
    filled[gathered["word"].to_numpy()] = gathered["bits"].to_numpy()
    return KeyFilter(filled.view(np.uint64))
