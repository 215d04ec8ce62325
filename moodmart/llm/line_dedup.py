"""Removal of lines that many documents share.

Texts are split at \\n. A line's key is the line without the characters 0x20 and 0x09 to 0x0D at its ends, with A-Z
lower-cased; it is known by a 128-bit hash. Each document counts once per key; keys of at least ``min_chars`` code points
found in at least ``min_documents`` documents lose all their lines, and the rest is put together again by position.

Lines are stored once as (document, position, hash) and never carry their text. Keys that hold a large share of all lines
are few whatever the data (at most ``HOT_PARTS`` can hold a part in ``HOT_PARTS`` each), so these are broadcast; every
other key is rare enough to be joined. Positions are set against the text by one join on the document.

Rules: a null or empty text is one empty line, and its kept text is empty. Rows that differ in doc_id or text are
documents of their own, also when doc_id is null; rows equal in both are one document and all get its result. Helper
columns start with an underscore, so those are the only names that ``docs`` must not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.llm.tables import row_key
from moodmart.session import stage

MIN_DOCUMENTS = 10
MIN_CHARS = 1
HOT_PARTS = 10_000

_BLANK = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else. Pure ASCII takes the fast built-in, which does the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(_BLANK)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, dropped): per row key the positions (from 0) of the lines to drop, sorted; no row where there are none."""
    split = docs.select(row_key().alias("key"), F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    keys = split.select("key", "position", line_key(F.col("line")).alias("line"))
    lines = stage(
        keys.where(F.char_length("line") >= min_chars).select(
            "key",
            "position",
            F.xxhash64("line").alias("first"),
            F.xxhash64(F.lit(1), F.col("line")).alias("second"),
        )
    )
    counts = (
        lines.select("first", "second", "key").distinct().groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    )
    shared = stage(counts.where(F.col("n") >= min_documents))
    # The counts add up to the number of lines at most, so at most HOT_PARTS keys reach this
    hot_from = lines.count() // HOT_PARTS + 1
    hot = shared.where(F.col("n") >= hot_from).select("first", "second", F.lit(True).alias("hot"))
    marked = lines.join(F.broadcast(hot), ["first", "second"], "left")
    cold = marked.where(F.col("hot").isNull()).join(
        shared.where(F.col("n") < hot_from).select("first", "second"), ["first", "second"], "left_semi"
    )
    dropped = marked.where("hot").select("key", "position").unionByName(cold.select("key", "position"))
    return dropped.groupBy("key").agg(F.sort_array(F.collect_set("position")).alias("dropped"))


def without_shared_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """All rows and columns of ``docs``, with _n_lines, _n_dropped and _kept, the text of the lines that stay."""
    dropped = dropped_lines(docs, min_documents, min_chars).select(F.col("key").alias("_key"), "dropped")
    dropped = dropped.withColumnRenamed("dropped", "_dropped")
    joined = docs.withColumn("_key", row_key()).join(dropped, "_key", "left")
    lines = lines_of(F.col("text"))
    # The lines between one dropped position and the next, for all of them, in order
    kept = F.flatten(F.zip_with("_starts", "_ends", lambda a, b: F.slice(F.col("_lines"), a + 2, b - a - 1)))
    return (
        joined.withColumn("_lines", lines)
        .withColumn("_starts", F.concat(F.array(F.lit(-1)), F.col("_dropped")))
        .withColumn("_ends", F.concat(F.col("_dropped"), F.array(F.size("_lines"))))
        .select(
            *docs.columns,
            F.size("_lines").cast("long").alias("_n_lines"),
            F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("_n_dropped"),
            F.when(F.col("_dropped").isNull(), F.coalesce("text", F.lit("")))
            .otherwise(F.array_join(kept, "\n"))
            .alias("_kept"),
        )
    )


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )
