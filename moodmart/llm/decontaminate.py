"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``window`` consecutive words; an item of fewer words is one window. A
window's tokens are its shingles of ``shingle`` words. Tokens are ordered by rarity, that is by how often they occur in
the documents. Since a window must be contained whole, its necessary prefix is one token, the rarest; windows with a
token that no document has cannot occur. Prefix tokens are joined to their occurrences in the documents, the token's
place in the window gives the one place at which the window could start, places that leave the document are dropped,
and what remains is compared word by word.

The text is read once. A filter of fixed size holds the tokens of the benchmark; only occurrences that may be among
them leave the scan, each with the words around it, so that no later step needs the text.

Rules: A-Z are lower-cased, words are runs of 0-9, a-z and everything above 0x7F. A null or empty text has no words and
is not contaminated. Benchmark rows without a text or without words are left out; those without an identifier mark
words but are in no list of items. Repeated rows and identifiers, of documents or items, are all kept; a repeated item
is listed once. Only the named columns are read, so other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodmart.llm.tables import KeyFilter, free_name, key_filter, row_key, stage_numbered
from moodmart.llm.texts import Words, pieces, shingles, whole_shingles
from moodmart.operators.joins import dimension_join
from moodmart.session import stage

WINDOW_WORDS = 10
SHINGLE_WORDS = 5

_WINDOWS = "item_id string, window string, n int, tokens array<struct<offset:int,hash:bigint>>"
_SCANNED = "n_words bigint, hits array<struct<hash:bigint,pos:int,at:int,around:string>>"


def _windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            rows = []
            for first, _, data, offsets in pieces(batch.column("text")):
                words = Words(data, offsets)
                hashes = words.hashes()
                place, value = shingles(words, hashes, shingle)
                short_place, short_value = whole_shingles(words, hashes, shingle)
                at = dict(zip([*place.tolist(), *short_place.tolist()], [*value.view(np.int64).tolist(), *short_value.view(np.int64).tolist()]))
                for row in np.flatnonzero(words.count):
                    begin, count = int(words.first[row]), int(words.count[row])
                    length = min(window, count)
                    for start in range(begin, begin + count - length + 1):
                        tokens = [
                            {"offset": offset, "hash": at[start + offset]}
                            for offset in range(max(1, length - shingle + 1))
                        ]
                        rows.append((ids[first + row], words.text(start, start + length), length, tokens))
                        if len(rows) >= 1000:
                            yield _batch(rows)
                            rows = []
            if rows:
                yield _batch(rows)

    kind = pa.schema(
        [
            ("item_id", pa.string()),
            ("window", pa.string()),
            ("n", pa.int32()),
            ("tokens", pa.list_(pa.struct([("offset", pa.int32()), ("hash", pa.int64())]))),
        ]
    )

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(values), field.type) for values, field in zip(zip(*rows), kind)], schema=kind
        )

    chosen = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    return chosen.mapInArrow(cut, _WINDOWS)


def _occurrences(
    docs: DataFrame, known: KeyFilter, lengths: list[int], window: int, shingle: int
) -> DataFrame:
    """Per document its words and the occurrences of tokens that may be known, each with the words around it."""
    others = [field for field in docs.schema if field.name != "text"]
    widest = max(lengths, default=0)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = pa.struct([("hash", pa.int64()), ("pos", pa.int32()), ("at", pa.int32()), ("around", pa.string())])
        for batch in batches:
            kept = batch.select([field.name for field in others])
            for first, last, data, offsets in pieces(batch.column("text")):
                words = Words(data, offsets)
                hashes = words.hashes()
                hits: list[list[dict]] = [[] for _ in range(last - first)]
                for length in lengths:
                    place, value = shingles(words, hashes, length)
                    may = np.flatnonzero(known.may_hold(value))
                    for place_, value_ in zip(place[may].tolist(), value[may].view(np.int64).tolist()):
                        row = int(words.row[place_])
                        reach = window - length if length == shingle else 0
                        begin = max(int(words.first[row]), place_ - reach)
                        end = min(int(words.first[row + 1]), place_ + max(window, widest))
                        hits[row].append(
                            {
                                "hash": value_,
                                "pos": place_ - int(words.first[row]),
                                "at": place_ - begin,
                                "around": words.text(begin, end),
                            }
                        )
                part = kept.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(words.count, pa.int64()), pa.array(hits, pa.list_(hit))],
                    names=[*part.schema.names, "n_words", "hits"],
                )

    kept_schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in others)
    return docs.mapInArrow(scan, f"{kept_schema}, {_SCANNED}")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text) against ``items`` (item_id, text).

    Returns a row per document (doc_id, key, n_words, n_hit, n_items, item_ids, contaminated) and the spans found
    (rid, start, n, window), with rid numbering the rows of the first.
    """
    if not 0 < shingle <= window:
        raise ValueError("shingle must be from 1 to window words")
    windows = stage(_windows(items, window, shingle))
    distinct = stage(windows.dropDuplicates(["window"]).select("window", "n", "tokens"))
    tokens = stage(distinct.select(F.explode("tokens.hash").alias("hash")).distinct())
    # At most `shingle` different lengths: `shingle`, and those of shorter items
    lengths = sorted(
        row[0] for row in distinct.select(F.least("n", F.lit(shingle)).alias("length")).distinct().collect()
    )
    keyed = docs.select("doc_id", row_key().alias("key"), "text").select(
        "doc_id",
        F.col("key.id").alias("key_id"),
        F.col("key.text").alias("key_text"),
        F.col("key.check").alias("key_check"),
        "text",
    )
    scanned = stage_numbered(_occurrences(keyed, key_filter(tokens, "hash"), lengths, window, shingle))
    found = scanned.select("rid", F.explode("hits").alias("hit")).select("rid", "hit.*")

    counts = found.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    ranked = (
        distinct.select("window", "n", F.explode("tokens").alias("token"))
        .select("window", "n", "token.*")
        .join(counts, "hash", "left")
        .groupBy("window", "n")
        .agg(
            F.min(F.coalesce("rows", F.lit(0))).alias("least"),
            F.min(F.struct("rows", "hash", "offset")).alias("rarest"),
        )
    )
    prefixes = stage(ranked.where(F.col("least") > 0).select("rarest.hash", "rarest.offset", "window", "n"))

    candidates = dimension_join(found, prefixes, "hash")
    first = F.col("at") - F.col("offset")
    around = F.split("around", " ")
    inside = (first >= 0) & (first + F.col("n") <= F.size(around))
    spans = stage(
        candidates.where(inside)
        .where(F.array_join(F.slice(around, first + 1, F.col("n")), " ") == F.col("window"))
        .select("rid", (F.col("pos") - F.col("offset")).alias("start"), "n", "window")
        .distinct()
    )
    hit_words = (
        spans.select("rid", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("word"))
        .distinct()
        .groupBy("rid")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    members = stage(windows.where(F.col("item_id").isNotNull()).select("window", "item_id").distinct())
    listed = (
        dimension_join(spans.select("rid", "window").distinct(), members, "window")
        .select("rid", "item_id")
        .distinct()
        .groupBy("rid")
        .agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    )
    result = (
        scanned.select("rid", "doc_id", "key_id", "key_text", "key_check", "n_words")
        .join(hit_words, "rid", "left")
        .join(listed, "rid", "left")
        .select(
            "rid",
            "doc_id",
            F.struct(
                F.col("key_id").alias("id"), F.col("key_text").alias("text"), F.col("key_check").alias("check")
            ).alias("key"),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
        .withColumn("n_items", F.size("item_ids").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )
    return result, spans


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    result, _ = contamination(docs, items)
    name = free_name(docs, "_row_key")
    dropped = stage(result.where("contaminated").select(F.col("key").alias(name)).distinct())
    return dimension_join(docs.withColumn(name, row_key()), dropped, name, "left_anti").select(*docs.columns)
