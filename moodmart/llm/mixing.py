"""Mixing sources to target sizes by pivotal dependent rounding in a reduction tree.

A document's size is its number of words. Every source has a target, and all its documents the same expected number of
copies, target / source size. Its whole part is taken; its fraction is a probability that has to become 0 or 1. Two
documents with fractions are paired and mass (fraction times size) moves between them until one is at 0 or at its full
size, either way with the chances that keep both expectations. The other goes on to the next pair. So all words of a
source stay in balance, and at the end one document holds a fraction, which is rounded: the source misses its target by
at most half of that document.

Pairs are made within blocks of about ``BLOCK`` documents of a source; each block leaves at most one residual, residuals
of ``FAN`` blocks form a block of the next level, and so on up to one block per source. Within a block the larger
documents come first, so that what is left over is a small one. Blocks and draws come from hashes of identifier and text,
so reruns and retries agree. A document repeated more often than a block is large is dealt over blocks by its number.

Rules: words are runs of characters other than 0x20 and 0x09 to 0x0D; a null text has size 0. A null source is a source,
ordered last. Documents of size 0 are taken 0 times. Repeated rows are documents of their own, also where they differ in
other columns. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.llm.tables import free_name, row_key, stage_numbered
from moodmart.operators.joins import dimension_join
from moodmart.operators.numbering import number_sorted
from moodmart.session import stage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 4096
FAN = 64
DEFAULTS = {"weights": WEIGHTS, "most_copies": MOST_COPIES, "block_size": BLOCK, "fan": FAN}


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_name(source: Column) -> Column:
    """A source as text that is never null, in the order of code points, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(">"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """Adds weight and target to a table with one row per source (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the total; no target exceeds ``most_copies``
    times its source's size, and what that leaves is shared again among the others.
    """
    named = sizes.withColumn("_name", source_name(F.col("source")))
    places = number_sorted(named, "_name", "_place")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_place") - 1) % len(weights)).cast("int"))
    weighed = stage(dimension_join(named, places, "_name").withColumn("weight", weight).drop("_name", "_place"))
    limit = F.col("source_size") * float(most_copies)
    total = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight")
    ).first()
    level = total["size"] / total["weight"] if total["weight"] else 0.0
    full = -1
    while True:
        # The level only rises, so a source that is full stays full
        over = F.col("weight") * level > limit
        row = weighed.agg(
            F.coalesce(F.sum(over.cast("int")), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (total["size"] - row["used"]) / row["weight"]
    return weighed.withColumn("target", F.least(F.col("weight") * level, limit))


def draws(hashes: np.ndarray, level: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit hashes."""
    mixed = hashes.astype(np.int64).view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed >> np.uint64(11)).astype(float) * 2.0**-53


def pivot(sizes: np.ndarray, masses: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Masses after all pairs of a block: every one is 0 or its size, but for at most one."""
    masses = masses.copy()
    held = -1
    for place in range(masses.size):
        if held < 0:
            held = place
            continue
        a, b = masses[held], masses[place]
        a_size, b_size = sizes[held], sizes[place]
        up, down = min(a_size - a, b), min(a, b_size - b)
        if chances[place] * (up + down) < down:
            a, b = a + up, b - up
        else:
            a, b = a - down, b + down
        slack = 1e-9 * max(a_size, b_size)
        a = 0.0 if a <= slack else a_size if a >= a_size - slack else a
        b = 0.0 if b <= slack else b_size if b >= b_size - slack else b
        masses[held], masses[place] = a, b
        if 0.0 < b < b_size:
            held = place
        elif not 0.0 < a < a_size:
            held = -1
    return masses


def _round(items: DataFrame, level: int, last: bool) -> DataFrame:
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "hash", "rid"], ascending=[False, True, True], kind="stable")
        sizes, chances = rows["size"].to_numpy(float), draws(rows["hash"].to_numpy(), level)
        masses = pivot(sizes, rows["mass"].to_numpy(float), chances)
        if last:
            masses = np.where(2 * masses >= sizes, sizes, 0.0)
        return rows.assign(mass=masses)

    return items.groupBy("source_key", "block").applyInPandas(block, items.schema)


def choose(items: DataFrame, blocks: int, block_size: int, fan: int) -> DataFrame:
    """(rid, chosen) for ``items`` (source_key, rid, hash, size, mass, documents), mass being from 0 to size."""
    number = F.ceil(F.col("documents") / block_size)
    many = stage(items.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_size).select("hash", F.lit(True).alias("spread")))
    dealt = F.when(F.col("spread"), F.xxhash64("hash", "rid")).otherwise(F.col("hash"))
    open_items = (
        dimension_join(items, many, "hash", "left").withColumn("block", F.pmod(dealt, number)).drop("documents", "spread")
    )
    chosen, level = None, 0
    while True:
        last = blocks <= 1
        rounded = stage(_round(open_items, level, last))
        done = rounded if last else rounded.where((F.col("mass") == 0) | (F.col("mass") == F.col("size")))
        done = done.select("rid", (F.col("mass") > 0).alias("chosen"))
        chosen = done if chosen is None else chosen.unionByName(done)
        if last:
            return chosen
        open_items = rounded.where((F.col("mass") > 0) & (F.col("mass") < F.col("size"))).withColumn(
            "block", F.floor(F.col("block") / fan)
        )
        blocks, level = -(-blocks // fan), level + 1


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    block_size: int = BLOCK,
    fan: int = FAN,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, rid, size, source_size, target, copies, taken."""
    return _mix(stage(_sized(docs, F.monotonically_increasing_id())), weights, most_copies, block_size, fan)


def _sized(docs: DataFrame, number: Column) -> DataFrame:
    key = row_key()
    return docs.select(
        number.alias("rid"),
        "doc_id",
        "source",
        F.xxhash64(key["id"], key["text"], key["check"]).alias("hash"),
        word_count(F.col("text")).alias("size"),
        source_name(F.col("source")).alias("source_key"),
    )


def _mix(sized: DataFrame, weights: Sequence[float], most_copies: int, block_size: int, fan: int) -> DataFrame:
    by_source = sized.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    goals = stage(targets(by_source, weights, most_copies))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = stage(
        goals.select(
            "source_key", "source_size", "documents", "target",
            F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("fraction"),
        )
    )
    placed = dimension_join(sized, rates, "source_key")
    items = placed.where((F.col("fraction") > 0) & (F.col("size") > 0)).select(
        "source_key",
        "rid",
        "hash",
        "size",
        (F.col("fraction") * F.col("size")).alias("mass"),
        "documents",
    )
    largest = rates.agg(F.max("documents").alias("n")).first()["n"] or 0
    chosen = choose(items, -(-largest // block_size), block_size, fan)
    copies = F.col("whole") + F.coalesce(F.col("chosen").cast("long"), F.lit(0))
    return placed.join(chosen, "rid", "left").select(
        "doc_id",
        "source",
        "rid",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, copies).otherwise(0).cast("long").alias("copies"),
    ).withColumn("taken", F.col("size") * F.col("copies"))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``copies``, the number of times each is taken (in
    place of a column of that name, if there is one).

    Rows are stored under a number, and known by it: those equal in identifier and text may come from different sources.
    """
    name = free_name(docs, "_number")
    numbered = stage_numbered(docs, name)
    sized = stage(_sized(numbered, F.col(name)))
    taken = _mix(sized, **{**DEFAULTS, **settings}).where(F.col("copies") > 0)
    copies = stage(taken.select(F.col("rid").alias(name), "copies"))
    kept = [column for column in docs.columns if column.lower() != "copies"]
    return dimension_join(numbered.select(name, *kept), copies, name).select(*kept, "copies")
