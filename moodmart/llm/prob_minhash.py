"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A document is a weighted set: its shingles of ``shingle`` words, each with the weight 1 + ln(times it occurs), so that a
phrase repeated all over does not outweigh the rest (a document of fewer words is one shingle of all its words). For every shingle a Poisson process with the shingle's weight as its rate
is drawn from a generator seeded with the shingle's hash; each arrival falls on a random component of the signature,
and a component keeps the shingle that arrives first. A document's processes stop as soon as their next arrival is later
than every component's. Two signatures agree in a component with the probability Jaccard similarity of the two sets.

Signatures are cut into bands; documents with an equal band share a bucket. In a bucket the document with most company
leads and is paired with the others; pairs are verified with the exact similarity of their whole weighted sets. Whoever
is not yet in its leader's class leads in a later round, against the members of other classes, until no such document is
left: so no pair of a bucket goes unexamined unless its two documents are already in one class.

Pairs that cannot reach the threshold are not made. Each set has a sketch of ``SKETCH_WORDS`` x 64 bits, the parity of
its shingles per bit, so two sketches differ in at most as many bits as the sets differ in shingles. This bounds the
similarity from above, and the bound is a condition of the join that makes the pairs. It never takes a pair away that
reaches the threshold.

Rules: equal texts are one node, so copies are never compared or paired. A null text counts as empty; texts without
words are in a class only with their exact copies. Repeated rows stay rows of the result. Class identifiers are the
least doc_id of the class; documents without an identifier are classed like others. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.llm.components import components
from moodmart.llm.tables import free_name, row_key, stage_numbered
from moodmart.llm.texts import Words, mix, pieces, shingles, whole_shingles
from moodmart.operators.joins import dimension_join
from moodmart.operators.merge import dedup_latest
from moodmart.session import stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 25
ROWS_PER_BAND = 5
SKETCH_WORDS = 8
# Leaders per bucket in each round: one, then so many times more
MORE_LEADERS = 256
# Rounding must not lose a pair on the threshold
SLACK = 1e-9

SKETCH = tuple(f"s{place}" for place in range(SKETCH_WORDS))

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def weighted_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and weight of every different shingle of a run of texts, ordered by row and hash."""
    words = Words(data, offsets)
    hashes = words.hashes()
    place, value = shingles(words, hashes, size)
    short_place, short_value = whole_shingles(words, hashes, size)
    row = np.concatenate([words.row[place], words.row[short_place]]).astype(np.int64)
    value = np.concatenate([value, short_value])
    if not value.size:
        return row, value, np.zeros(0)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(value.size, bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    begin = np.flatnonzero(new)
    return row[begin], value[begin], 1 + np.log(np.diff(np.append(begin, value.size)))


def signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """ProbMinHash signatures of ``size`` components; zero where a row has no shingle."""
    first = np.full(rows * size, np.inf)
    winner = np.zeros(rows * size, np.uint64)
    time = np.zeros(value.size)
    drawn = np.zeros(value.size, np.uint64)
    row_, value_, rate = row, value, weight
    while row_.size:
        block = int(min(64, max(1, 20_000 // row_.size)))
        steps = drawn[:, None] + np.arange(1, block + 1, dtype=np.uint64)
        bits = mix(value_[:, None] + steps * _GOLDEN)
        gaps = -np.log(((bits >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / rate[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        slots = row_[:, None] * size + (mix(bits ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(size)).astype(np.int64)
        early = times < first[slots]
        slot, at = slots[early], times[early]
        who = np.broadcast_to(value_[:, None], times.shape)[early]
        np.minimum.at(first, slot, at)
        won = first[slot] == at
        winner[slot[won]] = who[won]
        time, drawn = times[:, -1], drawn + np.uint64(block)
        going = time < first.reshape(rows, size).max(axis=1)[row_]
        row_, value_, rate, time, drawn = row_[going], value_[going], rate[going], time[going], drawn[going]
    return winner.reshape(rows, size)


def probability_jaccard(a: np.ndarray, a_weight: np.ndarray, b: np.ndarray, b_weight: np.ndarray) -> float:
    """Sum over shared elements d of 1 / sum over all e of max(a_e / a_d, b_e / b_d), for sorted a and b."""
    both = np.union1d(a, b)
    x, y = np.zeros(both.size), np.zeros(both.size)
    x[np.searchsorted(both, a)] = a_weight
    y[np.searchsorted(both, b)] = b_weight
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # x_e / x_d is the larger of the two just where e's ratio is at least d's
    from_here = np.searchsorted(ratio, ratio, side="left")
    above = np.append(np.cumsum(x[::-1])[::-1], 0.0)[from_here]
    below = np.concatenate([[0.0], np.cumsum(y)])[from_here]
    shared = (x > 0) & (y > 0)
    return float(np.sum(1.0 / (above[shared] / x[shared] + below[shared] / y[shared])))


def _signed(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.drop_columns(["text"])
            for first, last, data, offsets in pieces(batch.column("text")):
                row, value, weight = weighted_sets(data, offsets, shingle)
                count = last - first
                signature = signatures(row, value, weight, count, bands * rows).reshape(count, bands, rows)
                band = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (count, bands)).copy()
                for place in range(rows):
                    band = mix(band * _GOLDEN + signature[:, :, place])
                sizes = np.bincount(row, minlength=count)
                total = np.bincount(row, weights=weight, minlength=count)
                bits = 64 * SKETCH_WORDS
                parity = np.bincount(row * bits + (value % np.uint64(bits)).astype(np.int64), minlength=count * bits) & 1
                sketch = np.packbits(parity.astype(bool).reshape(count, bits), axis=1).view(np.int64)
                filled = sizes > 0
                ends = np.concatenate([[0], np.cumsum(np.where(filled, bands, 0))]).astype(np.int32)
                values = pa.array(band[filled].reshape(-1).view(np.int64))
                part = kept.slice(first, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.ListArray.from_arrays(pa.array(ends), values),
                        pa.array(total),
                        pa.array(total == sizes),
                        *(pa.array(np.ascontiguousarray(sketch[:, place])) for place in range(SKETCH_WORDS)),
                    ],
                    names=[*part.schema.names, "bands", "total", "plain", *SKETCH],
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    # total: the sum of weights; plain: whether no shingle is repeated
    words = "".join(f", {name} bigint" for name in SKETCH)
    return docs.mapInArrow(scan, f"{schema}, bands array<bigint>, total double, plain boolean{words}")


def within_reach(a: str, b: str, threshold: float) -> Column:
    """Whether two documents, structs with total, plain and a sketch, can reach the threshold.

    Without repeated shingles the similarity is Jaccard's, at most (n - d) / (n + d) for sets of n shingles in all that
    differ in d. In general a share p of a document's weight that the other lacks, put as q = p / (1 - p), allows no more
    than 1 / (1 + q + q'); every such shingle weighs at least 1, so with the larger total for both, n is twice that.
    """
    apart = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH[1:]), F.bit_count(
        F.col(f"{a}.{SKETCH[0]}").bitwiseXOR(F.col(f"{b}.{SKETCH[0]}"))
    ))
    totals = [F.col(f"{name}.total") for name in (a, b)]
    plain = F.col(f"{a}.plain") & F.col(f"{b}.plain")
    both = F.when(plain, totals[0] + totals[1]).otherwise(2 * F.greatest(*totals))
    return both - apart >= F.lit(threshold - SLACK) * (both + apart)


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """The weighted set of each given document: rid, sorted hashes, weights."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column("text")):
                row, value, weight = weighted_sets(data, offsets, shingle)
                ends = pa.array(np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rid").slice(first, last - first),
                        pa.ListArray.from_arrays(ends, pa.array(value.view(np.int64))),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                    ],
                    names=["rid", "hashes", "weights"],
                )

    return docs.select("rid", "text").mapInArrow(scan, "rid bigint, hashes array<bigint>, weights array<double>")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that reach the threshold, with their similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name) for name in ("ah", "aw", "bh", "bw")}
            values = [
                probability_jaccard(
                    columns["ah"][i].values.to_numpy().view(np.uint64),
                    columns["aw"][i].values.to_numpy(),
                    columns["bh"][i].values.to_numpy().view(np.uint64),
                    columns["bw"][i].values.to_numpy(),
                )
                for i in range(batch.num_rows)
            ]
            keep = np.flatnonzero(np.array(values) >= threshold - SLACK)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(keep), batch.column("b").take(keep), pa.array(np.array(values)[keep])],
                names=["a", "b", "similarity"],
            )

    left = sets.select(F.col("rid").alias("a"), F.col("hashes").alias("ah"), F.col("weights").alias("aw"))
    right = sets.select(F.col("rid").alias("b"), F.col("hashes").alias("bh"), F.col("weights").alias("bw"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a bigint, b bigint, similarity double")


def _pairs(members: DataFrame, leaders: DataFrame, met: Column) -> DataFrame:
    """Different pairs (a, b) of a leader and a member of its bucket that meet a condition; it is part of the join."""
    shared = members["bucket"] == leaders["bucket"]
    return (
        members.join(leaders, shared & met)
        .select(F.least("a", "rid").alias("a"), F.greatest("a", "rid").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    threshold: float = SIMILARITY,
    shingle: int = SHINGLE_WORDS,
    bands: int = BANDS,
    rows: int = ROWS_PER_BAND,
) -> tuple[DataFrame, DataFrame]:
    """Classes of ``docs`` (doc_id, text).

    Returns a row per document (rid, doc_id, key, class_id, class_size, first), where ``first`` marks the one document
    of each class that stays, and the verified links (a, b, similarity) between different texts, by rid.
    """
    keyed = docs.select("doc_id", row_key().alias("key"), "text")
    flat = keyed.select(
        "doc_id",
        F.col("key.id").alias("key_id"),
        F.col("key.text").alias("key_text"),
        F.col("key.check").alias("key_check"),
        "text",
    )
    signed = stage_numbered(_signed(flat, shingle, bands, rows))
    # One node per different text
    one = ("bands", "total", "plain", *SKETCH)
    nodes = stage(
        signed.groupBy("key_text", "key_check").agg(
            F.min(F.struct("rid", "key_id")).alias("least"), *[F.first(name).alias(name) for name in one]
        )
    )
    member = nodes.select(F.col("least.rid").alias("rid"), F.explode("bands").alias("bucket"))
    crowded = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    company = stage(member.join(crowded, "bucket"))
    known = nodes.select(F.col("least.rid").alias("rid"), F.struct("total", "plain", *SKETCH).alias("sketch")).join(
        company.groupBy("rid").agg(F.sum("n").alias("company")), "rid"
    )
    buckets = stage(company.select("bucket", "rid").join(known, "rid"))
    candidates = stage(
        nodes.select(
            F.col("least.rid").alias("rid"),
            F.struct(
                F.col("least.key_id").alias("id"), F.col("key_text").alias("text"), F.col("key_check").alias("check")
            ).alias("key"),
        ).join(buckets.select("rid").distinct(), "rid")
    )
    compared = dimension_join(keyed.select("key", "text"), candidates, "key")
    sets = stage(_sets(compared, shingle).dropDuplicates(["rid"]))

    lead = ("company", "rid", "sketch")
    leaders = buckets.groupBy("bucket").agg(F.max(F.struct(*lead)).alias("lead"))
    leaders = stage(leaders.select("bucket", F.col("lead.rid").alias("a"), F.col("lead.sketch").alias("a_sketch")))
    met = (F.col("rid") != F.col("a")) & within_reach("sketch", "a_sketch", threshold)
    checked = stage(_pairs(buckets, leaders, met))
    links = stage(_verified(checked, sets, threshold))
    roots = stage(components(links))
    tried = leaders.select("bucket", F.col("a").alias("rid"))
    # The classes of the first round stand for all later ones: older classes only mean more pairs, and the links found on
    # the way are joined up once, at the end
    placed = buckets.join(roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn(
        "root", F.coalesce("root", "rid")
    )
    main = placed.groupBy("bucket").agg(F.max(F.struct("company", "rid", "root")).alias("main"))
    placed = stage(placed.join(main.select("bucket", "main.root").withColumnRenamed("root", "main"), "bucket"))
    first_links = links
    slots = 1
    while True:
        apart = placed.where(F.col("root") != F.col("main")).join(tried, ["bucket", "rid"], "left_anti")
        chosen = stage(
            apart.groupBy("bucket", F.pmod(F.xxhash64("rid"), F.lit(slots)).alias("slot"))
            .agg(F.max(F.struct(*lead, "root")).alias("lead"))
            .select(
                "bucket",
                F.col("lead.rid").alias("a"),
                F.col("lead.sketch").alias("a_sketch"),
                F.col("lead.root").alias("a_root"),
            )
        )
        if chosen.isEmpty():
            break
        met = (F.col("root") != F.col("a_root")) & within_reach("sketch", "a_sketch", threshold)
        pairs = stage(_pairs(placed, chosen, met).join(checked, ["a", "b"], "left_anti"))
        tried = tried.unionByName(chosen.select("bucket", F.col("a").alias("rid")))
        slots *= MORE_LEADERS
        if pairs.isEmpty():
            continue
        checked = checked.unionByName(pairs)
        found = stage(_verified(pairs, sets, threshold))
        if not found.isEmpty():
            links = links.unionByName(found)
    if links is not first_links:
        roots = stage(components(links))

    placed = nodes.select("key_text", "key_check", F.col("least.rid").alias("node")).join(roots, "node", "left")
    classes = placed.select("key_text", "key_check", F.coalesce("root", "node").alias("class"))
    classed = stage(
        signed.select("rid", "doc_id", "key_id", "key_text", "key_check").join(classes, ["key_text", "key_check"])
    )
    summary = classed.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid")).alias("stays"),
    )
    result = dimension_join(classed, stage(summary), "class").select(
        "rid",
        "doc_id",
        F.struct(F.col("key_id").alias("id"), F.col("key_text").alias("text"), F.col("key_check").alias("check")).alias(
            "key"
        ),
        "class_id",
        "class_size",
        (F.col("rid") == F.col("stays.rid")).alias("first"),
    )
    return result, links


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns. Of rows equal in identifier and text one stays, the same in
    every run: the one whose columns together have the least hash."""
    name = free_name(docs, "_row_key")
    result, _ = near_duplicates(docs)
    stay = stage(result.where("first").select(F.col("key").alias(name)))
    kept = docs.withColumn(name, row_key())
    twice = stage(result.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(F.col("key").alias(name)))
    single = dimension_join(dimension_join(kept, stay, name), twice, name, "left_anti")
    repeated = dimension_join(dimension_join(kept, stay, name), twice, name)
    one = dedup_latest(repeated, name, [F.xxhash64(*docs.columns)])
    return single.unionByName(one).select(*docs.columns)
