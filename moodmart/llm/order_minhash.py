"""Order MinHash fingerprints of documents, in column expressions only.

A text's k-mers are runs of ``K`` tokens (a text of fewer tokens is taken as its characters, and one of fewer
characters is one k-mer); each is numbered by its occurrence, so
that the pairs (k-mer, occurrence) are all different. A hash of the pair deals it to one of ``BUCKETS`` buckets and
orders it there; the least ``TUPLE`` pairs of each bucket are kept, put back into the order of the text, and hashed as a
tuple. Equal tuples need equal k-mers in equal order, which is what makes the signature sensitive to edit distance
where plain MinHash only sees which k-mers there are.

A bucket with fewer pairs would hold no order. In a ``dense`` signature it takes the least ``TUPLE`` of all pairs of the
text under a hash seeded with the bucket instead, as Order MinHash does for every hash function. So every bucket of a
text that has tokens is filled, and short texts are compared by order too.

Everything happens in arrays of 64-bit numbers within a row: 33 bits of hash above 30 bits of place, so that sorting
them is sorting numbers. A text has fewer than 2^30 tokens, as Spark's strings have fewer than 2^31 bytes.

Rules: tokens are runs of at most ``RUN_CHARS`` letters and digits, the single characters of longer runs, of scripts
without spaces and from U+2E80 on, and runs of ASCII punctuation. A null text counts as empty. A text without tokens has an empty fingerprint, which is like another empty one (1) and unlike
any other (0). Only doc_id and text are read. Rows equal in both are one document in the order of documents; documents
with one identifier follow each other by the hash of their texts, those without identifier come last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmart.llm.tables import row_key
from moodmart.session import stage

K = 3
TUPLE = 2
BUCKET_BITS = 6
# Longer runs are split into characters, as are scripts written without spaces (Thai, Lao, Tibetan, Burmese, Khmer, Tai
# and Balinese below U+2E80)
RUN_CHARS = 24
_RUN = (
    r"0-9A-Za-z\x{80}-\x{DFF}\x{10A0}-\x{177F}\x{1800}-\x{194F}\x{1A00}-\x{1A1F}\x{1AB0}-\x{1AFF}\x{1B80}-\x{2E7F}"
)
TOKEN = rf"(?<![{_RUN}])[{_RUN}]{{1,{RUN_CHARS}}}+(?![{_RUN}])|[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]|[!-/:-@\[-`{{-~]++"
CHARACTER = r"[!-~\x{80}-\x{10FFFF}]"

_PLACE_BITS, _HASH_BITS = 30, 33
_PLACE = (1 << _PLACE_BITS) - 1
_HASH = (1 << _HASH_BITS) - 1
_BUCKET_SHIFT = _PLACE_BITS + _HASH_BITS - BUCKET_BITS
_CODE_BITS = 31 - BUCKET_BITS


def _packed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(hashed.bitwiseAND(F.lit(_HASH)), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACE)).cast("int")


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _least(values: Column, count: int) -> Column:
    """The ``count`` least of an array of different numbers, or all if there are fewer, without sorting it."""

    def further(held: Column, found: list[Column]) -> Column:
        if len(found) == count:
            return F.array_compact(F.array(*found))
        rest = F.filter(held, lambda x: x > found[-1]) if found else held
        return _bound(F.array_min(rest), lambda least: further(held, [*found, least]))

    return _bound(values, lambda held: further(held, []))


def with_signature(
    frame: DataFrame, text: str, name: str, k: int = K, width: int = TUPLE, dense: bool = False
) -> DataFrame:
    """Adds ``name``, the signature of ``text``: per filled bucket the bucket and its tuple's hash in one int, sorted.

    One select per step: a step that is used several times by the next stays a column and is computed once.
    """
    kept = [column for column in frame.columns]
    words, grams, size = F.col("_words"), F.col("_grams"), F.size("_grams")
    step = frame.select(*kept, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)).alias("_words"))
    characters = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHARACTER), F.lit(0))
    step = step.select(*kept, F.when(F.size(words) < k, characters).otherwise(words).alias("_words"))
    step = step.select(
        *kept,
        F.when(
            F.size(words) >= k,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]),
            ),
        )
        .when(F.size(words) > 0, F.array(F.xxhash64(words)))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_grams"),
    )
    # Equal k-mers side by side, in text order; null where all differ
    step = step.select(
        *kept,
        "_grams",
        F.when(F.size(F.array_distinct(grams)) < size, F.sort_array(F.transform(grams, lambda h, i: _packed(h, i)))).alias(
            "_sorted"
        ),
    )
    ordered = F.col("_sorted")
    step = step.select(
        *kept,
        "_grams",
        "_sorted",
        F.when(
            ordered.isNotNull(),
            F.filter(
                F.sequence(F.lit(0), size - 1),
                lambda i: (i == 0)
                | (F.shiftright(F.get(ordered, i), _PLACE_BITS) != F.shiftright(F.get(ordered, i - 1), _PLACE_BITS)),
            ),
        ).alias("_starts"),
    )
    starts = F.col("_starts")
    lengths = F.zip_with(
        starts, F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(size)), lambda a, b: b - a
    )
    step = step.select(
        *kept, "_grams", "_sorted", F.flatten(F.transform(lengths, lambda n: F.sequence(F.lit(0), n - 1))).alias("_occurrence")
    )
    step = step.select(
        *kept,
        "_grams",
        F.sort_array(
            F.when(
                ordered.isNotNull(),
                F.zip_with(
                    ordered,
                    "_occurrence",
                    lambda s, n: _packed(F.xxhash64(F.get(grams, _place(s)), n), _place(s)),
                ),
            ).otherwise(F.transform(grams, lambda h, i: _packed(F.xxhash64(h, F.lit(0)), i)))
        ).alias("_pairs"),
    )
    pairs = F.col("_pairs")
    least = F.filter(
        pairs,
        lambda x, i: (i < width)
        | (F.shiftright(F.get(pairs, i - width), _BUCKET_SHIFT) != F.shiftright(x, _BUCKET_SHIFT)),
    )
    step = step.select(
        *kept,
        "_grams",
        "_pairs",
        F.sort_array(
            F.transform(
                least, lambda x: F.shiftleft(F.shiftright(x, _BUCKET_SHIFT), _PLACE_BITS).bitwiseOR(x.bitwiseAND(F.lit(_PLACE)))
            )
        ).alias("_chosen"),
    )
    chosen = F.col("_chosen")

    def bucket(x: Column) -> Column:
        return F.shiftright(x, _PLACE_BITS)

    def code(x: Column, i: Column) -> Column:
        """At a bucket's last pair: the bucket and the hash of its k-mers in text order."""
        own = F.filter(F.slice(chosen, F.greatest(i - width + 2, F.lit(1)), width), lambda y: bucket(y) == bucket(x))
        hashed = F.xxhash64(F.transform(own, lambda y: F.get(grams, _place(y))))
        value = F.shiftleft(bucket(x), _CODE_BITS).bitwiseOR(hashed.bitwiseAND(F.lit((1 << _CODE_BITS) - 1)))
        ends = F.coalesce(bucket(F.get(chosen, i + 1)) != bucket(x), F.lit(True))
        return F.when(ends & (F.size(own) == width) if dense else ends, value.cast("int"))

    step = step.select(*kept, "_grams", "_pairs", F.array_compact(F.transform(chosen, code)).alias(name))
    if not dense:
        return step.select(*kept, name)
    buckets = F.sequence(F.lit(0), F.lit((1 << BUCKET_BITS) - 1))
    step = step.select(
        "*",
        F.when(
            size > 0, F.array_except(buckets, F.transform(name, lambda x: F.shiftright(x, _CODE_BITS)))
        ).otherwise(F.array().cast("array<int>")).alias("_sparse"),
    )

    def seeded(b: Column) -> Column:
        """The bucket and the hash of the k-mers, in text order, that are least under the bucket's own hash."""
        drawn = F.transform(F.col("_pairs"), lambda x: _packed(F.xxhash64(F.shiftright(x, _PLACE_BITS), b), _place(x)))
        places = F.sort_array(F.transform(_least(drawn, width), _place))
        hashed = F.xxhash64(F.transform(places, lambda p: F.get(grams, p)))
        value = F.shiftleft(b.cast("long"), _CODE_BITS).bitwiseOR(hashed.bitwiseAND(F.lit((1 << _CODE_BITS) - 1)))
        return value.cast("int")

    return step.select(*kept, F.sort_array(F.concat(name, F.transform("_sparse", seeded))).alias(name))


def likeness(a: str, b: str) -> Column:
    """The share of the buckets filled in either signature that agree."""

    def buckets(signature: str) -> Column:
        return F.transform(F.col(signature), lambda x: F.shiftright(x, _CODE_BITS))

    either = F.size(F.array_union(buckets(a), buckets(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.col(a), F.col(b))).cast("double") / either
    )


def written(signature: str) -> Column:
    """A signature as text: eight hexadecimal digits per filled bucket."""
    return F.array_join(F.transform(F.col(signature), lambda x: F.lpad(F.hex(x), 8, "0")), "")


def successors(docs: DataFrame) -> DataFrame:
    """Per different (doc_id, text): key, doc_id, n_chars and the key of the next one by doc_id; the last's is the first.

    Only keys move. They are dealt out by ranges; the last of a range is followed by the first of the next one.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("key.text").asc(), F.col("key.check").asc()]
    keys = docs.select("doc_id", row_key().alias("key"), F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"))
    dealt = stage(keys.distinct().repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    # One row per range
    heads = dealt.groupBy("range").agg(
        F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key.text", "key.check")).alias("head")
    )
    ranges = Window.orderBy("range")
    first = F.first("head").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = heads.select("range", F.coalesce(F.lead("head").over(ranges), first).alias("head"))
    inside = F.lead("key").over(Window.partitionBy("range").orderBy(*order))
    return stage(
        dealt.withColumn("inside", inside)
        .join(F.broadcast(following), "range")
        .select("key", "doc_id", "n_chars", F.coalesce("inside", "head").alias("next"))
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Per row: key, next, doc_id, n_chars, text and edited, its text with the last quarter replaced by the next's head."""
    follow = successors(docs)
    texts = docs.select(row_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    heads = (
        texts.withColumnRenamed("key", "next")
        .join(follow, "next")
        .select("key", "next", "doc_id", "n_chars", F.expr("substring(text, 1, cast(floor(n_chars / 4) as int))").alias("head"))
        .dropDuplicates(["key"])
    )
    return texts.join(heads, "key").select(
        "key",
        "next",
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "text",
        F.concat(F.substring("text", F.lit(1), F.col("n_chars") - quarter), "head").alias("edited"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    pairs = edited_pairs(docs).withColumn("edited_sha256", F.sha2("edited", 256))
    signed = with_signature(
        with_signature(pairs, "text", "signature", dense=True), "edited", "edited_signature", dense=True
    ).drop("text", "edited")
    signed = stage(signed)
    following = signed.select(F.col("key").alias("next"), F.col("signature").alias("next_signature")).dropDuplicates(["next"])
    return signed.join(following, "next").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written("signature").alias("fingerprint"),
        written("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"),
    )
