"""Polarity and subjectivity of texts, from a lexicon of weighted words.

A score is the mean weight of the lexicon words in a text, counted as often as they occur; no hit scores zero. Weights
are whole hundredths, so sums are exact and do not depend on the order rows arrive in.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.functions.labels import polarity_class, subjectivity_class
from moodmart import fixed_values as V
from moodmart.operators.joins import ROWS_PER_TASK, Size, dimension_join, fits_broadcast, measure, salted_join
from moodmart.session import stage

# Largest lexicon that is put into the tasks as a lookup table; larger ones are joined
LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 8 * 1024 * 1024
_FEWEST_BUCKETS, _MOST_BUCKETS = 1 << 6, 1 << 17


def words(text: Column) -> Column:
    """Lower-case runs of letters; the ends may be empty, which no lexicon word is."""
    # a-z are letters too; named first, most characters are told by a range and not by their Unicode category
    return F.split(F.lower(text), r"[^a-z\p{L}]+")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.hash(word), F.lit(buckets))


def _unique(lexicon: DataFrame) -> DataFrame:
    """Weights per word. A word listed twice or with a weight that is missing or out of range is an error, raised while
    the lexicon is used, whichever way that is."""

    def known(weight: str, least: int) -> Column:
        fits = F.max(weight).between(least, 100)
        return (
            F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("listed twice in the lexicon: "), F.col("word"))))
            .when(fits, F.max(weight))
            .otherwise(F.raise_error(F.concat(F.lit("no weight in range in the lexicon: "), F.col("word"))))
            .cast("long")
        )

    return (
        lexicon.where(F.length("word") > 0)
        .groupBy("word")
        .agg(
            known("polarity_h", -100).alias("p"),
            known("subjectivity_h", 0).alias("s"),
        )
    )


def lookup_table(lexicon: DataFrame, buckets: int) -> DataFrame:
    """One row with the lexicon as an array of small maps, word to weights; the word's hash says which one it is in.

    A single map would be searched from its start for every word. Buckets without words are null.
    """
    entry = F.struct("word", F.struct("p", "s").alias("weights")).alias("entry")
    words_in = _unique(lexicon.coalesce(1)).select(_bucket(F.col("word"), buckets).alias("bucket"), entry)
    no_entry = F.lit(None).cast(words_in.schema["entry"].dataType).alias("entry")
    every = lexicon.sparkSession.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket"), no_entry)
    # bounded by LOOKUP_ROWS; in one partition the groupings need no shuffle
    filled = words_in.unionByName(every).coalesce(1).groupBy("bucket").agg(F.collect_list("entry").alias("entries"))
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "entries")))
    return filled.agg(
        F.transform(in_order, lambda slot: F.when(F.size(slot.entries) > 0, F.map_from_entries(slot.entries)))
    )


def _score(total: Column, hits: Column) -> Column:
    return F.when(hits > 0, total / hits / 100).otherwise(F.lit(0.0))


def _score_by_lookup(rows: DataFrame, text: str, lexicon: DataFrame, size: int) -> DataFrame:
    """Every row scores its own text: no shuffle, no join back, nothing moves but the lexicon."""
    kept = [F.col(name) for name in rows.columns]
    # eight times the words, so that most words of a text meet an empty bucket and are done
    buckets = min(max(1 << (8 * size).bit_length(), _FEWEST_BUCKETS), _MOST_BUCKETS)

    def weights(word: Column) -> Column:
        return F.try_element_at(F.get(F.col("_lookup"), _bucket(word, buckets)), word)

    found = F.filter(F.transform(words(F.col(text)), weights), lambda weight: weight.isNotNull())
    step = rows.select(*kept, lookup_table(lexicon, buckets).scalar().alias("_lookup")).select(*kept, found.alias("_found"))

    def total(weight: str) -> Column:
        return F.aggregate("_found", F.lit(0).cast("long"), lambda so_far, hit: so_far + hit[weight])

    return step.select(
        *kept,
        _score(total("p"), F.size("_found")).alias("sentiment_score"),
        _score(total("s"), F.size("_found")).alias("subjectivity_score"),
    )


def _score_by_join(rows: DataFrame, text: str, lexicon: DataFrame, rows_per_task: int) -> DataFrame:
    """For a lexicon too large to look words up in: join the words of the texts with it, sum the weights per text.

    Texts are told apart by hash, so no row key is needed. Copies of a text add to the same sums, which leaves the mean as
    it is. Words meet a lexicon that is measured to fit where they are, and only sums per text move. Otherwise word counts
    per text and the lexicon are shuffled. The scores of the different texts then go to the texts, which stay where they
    are unless those scores are measured to be too many to broadcast. Joins that shuffle are salted: common words and
    copied texts are hot keys.
    """
    hashed = rows.withColumn("_text", F.unhex(F.sha2(F.col(text), 256)))
    found = hashed.select("_text", F.explode(words(F.col(text))).alias("word")).where(F.length("word") > 0)
    known = stage(_unique(lexicon))
    if fits_broadcast(known):
        hits = found.join(F.broadcast(known), "word").withColumn("n", F.lit(1))
    else:
        # written, because the join reads it twice: to find the hot words, and to join
        counts = stage(found.groupBy("_text", "word").agg(F.count(F.lit(1)).alias("n")))
        hits = salted_join(counts, known, "word", "inner", rows_per_task)
    sums = stage(
        hits.groupBy("_text").agg(
            F.sum(F.col("p") * F.col("n")).alias("_p"),
            F.sum(F.col("s") * F.col("n")).alias("_s"),
            F.sum("n").alias("_n"),
        )
    )
    joined = dimension_join(hashed, sums, "_text", "left", rows_per_task=rows_per_task)
    return joined.select(
        *rows.columns,
        _score(F.col("_p"), F.col("_n")).alias("sentiment_score"),
        _score(F.col("_s"), F.col("_n")).alias("subjectivity_score"),
    )


def score_texts(
    rows: DataFrame,
    text: str,
    lexicon: DataFrame,
    max_rows: int = LOOKUP_ROWS,
    max_bytes: int = LOOKUP_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    size: Size | None = None,
) -> DataFrame:
    """Add ``sentiment_score`` (-1 to 1) and ``subjectivity_score`` (0 to 1) of a text column.

    Pass the lexicon's ``size`` where several texts are scored with it, so that it is measured once.
    """
    size = measure(lexicon) if size is None else size
    if size.fits(max_rows, max_bytes):
        return _score_by_lookup(rows, text, lexicon, size.rows)
    return _score_by_join(rows, text, lexicon, rows_per_task)


def label_scores(scored: DataFrame, band: float = V.NEUTRAL_BAND) -> DataFrame:
    """Add the classes of both scores, ``sentiment_label`` and ``is_subjective``."""
    return scored.withColumns(
        {
            "sentiment_label": polarity_class(F.col("sentiment_score"), band),
            "is_subjective": subjectivity_class(F.col("subjectivity_score")),
        }
    )
