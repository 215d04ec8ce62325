"""Licence scanning: TF-IDF cosine of lines to licence templates, and inheritance along directories.

Every line of a file is a sparse vector of its words (A-Z lower-cased), weighted by how often a word is in the line and
by ln((N + 1) / (df + 1)) + 1, with N and df counted over all lines of all files; a word that no template has counts as
never seen (df 0), which only lowers a line's likeness. A file's own licence is the template with the highest cosine to any
of its lines, if that reaches ``THRESHOLD``.

A line that reaches it must hold one of a template's heavy words: those left after taking away, lightest first, words
whose squared weights sum to less than the threshold's square. Only lines with such a word are turned into vectors.

A file without a licence of its own inherits from the nearest directory above it that has a licence file: a path is
turned into its ancestor directories, which are joined with the directories' licences, and the deepest wins. Of several
licence files in a directory the most alike counts, then the least name, then the least path.

Rules: a null text has no lines to match. A file without a path has no directory. Repeated rows are files of their own.
Paths are split at /; only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmart.llm.line_dedup import ascii_lower, lines_of
from moodmart.llm.tables import row_key, stage_numbered
from moodmart.operators.joins import dimension_join
from moodmart.session import stage

THRESHOLD = 0.8
# Words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z is lower-cased; these are the runs between them, and a line
# that has a word before that
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HAS_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# The usual notices
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def words_of(text: Column) -> Column:
    # Cutting between words is several times faster than extracting them; only the ends can be empty
    return F.array_remove(F.split(ascii_lower(text), _BETWEEN, -1), "")


def heavy_words(weights: dict[str, float], threshold: float) -> set[str]:
    """Words of which a line needs at least one to reach the threshold with a template of these weights."""
    norm = math.fsum(w * w for w in weights.values())
    spent, heavy = 0.0, set(weights)
    for word in sorted(weights, key=lambda word: (weights[word], word)):
        spent += weights[word] ** 2 / norm
        # Rounding must not lose a line on the threshold
        if spent >= threshold * threshold - 1e-9:
            break
        heavy.discard(word)
    return heavy


def lines_with_words(files: DataFrame) -> DataFrame:
    """(key, position, words) of all lines of files (key, text) that have a word."""
    lines = files.select("key", F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    # A filter on the words themselves would be pushed below them and cut every line twice
    return lines.where(F.col("line").rlike(_HAS_WORD)).select("key", "position", words_of(F.col("line")).alias("words"))


def own_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, cosine) of the files (key, text) that have a licence of their own.

    The key stands for the text. Copies multiply all words of a line alike, which leaves its cosine as it is.
    """
    spark = files.sparkSession
    lines = lines_with_words(files)
    rows = spark.createDataFrame(list(templates), "license string, text string")
    terms = rows.select("license", F.explode(words_of(F.col("text"))).alias("word")).groupBy("license", "word").count()
    # As many rows as the templates have words
    listed = [(row["license"], row["word"], row["count"]) for row in terms.collect()]
    vocabulary = F.array(*[F.lit(word) for word in sorted({word for _, word, _ in listed})])
    counts = lines.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect("words", vocabulary))).alias("word"))
    frequency = {row["word"]: row["count"] for row in counts.groupBy("word").count().collect()}
    total = frequency.pop("", 0)

    def rarity(word: str) -> float:
        return math.log((total + 1) / (frequency.get(word, 0) + 1)) + 1

    vectors: dict[str, dict[str, float]] = {}
    for license, word, count in listed:
        vectors.setdefault(license, {})[word] = count * rarity(word)
    heavy = sorted(set().union(*(heavy_words(vector, threshold) for vector in vectors.values())))
    weighed = spark.createDataFrame(
        [
            (license, word, weight / math.sqrt(math.fsum(w * w for w in vector.values())))
            for license, vector in sorted(vectors.items())
            for word, weight in sorted(vector.items())
        ],
        "license string, word string, weight double",
    )
    rarities = spark.createDataFrame([(word, rarity(word)) for word in sorted({w for _, w, _ in listed})], "word string, rarity double")
    likely = lines.where(F.arrays_overlap("words", F.array(*[F.lit(word) for word in heavy])))
    # The templates' words are as many as above, so their tables are broadcast
    parts = stage(
        likely.select("key", "position", F.explode("words").alias("word"))
        .groupBy("key", "position", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(F.broadcast(rarities), "word", "left")
        .select("key", "position", "word", (F.col("n") * F.coalesce("rarity", F.lit(math.log(total + 1) + 1))).alias("part"))
    )
    norms = parts.groupBy("key", "position").agg(F.sqrt(F.sum(F.col("part") * F.col("part"))).alias("norm"))
    dots = (
        parts.join(F.broadcast(weighed), "word")
        .groupBy("key", "position", "license")
        .agg(F.sum(F.col("part") * F.col("weight")).alias("dot"))
    )
    return (
        dots.join(norms, ["key", "position"])
        .select("key", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
        .where(F.col("cosine") >= threshold)
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("best"))
        .select("key", "best.license", (-F.col("best.less")).alias("cosine"))
    )


def directory_of(path: Column) -> Column:
    """The path without its last part; the root is the empty string."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def ancestors_of(directory: Column) -> Column:
    """The directory and all above it, as (depth, directory); the root has depth 0."""
    parts = F.split(directory, "/")
    depth = F.when(directory == "", F.lit(0)).otherwise(F.size(parts))
    return F.transform(
        F.sequence(F.lit(0), depth),
        lambda d: F.struct(
            d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("directory")
        ),
    )


def scan(files: DataFrame, license_file: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (doc_id, path, text); ``license_file`` says whose licence stands for its directory.

    Returns a row per file: doc_id, path, license, cosine, found ('own', 'inherited' or 'none') and from_directory.
    """
    keyed = files.select("doc_id", "path", "text", license_file.alias("stands"), row_key().alias("key")).withColumn(
        "key", F.struct("key.text", "key.check")
    )
    own = stage(own_licenses(keyed, templates, threshold))
    placed = stage_numbered(
        dimension_join(keyed.drop("text"), own, "key", "left").select(
            "doc_id", "path", "license", "cosine", "stands", directory_of(F.col("path")).alias("directory")
        )
    )
    best = F.min(F.struct((-F.col("cosine")).alias("less"), "license", "path"))
    directories = stage(
        placed.where(F.col("license").isNotNull() & F.col("stands") & F.col("directory").isNotNull())
        .groupBy("directory")
        .agg(best.alias("best"))
        .select("directory", F.col("best.license").alias("inherited"))
    )
    above = placed.where(F.col("license").isNull() & F.col("directory").isNotNull()).select(
        "rid", F.inline(ancestors_of(F.col("directory")))
    )
    nearest = (
        dimension_join(above, directories, "directory")
        .groupBy("rid")
        .agg(F.max(F.struct("depth", "directory", "inherited")).alias("nearest"))
    )
    return placed.join(nearest, "rid", "left").select(
        "doc_id",
        "path",
        F.coalesce("license", "nearest.inherited").alias("license"),
        "cosine",
        F.when(F.col("license").isNotNull(), "own")
        .when(F.col("nearest").isNotNull(), "inherited")
        .otherwise("none")
        .alias("found"),
        F.when(F.col("license").isNull(), F.col("nearest.directory")).alias("from_directory"),
    )
