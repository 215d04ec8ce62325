"""Alignment of the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes, a space and the text. Tokens that overlap belong together, and so do chains of such
tokens: a group is a component of the overlaps, and ends where a token of either tokenizer ends at one byte. Every token
points to the token of the other tokenizer that overlaps it and reaches farthest right; the last token of a group points
to itself. Replacing every pointer by its target's pointer doubles the length of the jumps, so after a logarithmic
number of rounds, each a step over whole arrays, every token points to the last token of its group, which names it.

A pair of token ids is linked in a document if both occur in one group of it. A pair's count is the number of documents
that hold it linked. Documents are encoded once and their pairs stored; counts are combined before the shuffle. They are
looked up in tables that the tasks hold, of the ``known_pairs`` most frequent pairs at most; the others are joined, and
as these occur in few documents each, no key of that join is large.

Rules: a null or empty text has no tokens, and neither has one that either tokenizer does not give back byte by byte (a
text that holds U+2581, for example). Special tokens are not recognised: their strings are plain text. Texts of any
length are encoded whole. Repeated rows are documents of their own. Only doc_id and text are read; an empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodmart.llm.texts import pieces
from moodmart.session import stage

#: How the byte-level vocabulary cuts text before it merges bytes (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pairs whose counts every task may hold: about 100 MB as a hashed table
KNOWN_PAIRS = 1 << 21
# A longer run of white space is too deep for the faster library's pattern
LONG_BLANK = re.compile(r"\s{100000}")
# Groups of more links than this are handled by their different ids, not link by link
LISTED_LINKS = 4096


@dataclass(frozen=True)
class Vocabularies:
    """The bytes of every token of both tokenizers, by id, and the files: bounded by the size of these."""

    a: list[bytes]
    b: list[bytes]
    vocabulary: str
    model: bytes

    @property
    def pairs(self) -> int:
        return len(self.a) * len(self.b)


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level entries write bytes with: printable bytes as themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + place): byte for place, byte in enumerate(others)}


def read_vocabularies(byte_level: str, piece_model: str) -> Vocabularies:
    """Read a byte-level vocabulary (JSON) and a piece model; the driver reads them, so only its paths count."""
    from sentencepiece import SentencePieceProcessor

    alphabet = byte_alphabet()
    vocabulary = Path(byte_level).read_text(encoding="utf-8")
    entries = json.loads(vocabulary)["model"]["vocab"]
    a = [b""] * (max(entries.values()) + 1)
    for entry, number in entries.items():
        a[number] = bytes(alphabet[character] for character in entry)
    model = Path(piece_model).read_bytes()
    processor = SentencePieceProcessor(model_proto=model)
    b = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        b.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(number) else piece.replace("▁", " ").encode())
    return Vocabularies(a, b, vocabulary, model)


class Encoders:
    """Both tokenizers, as a task loads them.

    The byte-level entries are merged in the order of their ids, which is the order of the vocabulary's merges. Two
    libraries give the same ids; the slower one is for texts that the faster one cannot cut.
    """

    def __init__(self, vocabularies: Vocabularies):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        self._a, self._b, self._vocabulary = vocabularies.a, vocabularies.b, vocabularies.vocabulary
        ranks = {entry: number for number, entry in enumerate(vocabularies.a) if entry}
        self._bytes = Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._pieces = SentencePieceProcessor(model_proto=vocabularies.model)

    def _encode_slowly(self, text: str) -> list[int]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self._vocabulary)
        tokenizer.encode_special_tokens = True
        return tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both tokenizers over a space and the text, or None if either loses a byte."""
        whole = f" {text}"
        a = self._encode_slowly(whole) if LONG_BLANK.search(whole) else self._bytes.encode_ordinary(whole)
        b = self._pieces.encode(text)
        data = whole.encode()
        if b"".join(map(self._b.__getitem__, b)) != data or b"".join(map(self._a.__getitem__, a)) != data:
            return None
        return a, b


def jump(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """For all tokens of A, then all of B, the number of the B token that ends their group.

    Both cut the same range of bytes without gaps, so the last token that begins before another's end overlaps it and
    ends no earlier.
    """
    size = start_a.size
    to_b = size + np.searchsorted(start_b, end_a) - 1
    to_a = np.searchsorted(start_a, end_b) - 1
    own = size + np.arange(start_b.size)
    successor = np.concatenate([to_b, np.where(end_a[to_a] > end_b, to_a, own)]).astype(np.int64)
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor - size
        successor = further


class Groups:
    """The groups of a run of encoded texts; tokens of all texts stand one after another."""

    def __init__(self, encoded: list[tuple[list[int], list[int]]], length_a: np.ndarray, length_b: np.ndarray):
        self.a, self.b = (
            np.fromiter(chain.from_iterable(pair[side] for pair in encoded), np.int64) for side in (0, 1)
        )
        self.texts = len(encoded)
        end_a, end_b = np.cumsum(length_a[self.a]), np.cumsum(length_b[self.b])
        last = jump(end_a - length_a[self.a], end_a, end_b - length_b[self.b], end_b)
        is_end = np.zeros(self.b.size, bool)
        is_end[last] = True
        ends = np.flatnonzero(is_end)
        group = (np.cumsum(is_end) - 1)[last]
        self.count = ends.size
        self.group_a, self.group_b = group[: self.a.size], group[self.a.size :]
        self.n_a, self.n_b = (np.bincount(g, minlength=self.count) for g in (self.group_a, self.group_b))
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        sizes = np.array([len(pair[1]) for pair in encoded], np.int64)
        self.row = np.repeat(np.arange(self.texts), sizes)[ends]
        self.links = self.n_a * self.n_b

    def written(self, parts: list[str], size_a: int, size_b: int) -> list[str]:
        """Per text, ``a1,a2|b1;a3|b2``; ``parts`` are all ids with the sign that may follow them (``id_parts``)."""
        last_a, last_b = (np.zeros(ids.size, bool) for ids in (self.a, self.b))
        last_a[self.first_a[1:] - 1] = last_b[self.first_b[1:] - 1] = True
        codes = np.empty(self.a.size + self.b.size, np.int64)
        codes[np.arange(self.a.size) + self.first_b[self.group_a]] = self.a + size_a * last_a
        codes[np.arange(self.b.size) + self.first_a[self.group_b + 1]] = self.b + 2 * size_a + size_b * last_b
        places = self._by_text(self.n_a + self.n_b)
        listed = list(map(parts.__getitem__, codes.tolist()))
        return ["".join(listed[low:high])[:-1] for low, high in zip(places[:-1], places[1:])]

    def _by_text(self, values: np.ndarray) -> list[int]:
        """Running totals of a number per group, at the limits of the texts."""
        totals = np.zeros(self.texts + 1, np.int64)
        np.add.at(totals, self.row + 1, values)
        return np.cumsum(totals).tolist()

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.diff(self._by_text(values))

    def pairs(self, size_b: int, pairs: int, listed: int = LISTED_LINKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair (id of A times ``size_b`` plus id of B) and number of links, each pair once per text, in order."""
        some = np.flatnonzero(self.links <= listed)
        links, wide = self.links[some], self.n_b[some]
        group = np.repeat(np.arange(some.size), links)
        within = np.arange(group.size) - np.repeat(np.cumsum(links) - links, links)
        left = self.a[self.first_a[some][group] + within // wide[group]]
        right = self.b[self.first_b[some][group] + within % wide[group]]
        key, times = np.unique(self.row[some][group] * pairs + left * size_b + right, return_counts=True)
        keys, counts = [key], [times]
        for large in np.flatnonzero(self.links > listed).tolist():
            (a, of_a), (b, of_b) = (
                np.unique(ids[first[large] : first[large + 1]], return_counts=True)
                for ids, first in ((self.a, self.first_a), (self.b, self.first_b))
            )
            keys.append((int(self.row[large]) * pairs + a[:, None] * size_b + b).reshape(-1))
            counts.append((of_a[:, None] * of_b).reshape(-1))
        if len(keys) > 1:
            key, times = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, times = key[first], np.add.reduceat(times, first)
        return key // pairs, key % pairs, times


def id_parts(size_a: int, size_b: int) -> list[str]:
    return [f"{number}{sign}" for size, signs in ((size_a, ",|"), (size_b, ",;")) for sign in signs for number in range(size)]


def encode(docs: DataFrame, vocabularies: Vocabularies, digests: bool = True) -> DataFrame:
    """Per document: number (rid), doc_id, n_a, n_b, n_groups, n_links, groups, and its linked pairs with their links.

    ``groups`` lists the ids of every group as ``a1,a2|b1;a3|b2,b3``, or, with ``digests``, is the SHA-256 of that list.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabularies)
    kind = "int" if vocabularies.pairs < 1 << 31 else "bigint"
    number = pa.int32() if kind == "int" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        encoders = Encoders(known)
        length_a, length_b = (np.array([len(entry) for entry in side], np.int64) for side in (known.a, known.b))
        size_a, size_b = length_a.size, length_b.size
        parts = id_parts(size_a, size_b)
        for batch in batches:
            texts = batch.column("text")
            for first, last, *_ in pieces(texts):
                values = texts.slice(first, last - first).to_pylist()
                encoded = [encoders.encode(text) if text else None for text in values]
                at = np.array([place for place, pair in enumerate(encoded) if pair], np.int64)
                counts = np.zeros((4, len(values)), np.int64)
                written = [""] * len(values)
                limits = np.zeros(len(values) + 1, np.int64)
                pair = times = np.zeros(0, np.int64)
                if at.size:
                    groups = Groups([pair for pair in encoded if pair], length_a, length_b)
                    ones = np.ones(groups.count, np.int64)
                    for place, per_group in enumerate((groups.n_a, groups.n_b, ones, groups.links)):
                        counts[place, at] = groups.per_text(per_group)
                    for place, text in zip(at.tolist(), groups.written(parts, size_a, size_b)):
                        written[place] = hashlib.sha256(text.encode()).hexdigest() if digests else text
                    row, pair, times = groups.pairs(size_b, known.pairs)
                    limits[1:] = np.cumsum(np.bincount(at[row], minlength=len(values)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rid").slice(first, last - first),
                        batch.column("doc_id").slice(first, last - first),
                        *(pa.array(column) for column in counts),
                        pa.array(written, pa.string()),
                        *(
                            pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(column, form))
                            for column, form in ((pair, number), (times, pa.int64()))
                        ),
                    ],
                    names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    form = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(
        run,
        f"rid bigint, doc_id {form}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
        f"pairs array<{kind}>, times array<bigint>",
    )


def pair_counts(encoded: DataFrame, size_b: int) -> DataFrame:
    """Per pair of ids: the number of documents that hold it linked, and the highest such number of any pair of its A id.

    The highest numbers are one row per entry of A's vocabulary, so they can always be sent to all tasks.
    """
    counts = stage(encoded.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents")))
    id_a = F.floor(F.col("pair") / size_b).alias("id_a")
    highest = counts.groupBy(id_a).agg(F.max("documents").alias("highest"))
    return stage(counts.withColumn("id_a", id_a).join(F.broadcast(highest), "id_a").drop("id_a"))


def link_counts(encoded: DataFrame, counts: DataFrame, known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """Per rid with links: n_best, the links whose pair is the most frequent of its A id, and count_sum over all links."""
    levels = range(63)
    at_least = counts.agg(*[F.count(F.when(F.col("documents") >= 1 << level, 1)).alias(str(level)) for level in levels])
    found = at_least.first()
    least = 1 << next((level for level in levels if found[str(level)] <= known_pairs), 63)
    links = encoded.select("rid", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    # At most ``known_pairs`` rows, by the count above
    known = F.broadcast(counts.where(F.col("documents") >= least))
    looked_up = links.join(known, "pair")
    if least > 1:
        # Each of these pairs is in fewer than ``least`` documents
        others = links.join(known.select("pair"), "pair", "left_anti").join(
            counts.where(F.col("documents") < least).hint("merge"), "pair"
        )
        looked_up = looked_up.unionByName(others)
    return looked_up.groupBy("rid").agg(
        F.sum(F.when(F.col("documents") == F.col("highest"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("documents") * F.col("times")).alias("count_sum"),
    )


def align(
    docs: DataFrame, vocabularies: Vocabularies, digests: bool = False, known_pairs: int = KNOWN_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), and the counts of all pairs
    (pair, id of A times the size of B's vocabulary plus id of B; documents; highest)."""
    encoded = stage(encode(docs, vocabularies, digests))
    counts = pair_counts(encoded, len(vocabularies.b))
    sums = link_counts(encoded, counts, known_pairs)
    aligned = encoded.drop("pairs", "times").join(sums, "rid", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups",
    )
    return aligned, counts


def digest(aligned: DataFrame) -> DataFrame:
    """The documents of ``align(..., digests=True)`` under the names of the query."""
    return aligned.withColumnRenamed("groups", "groups_sha256")
