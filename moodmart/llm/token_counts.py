"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes inserts, revises or deletes documents. For every document it touches, what the committed batches
before it have counted is taken off, and the new count is added; the signed differences are summed per source, language
and tokenizer version and stored as the batch's delta. Totals are the sums of the committed deltas: no text is ever
counted again for them.

A batch is stored under its number: first the counts of the documents it touches, then its delta, which commits it.
Storing replaces whatever the same number has left, and a batch only looks at smaller numbers, so committing it again,
after a failure or by mistake, changes nothing. Batches are committed in the order of their numbers.

Rules: inserting a known document revises it; deleting an unknown one does nothing. Of several changes of a document in
one batch the one with the greatest ``seq`` counts (then the greatest hash of its text). A document without identifier
is known by the hash of its text. A null text has no tokens; null sources and languages are groups of their own. Rows
repeated in a batch are one change. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmart.llm.texts import pieces
from moodmart.sources.tables import read_table

# Tokenizers given as patterns, by version
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"[0-9A-Za-z]+|[^\x00-\x7F]+|[!-/:-@\[-`{-~]",
}

_ABOVE_ASCII = bytes(range(0x80, 0x100))
_BLANK = b"\x20\x09\x0A\x0B\x0C\x0D"
_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_SIGNS = bytes(byte for byte in range(0x21, 0x7F) if byte not in _ALNUM)

# The same tokenizers as kinds of bytes of UTF-8; True: a run is one token, False: every byte is one. Code points above 0x7F
# have no byte below 0x80, so a kind has all of 0x80 to 0xFF or none
KINDS = {
    "words-1": ((bytes(byte for byte in range(256) if byte not in _BLANK), True),),
    "pieces-1": ((_ALNUM, True), (_ABOVE_ASCII, True), (_SIGNS, False)),
}

_COUNTS = "batch long, identity string, deleted boolean, source string, lang string, counts map<string,bigint>"
_DELTAS = "batch long, source string, lang string, tokenizer string, documents long, tokens long"


def pattern_counts(docs: DataFrame, patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """``docs`` without text, with ``counts``, the number of tokens by tokenizer version."""
    pairs: list[Column] = []
    for version, pattern in sorted(patterns.items()):
        tokens = F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("long")
        pairs += [F.lit(version), tokens]
    return docs.withColumn("counts", F.create_map(*pairs)).drop("text")


def _tokens(data: np.ndarray, offsets: np.ndarray, kinds: tuple[tuple[bytes, bool], ...]) -> np.ndarray:
    """Tokens per row of a run of texts: bytes of a kind that do not go on with a run before them."""
    kind_of, in_runs = np.zeros(256, np.uint8), np.zeros(len(kinds) + 1, bool)
    for number, (members, runs) in enumerate(kinds, 1):
        kind_of[np.frombuffer(members, np.uint8)], in_runs[number] = number, runs
    kind = kind_of[data]
    begins = kind != 0
    goes_on = in_runs[kind[1:]] & (kind[1:] == kind[:-1])
    first = offsets[(offsets > 0) & (offsets < data.size)]
    goes_on[first - 1] = False
    begins[1:] &= ~goes_on
    before = np.concatenate([[0], np.cumsum(begins)])
    return before[offsets[1:]] - before[offsets[:-1]]


def kind_counts(docs: DataFrame, kinds: dict[str, tuple[tuple[bytes, bool], ...]] = KINDS) -> DataFrame:
    """As ``pattern_counts`` for tokenizers that tell tokens by kinds of bytes, at a small part of its time."""
    versions = sorted(kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, len(versions)), np.int64)
            for begin, end, data, offsets in pieces(batch.column("text")):
                for place, version in enumerate(versions):
                    found[begin:end, place] = _tokens(data, offsets, kinds[version])
            counts = pa.MapArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(versions)),
                pa.array(versions * batch.num_rows, pa.string()),
                pa.array(found.reshape(-1)),
            )
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, counts], names=[*kept.schema.names, "counts"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(count, f"{schema}, counts map<string,bigint>")


def bpe_counts(docs: DataFrame, path: str, version: str) -> DataFrame:
    """As ``pattern_counts`` for a byte-pair vocabulary of ranks; ``path`` must be readable where the tasks run."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        encoding = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [
                [(version, len(encoding.encode_ordinary(text.as_py() or "")))] for text in batch.column("text")
            ]
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(counts, pa.map_(pa.string(), pa.int64()))],
                names=[*kept.schema.names, "counts"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(count, f"{schema}, counts map<string,bigint>")


class Rollup:
    """Totals stored below ``path``; ``count`` adds the counts to documents (default: ``kind_counts``)."""

    def __init__(self, spark: SparkSession, path: str, count=kind_counts):
        self.spark, self.path, self.count = spark, path.rstrip("/"), count

    def _table(self, name: str, schema: str) -> DataFrame:
        return read_table(self.spark, f"{self.path}/{name}", self._schema(schema))

    def _schema(self, text: str):
        from pyspark.sql.types import StructType

        return StructType.fromDDL(text)

    def _store(self, frame: DataFrame, name: str, batch: int) -> None:
        frame.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Apply ``changes`` (op: insert, revise or delete; seq; doc_id, text, lang, source) as batch ``batch``."""
        identity = F.coalesce(
            F.concat(F.lit("="), F.col("doc_id").cast("string")),
            F.concat(F.lit("#"), F.sha2(F.coalesce("text", F.lit("")), 256)),
        )
        counted = self.count(
            changes.select(
                identity.alias("identity"),
                "seq",
                F.xxhash64("text").alias("text_hash"),
                (F.col("op") == "delete").alias("deleted"),
                F.col("source").cast("string").alias("source"),
                F.col("lang").cast("string").alias("lang"),
                F.when(F.col("op") != "delete", F.col("text")).alias("text"),
            )
        )
        fields = ["deleted", "source", "lang", "counts"]
        latest = counted.groupBy("identity").agg(
            F.max_by(F.struct(*fields), F.struct("seq", "text_hash")).alias("change")
        )
        self._store(latest.select("identity", "change.*"), "counts", batch)
        now = self._table("counts", _COUNTS).where(F.col("batch") == batch)

        committed = self._table("deltas", _DELTAS).where(F.col("batch") < batch).select("batch").distinct()
        # One row per batch
        history = self._table("counts", _COUNTS).where(F.col("batch") < batch)
        history = history.join(F.broadcast(committed), "batch", "left_semi")
        before = (
            history.join(now.select("identity"), "identity", "left_semi")
            .groupBy("identity")
            .agg(F.max_by(F.struct(*fields), "batch").alias("old"))
            .select("old.*")
        )
        signed = (
            before.where(~F.col("deleted"))
            .select("source", "lang", "counts", F.lit(-1).alias("sign"))
            .unionByName(now.where(~F.col("deleted")).select("source", "lang", "counts", F.lit(1).alias("sign")))
        )
        delta = (
            signed.select("source", "lang", "sign", F.explode("counts").alias("tokenizer", "tokens"))
            .groupBy("source", "lang", "tokenizer")
            .agg(
                F.sum("sign").cast("long").alias("documents"),
                F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"),
            )
        )
        # A batch without effect is committed as well
        marker = self.spark.range(1).select(
            *[F.lit(None).cast("string").alias(name) for name in ("source", "lang", "tokenizer")],
            F.lit(0).cast("long").alias("documents"),
            F.lit(0).cast("long").alias("tokens"),
        )
        self._store(delta.unionByName(marker), "deltas", batch)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens) of all committed batches, without groups that have no document."""
        return (
            self._table("deltas", _DELTAS)
            .where(F.col("tokenizer").isNotNull())
            .groupBy("source", "lang", "tokenizer")
            .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
            .where(F.col("documents") != 0)
        )
