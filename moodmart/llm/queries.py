"""One query per operator, over the whole tables it is meant for."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmart.llm import (
    conversation_repair,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    longest_previous,
    mixing,
    order_minhash,
    prob_minhash,
    secrets,
    token_alignment,
    word_graph,
)
from moodmart.llm.tables import read
from moodmart.llm.token_counts import Rollup
from moodmart.operators.joins import dimension_join
from moodmart.session import ensure_checkpoint_dir, stage

# Vocabulary files of public tokenizers; the driver reads them
TOKENIZERS = "/opt/tokenizers"


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(line_dedup.without_shared_lines(read(spark, folder, "documents")))


def file_path() -> Column:
    """Documents as files of a tree: the source, then the digits of doc_id, so that short numbers lie above long ones."""
    digits = F.regexp_replace(F.col("doc_id").cast("string"), "(.)(?=.)", "$1/")
    return F.concat_ws("/", F.coalesce("source", F.lit("none")), digits)


def licenses_query(spark: SparkSession, folder: str) -> DataFrame:
    files = read(spark, folder, "documents").withColumn("path", file_path())
    return licenses.scan(files, F.lit(True))


def near_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    result, _ = prob_minhash.near_duplicates(read(spark, folder, "documents"))
    return result.select("doc_id", "class_id", "class_size", F.col("first").alias("stays"))


def secrets_query(spark: SparkSession, folder: str) -> DataFrame:
    """Sources own the documents; a source's documents in one language are a repository."""
    docs = read(spark, folder, "documents")
    return secrets.digest(*secrets.find_secrets(docs, F.col("source"), F.concat_ws("/", "source", "lang")))


def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    """All documents are inserted; those of several lines are revised to lose their last line, which is committed twice;
    later copies of a text, known by their number, are deleted."""
    docs = read(spark, folder, "documents")
    columns = ["seq", "op", "doc_id", "text", "lang", "source"]
    rollup = Rollup(spark, f"{ensure_checkpoint_dir(spark)}/rollup-{uuid4().hex}")
    rollup.commit(1, docs.withColumns({"op": F.lit("insert"), "seq": F.lit(0)}).select(*columns))
    shorter = docs.where(F.col("text").contains("\n")).withColumn(
        "text", F.regexp_replace("text", r"\n[^\n]*\z", "")
    )
    revised = shorter.withColumns({"op": F.lit("revise"), "seq": F.lit(0)}).select(*columns)
    rollup.commit(2, revised)
    rollup.commit(2, revised)
    texts = docs.select("doc_id", F.sha2("text", 256).alias("hash"), "lang", "source")
    first = texts.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = dimension_join(texts, stage(first), "hash").where(F.col("doc_id") > F.col("first_id"))
    deleted = copies.withColumns({"op": F.lit("delete"), "seq": F.lit(0), "text": F.lit(None).cast("string")})
    rollup.commit(3, deleted.select(*columns))
    return rollup.totals()


def repeats_query(spark: SparkSession, folder: str) -> DataFrame:
    return longest_previous.digest(longest_previous.without_repeats(read(spark, folder, "documents")))


def decontaminate_query(spark: SparkSession, folder: str) -> DataFrame:
    result, _ = decontaminate.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return decontaminate.digest(result)


def language_query(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read(spark, folder, "documents")).drop("key")


def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(mixing.mix(read(spark, folder, "documents")))


def fingerprints_query(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.fingerprints(read(spark, folder, "documents"))


def token_alignment_query(spark: SparkSession, folder: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    vocabularies = token_alignment.read_vocabularies(
        f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model"
    )
    aligned, _ = token_alignment.align(read(spark, folder, "documents"), vocabularies, digests=True)
    return token_alignment.digest(aligned)


def word_graph_query(spark: SparkSession, folder: str) -> DataFrame:
    return word_graph.digest(word_graph.without_repeats(read(spark, folder, "documents")))


def conversation_repair_query(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.reports(conversation_repair.damaged(read(spark, folder, "conversations")))


QUERIES = {
    "op1_line_dedup": line_dedup_query,
    "op2_licenses": licenses_query,
    "op3_near_dedup": near_dedup_query,
    "op4_secrets": secrets_query,
    "op5_token_counts": token_counts_query,
    "op6_suffix_dedup": repeats_query,
    "op7_decontaminate": decontaminate_query,
    "op8_language": language_query,
    "op9_mixing": mixing_query,
    "op10_fingerprints": fingerprints_query,
    "op11_token_alignment": token_alignment_query,
    "op12_substring_dedup": word_graph_query,
    "op13_conversation_repair": conversation_repair_query,
}
