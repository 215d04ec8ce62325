"""Token totals: signed deltas against counting again, and commits that are repeated or broken off."""

import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from moodmart.llm.token_counts import Rollup, bpe_counts, kind_counts, pattern_counts

SCHEMA = "op string, seq int, doc_id long, text string, lang string, source string"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def totals(rollup):
    return {
        (row["source"], row["lang"]): (row["documents"], row["tokens"])
        for row in rollup.totals().where("tokenizer = 'words-1'").collect()
    }


def counted(documents):
    found = Counter(), Counter()
    for text, lang, source in documents.values():
        found[0][source, lang] += 1
        found[1][source, lang] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return {key: (found[0][key], found[1][key]) for key in found[0]}


def test_random_changes_equal_counting_again(spark, tmp_path):
    chance = random.Random(6)
    rollup, now = Rollup(spark, f"file://{tmp_path}/r"), {}
    for batch in range(1, 4):
        changes = []
        for seq in range(30):
            doc_id, op = chance.randrange(12), chance.choice(["insert", "revise", "delete"])
            text = chance.choice([None, "", "one two", "a b c d", "é è\tx"])
            lang, source = chance.choice(["en", None]), chance.choice(["s", "t", None])
            changes.append((op, seq, doc_id, text, lang, source))
            now.pop(doc_id, None)
            if op != "delete":
                now[doc_id] = (text, lang, source)
        frame = spark.createDataFrame(changes, SCHEMA).withColumn("batch", F.lit("extra"))
        rollup.commit(batch, frame)
        assert totals(rollup) == counted(now)
        rollup.commit(batch, frame)
        assert totals(rollup) == counted(now)


def test_a_broken_commit_counts_nothing_and_can_be_repeated(spark, tmp_path):
    rollup = Rollup(spark, f"file://{tmp_path}/r")
    rollup.commit(1, spark.createDataFrame([("insert", 0, 1, "a b", "en", "s")], SCHEMA))
    change = spark.createDataFrame([("revise", 0, 1, "a b c", "en", "s")], SCHEMA)

    class Broken(Rollup):
        def _store(self, frame, name, batch):
            if name == "deltas":
                raise OSError("lost")
            super()._store(frame, name, batch)

    with pytest.raises(OSError):
        Broken(spark, rollup.path).commit(2, change)
    assert totals(rollup) == {("s", "en"): (1, 2)}
    rollup.commit(3, spark.createDataFrame([("insert", 0, 2, "x", "en", "s")], SCHEMA))
    assert totals(rollup) == {("s", "en"): (2, 3)}


def test_documents_without_identifier_and_repeated_rows(spark, tmp_path):
    rollup = Rollup(spark, f"file://{tmp_path}/r")
    rows = [("insert", 0, None, "a b", None, None), ("insert", 0, None, "a b c", None, None)] * 2
    rollup.commit(1, spark.createDataFrame(rows, SCHEMA))
    assert totals(rollup) == {(None, None): (2, 5)}


def test_no_changes(spark, tmp_path):
    rollup = Rollup(spark, f"file://{tmp_path}/r")
    assert rollup.totals().count() == 0
    rollup.commit(1, spark.createDataFrame([], SCHEMA))
    assert rollup.totals().count() == 0


@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary here")
def test_byte_pair_counts(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "Hello, world! It's  fine.", "déjà vu 漢字 \n\n x"]
    docs = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "doc_id long, text string")
    found = {row["doc_id"]: row["counts"] for row in bpe_counts(docs, VOCABULARY, "byte-bpe-50k").collect()}
    assert found == {n: {"byte-bpe-50k": len(encoding.encode_ordinary(text or ""))} for n, text in enumerate(texts)}
    assert set(pattern_counts(docs).first()["counts"]) == {"words-1", "pieces-1"}


def test_kinds_of_bytes_count_as_the_patterns_do(spark):
    texts = [None, "", " ", "a", "a", "", "b\x1c\x85c", "été 漢字!! 😀a1--b", "\t\n\x0b\x0c\r x\x00y", "".join(map(chr, range(1, 400))), "é", "é", "é a"]
    texts += ["word, " * 100_000, "x" * 1_500_000, None, "end."]
    docs = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "doc_id long, text string").coalesce(1)
    frames = [kind_counts(docs), pattern_counts(docs)]
    by_kind, by_pattern = ({row["doc_id"]: row["counts"] for row in frame.collect()} for frame in frames)
    assert by_kind == by_pattern and frames[0].dtypes == frames[1].dtypes


def test_the_rollup_counts_by_kinds(spark, tmp_path):
    """Patterns took most of its time."""
    assert Rollup(spark, str(tmp_path)).count is kind_counts
