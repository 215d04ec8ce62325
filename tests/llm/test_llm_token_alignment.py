"""Token alignment against both tokenizers' own libraries and plain groups."""

import random

import numpy as np
import plain
import pytest
from conftest import DATA
from sentencepiece import SentencePieceProcessor
from test_llm_operators import EXTRA, SCHEMA, awkward_rows, expected, rows
from tokenizers import Tokenizer

from moodmart.llm import token_alignment
from moodmart.llm.queries import TOKENIZERS
from pyspark.sql import functions as F

FILES = (f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
ODD = [
    "<|endoftext|> <s> </s> <unk> <0x41>", "a \u2581 b", "\u2581", "tabs\tand\r\n  lines \n\n", "\x00 zero", " " * 70_000 + "x",
    "\u00a0\u3000\u0085x", "e\u0301\ufb01\u00b2 \u212b", "it's we'll I'D", "\U0001F469\u200d\U0001F680\uFFFD", "12 345,678", "\u0e01\u0e33 \u06f1",
]


@pytest.fixture(scope="module")
def vocabularies():
    return token_alignment.read_vocabularies(*FILES)


@pytest.fixture(scope="module")
def libraries(vocabularies):
    bytewise = Tokenizer.from_file(FILES[0])
    bytewise.encode_special_tokens = True
    processor = SentencePieceProcessor(model_file=FILES[1])

    def piece(number):
        text = processor.id_to_piece(number)
        return bytes([int(text[3:5], 16)]) if text.startswith("<0x") else text.replace("\u2581", " ").encode()

    alphabet = token_alignment.byte_alphabet()
    entries = {n: bytes(alphabet[c] for c in entry) for entry, n in bytewise.get_vocab().items() if n != 50256}
    pieces = [piece(number) for number in range(processor.get_piece_size())]
    return (
        lambda text: bytewise.encode(text, add_special_tokens=False).ids,
        processor.encode,
        entries.__getitem__,
        pieces.__getitem__,
    )


def check(docs, texts, vocabularies, libraries, **settings):
    aligned, counts = token_alignment.align(docs, vocabularies, digests=True, **settings)
    wanted, pairs = plain.alignment(texts, *libraries)
    assert rows(token_alignment.digest(aligned), *NAMES, "groups_sha256") == expected(wanted)
    size = len(vocabularies.b)
    found = {(row["pair"] // size, row["pair"] % size): row["documents"] for row in counts.collect()}
    assert found == dict(pairs)


def test_given_documents(spark, vocabularies, libraries):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").where(F.length("text") < 3000)
    check(docs, [(row["doc_id"], row["text"]) for row in docs.collect()], vocabularies, libraries)


@pytest.mark.parametrize("known_pairs", [0, 5, 1 << 21])
def test_awkward_documents(spark, vocabularies, libraries, known_pairs):
    made = [row for row in awkward_rows() if len(row[1] or "") < 6000]
    made += [(1000 + place, text, None, None, 1) for place, text in enumerate(ODD)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(3)
    for name in EXTRA + ("pair", "times", "groups"):
        docs = docs.withColumn(name, F.lit("extra"))
    check(docs, [(row[0], row[1]) for row in made], vocabularies, libraries, known_pairs=known_pairs)


def test_no_documents(spark, vocabularies):
    aligned, counts = token_alignment.align(spark.createDataFrame([], SCHEMA), vocabularies)
    assert aligned.count() == counts.count() == 0


def test_groups_are_written_out(spark, vocabularies, libraries):
    docs = spark.createDataFrame([(1, "unbelievable things"), (2, None)], "doc_id long, text string")
    found = {row["doc_id"]: row["groups"] for row in token_alignment.align(docs, vocabularies)[0].collect()}
    a = [int(x) for group in found[1].split(";") for x in group.split("|")[0].split(",")]
    b = [int(x) for group in found[1].split(";") for x in group.split("|")[1].split(",")]
    assert (a, b) == (libraries[0](" unbelievable things"), libraries[1]("unbelievable things"))
    assert found[2] == ""


def test_both_libraries_give_the_same_ids(vocabularies, libraries):
    encoders = token_alignment.Encoders(vocabularies)
    chance = random.Random(4)
    alphabet = "ab zé\t\n'sdl0 1漢\U0001F600.\u00a0-ِ"
    for _ in range(500):
        text = "".join(chance.choice(alphabet) for _ in range(60))
        assert encoders.encode(text)[0] == libraries[0](f" {text}")
    assert encoders.encode(" " * 1_200_000 + "x") is not None


def test_jumping_reaches_the_common_ends():
    chance = np.random.default_rng(2)
    for _ in range(200):
        total = int(chance.integers(1, 60))
        ends = [np.append(np.flatnonzero(chance.random(total - 1) < p) + 1, total) for p in (0.3, 0.5)]
        starts = [np.concatenate([[0], e[:-1]]) for e in ends]
        last = token_alignment.jump(starts[0], ends[0], starts[1], ends[1])
        common = np.intersect1d(*ends)
        wanted = [common[np.searchsorted(common, e)] for e in ends]
        assert ends[1][last].tolist() == np.concatenate(wanted).tolist()


def test_large_groups_count_links_by_id(vocabularies):
    lengths = [np.array([len(entry) for entry in side], np.int64) for side in (vocabularies.a, vocabularies.b)]
    encoders = token_alignment.Encoders(vocabularies)
    encoded = [encoders.encode(text) for text in ("x" * 50 + " unbelievable", "\U0001F600漢字 incomprehensibilities" * 3)]
    groups = token_alignment.Groups(encoded, *lengths)
    some = groups.pairs(lengths[1].size, vocabularies.pairs)
    for listed in (0, 1, 2):
        for one, other in zip(some, groups.pairs(lengths[1].size, vocabularies.pairs, listed=listed)):
            assert one.tolist() == other.tolist()
