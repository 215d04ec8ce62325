"""Repeated word sequences against plain Python."""

import random

import numpy as np
import plain
import pytest
from conftest import DATA
from test_llm_operators import EXTRA, SCHEMA, awkward_rows, expected, rows

from moodmart.llm import word_graph
from moodmart.llm.tables import let_go
from moodmart.session import stage
from pyspark.sql import functions as F

NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256")


def check(docs, texts, **settings):
    found = word_graph.digest(word_graph.without_repeats(docs, **settings))
    wanted = expected(plain.repeated_words(texts, settings.get("window", word_graph.WINDOW)))
    assert rows(found, *NAMES) == wanted
    return wanted


def test_awkward_documents(spark):
    made = awkward_rows()
    again = " ".join(made[7][1].split(" ")[20:60])
    made += [(500 + n, f"own{n} {again}\x0b\x0b\t{again} end{n}", "en", "s1", 1) for n in range(4)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(3)
    for name in EXTRA + ("nodes", "anchor", "k1", "text_id", "windows", "starts"):
        docs = docs.withColumn(name, F.lit("extra"))
    check(docs, [(row[0], row[1]) for row in made])


def test_no_documents(spark):
    assert word_graph.digest(word_graph.without_repeats(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("seed, window, gram, length", [(1, 13, 6, 32), (2, 4, 2, 3), (3, 5, 4, 10**9), (4, 3, 2, 1)])
def test_random_passages(spark, seed, window, gram, length):
    """Few words make nodes with many ways in and out, and circles."""
    chance = random.Random(seed)
    pool = [[chance.choice("abcdefg") for _ in range(chance.randrange(3, 60))] for _ in range(8)]
    pool.append(list("xyz") * 30)
    made = []
    for n in range(60):
        found = [word for _ in range(4) for word in chance.choice(pool)[chance.randrange(5) :]]
        made.append((chance.randrange(40), " ".join(found)))
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    assert any(row[2] for row in check(docs, made, window=window, gram=gram, length=length))


def test_joining_instead_of_filtering(spark, monkeypatch):
    monkeypatch.setattr(word_graph, "LEAST_BITS_PER_KEY", 1 << 40)
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    check(docs, [(row["doc_id"], row["text"]) for row in docs.collect()])


def test_a_circle_is_opened_and_a_passage_is_one_span(spark):
    chance = random.Random(9)
    passage = [f"w{chance.randrange(10**9)}" for _ in range(500)]
    circle = [f"c{n}" for n in range(40)]
    made = [(n, " ".join([f"begin{n}", *passage, f"end{n}"])) for n in range(6)]
    # Together these hold every window of the circle twice, and none holds them all
    for n in range(8):
        turned = (circle * 2)[n * 5 : n * 5 + 30]
        made += [(100 + n, " ".join(turned)), (200 + n, " ".join([f"own{n}", *turned]))]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    check(docs, made)
    # Every text is one stretch and none are equal, so all windows are edges or short paths
    spans = word_graph.repeated_spans(docs, length=1 << 62).collect()
    straight = [row for row in spans if row["doc_id"] < 100]
    assert [(row["start"], row["windows"]) for row in straight] == [(1, 488)] * 5
    assert {(row["source_id"], row["source_start"]) for row in straight} == {(0, 1)}
    assert len({row["path"] for row in straight}) == 1
    assert len({row["path"] for row in spans if row["doc_id"] >= 100} | {straight[0]["path"]}) == 2


def test_following_chains_and_circles(spark):
    links = [(n, n - 1, 1) for n in range(1, 40)] + [(n, n - 1 if n > 100 else 106, 2) for n in range(100, 107)]
    frame = spark.createDataFrame(links, "chain long, before long, distance long")
    found = {row["chain"]: (row["start"], row["distance"]) for row in word_graph._follow(frame).collect()}
    assert found == {n: (0, n) for n in range(1, 40)} | {n: (100, 2 * (n - 100)) for n in range(101, 107)}


@pytest.mark.parametrize("length", [1, 2, 3, 8, 32])
def test_picks_depend_on_their_neighbourhood(length):
    for seed in range(6):
        chance = np.random.default_rng(seed)
        texts = [" ".join(f"w{x}" for x in chance.integers(0, [5, 1000][seed % 2], n)) for n in chance.integers(0, 200, 6)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        windows = word_graph.Windows(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), 13, 6)
        reach, wanted = length // 2, []
        for at, row in zip(windows.at, windows.row):
            low, high = windows.words.first[row], windows.words.first[row + 1]
            near = windows.grams[max(0, at - reach) : at + reach + 1]
            inside = at - reach >= low and at + reach + 6 <= high
            wanted.append(inside and bool((np.delete(near, reach) > near[reach]).all()))
        assert windows.picked(length).tolist() == wanted


def test_what_is_let_go_is_deleted_and_nothing_else(spark, tmp_path):
    frame = stage(spark.range(5))
    folder = frame.inputFiles()[0].rsplit("/", 1)[0]
    let_go(frame)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError):
        let_go(spark.read.parquet(str(tmp_path / "own")))
