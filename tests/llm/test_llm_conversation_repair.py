"""Conversation repair against plain edits with audits written out, and against all edits of short conversations."""

import random
import re

import plain
import pytest
from conftest import DATA
from test_llm_operators import expected, rows

from moodmart.llm import conversation_repair as repair
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(frame, given, **settings):
    found = repair.reports(repair.damaged(frame), **settings)
    wanted = expected(plain.conversations(given))
    assert rows(found, *NAMES) == wanted
    return wanted


def awkward_rows():
    chance = random.Random(11)
    texts = ["Yes.", "No", "", " \t\x0b", "Why?  ", "Ends here!\n\n", "é…", None, "a" * 9000 + ".", "two\nlines."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ubiquitous"]
    made = []
    for conv in range(300):
        for place in range(chance.randrange(1, 12)):
            turn = chance.choice([place, place, place, None, place + 5])
            made.append((conv if conv % 9 else None, turn, chance.choice(roles[: chance.choice([2, 3, 8])]), chance.choice(texts)))
    return made + made[:5] + made[:5]


def test_given_conversations(spark):
    frame = spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet")
    given = [tuple(row[name] for name in ("conv_id", "turn", "role", "text")) for row in frame.collect()]
    assert any(row[6] for row in check(frame, given))


@pytest.mark.parametrize("settings", [{}, {"long": 0, "block_bits": 1}, {"long": 7, "block_bits": 2}, {"long": 3, "block_bits": 12}])
def test_awkward_conversations(spark, settings):
    given = awkward_rows()
    frame = spark.createDataFrame(given, SCHEMA).repartition(5)
    for name in ("key", "present_", "fault", "state", "place", "block", "copy", "kind", "edits", "tie"):
        frame = frame.withColumn(name, F.lit("extra"))
    check(frame, given, **settings)


def test_a_conversation_with_most_of_the_rows(spark):
    chance = random.Random(5)
    given = [(7, n, chance.choice(["user", "assistant"]), chance.choice(["same.", f"own {n}.", f"cut {n}"])) for n in range(6000)]
    given += [(n, m, "user", "hello.") for n in range(20) for m in range(3) if n != 7]
    check(spark.createDataFrame(given, SCHEMA).repartition(4), given, long=1000, block_bits=8)


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.reports(repair.damaged(none)).count() == 0
    assert repair.repaired(none).count() == 0


def test_conversations_without_rows_are_reported(spark):
    gone = next(n for n in range(1000) if not list(plain.damage([(n, 0, "user", "x")])))
    found = repair.reports(repair.damaged(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA))).first()
    assert tuple(found) == (gone, 0, 0, 0, 0, 0, 0, "", plain.sha(""))


@pytest.mark.parametrize("settings", [{}, {"long": 2, "block_bits": 1}])
def test_repaired_rows(spark, settings):
    given = awkward_rows()
    frame = repair.damaged(spark.createDataFrame(given, SCHEMA))
    hashes = {row["conv_id"]: row["repaired_sha256"] for row in repair.reports(frame).collect()}
    held = {}
    for row in sorted(repair.repaired(frame, **settings).collect(), key=lambda row: (row["key"], row["place"])):
        held.setdefault(row["key"], []).append(row)
    for conv_id, wanted in hashes.items():
        left = held.get("" if conv_id is None else f"={conv_id}", [])
        assert plain.sha("\n".join(f"{row['role']}:{row['text']}" for row in left)) == wanted
        assert re.fullmatch("(s?(ua)+)?", "".join(row["role"][:1] for row in left))


def all_edits(kinds):
    found = []

    def go(place, initials, cost, audit):
        if place == len(kinds) and re.fullmatch("(s?(ua)+)?", initials):
            found.append((cost, audit))
        if len(audit) < 2 * len(kinds) + 2:
            for role in "ua":
                go(place, initials + role, cost + 2, audit + "I")
        if place < len(kinds):
            initial, fault = kinds[place]
            go(place + 1, initials, cost + 3, audit + "D")
            if fault != 2:
                go(place + 1, initials + initial, cost + fault, audit + "K")
                for role in "ua":
                    go(place + 1, initials + role, cost + 2 + fault, audit + "R")

    go(0, "", 0, "")
    return min(found)


def test_edits_are_the_cheapest_and_least():
    chance = random.Random(1)
    whole = repair.Repair()
    for size in [1, 2, 3] * 40 + list(range(4, 200)):
        kinds = tuple((chance.choice("ssuuaax"), chance.choice([0, 0, 0, 1, 2])) for _ in range(size))
        cost, edits, tail = whole.whole(kinds)
        assert (cost, "".join(edits) + tail) == plain.cheapest_edits(kinds)
        if size <= 3:
            assert plain.cheapest_edits(kinds) == all_edits(kinds)
