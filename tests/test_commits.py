"""Tables as commits: what readers see after empty, broken and concurrent writes, and what a repeated run changes."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from moodmart import schemas as S
from moodmart.operators.changes import change_feed, new_rows, old_rows
from moodmart.plans import gold
from moodmart.plans.maintained import MaintainedTrend, add_cells, extend_registry
from moodmart.sources import tables

PAIRS = "id string, value string"


def values(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def pairs(spark):
    return lambda *rows: spark.createDataFrame(list(rows), PAIRS)


def read(spark, path, **settings):
    from pyspark.sql.types import StructType

    return tables.read_table(spark, path, StructType.fromDDL(PAIRS), **settings)


def test_a_first_write_of_no_rows_is_an_empty_table(spark, tmp_path, pairs):
    for place, settings in enumerate(({}, {"partition_by": ["value"]}, {"partition_by": ["value"], "only_touched_partitions": True})):
        path = str(tmp_path / f"table{place}")
        assert tables.write_table(pairs(), path, **settings) == 0
        assert read(spark, path).count() == 0 and read(spark, path).columns == ["id", "value"]
        assert tables.write_table(pairs(("1", "a")), path, **settings) == 1
        assert values(read(spark, path)) == [("1", "a")]
        if "only_touched_partitions" not in settings:
            assert tables.write_table(pairs(), path, **settings) == 0
            assert read(spark, path).count() == 0


def test_partitions_can_be_emptied_and_picked(spark, tmp_path, pairs):
    path = str(tmp_path / "table")
    part = {"partition_by": ["value"], "only_touched_partitions": True}
    tables.write_table(pairs(("1", "a"), ("2", "b: c/d"), ("3", None)), path, **part)
    names = [tables.partition_name(spark, value=value) for value in ("a", "b: c/d", None)]
    assert values(read(spark, path, partitions=names[:1])) == [("1", "a")]
    assert values(read(spark, path, partitions=names[1:])) == [("2", "b: c/d"), ("3", None)]
    assert tables.write_table(pairs(("4", "e")), path, **part, emptied=names[1:]) == 1
    assert values(read(spark, path)) == [("1", "a"), ("4", "e")] == values(spark.read.parquet(path))


def test_a_write_without_commit_is_not_seen(spark, tmp_path, pairs):
    path = str(tmp_path / "table")
    tables.write_table(pairs(("1", "a")), path)
    tables._add_files(pairs(("2", "b")), path, [])
    assert values(read(spark, path)) == [("1", "a")]
    assert spark.read.parquet(path).count() == 2
    tables.vacuum(spark, path)
    assert values(spark.read.parquet(path)) == values(read(spark, path)) == [("1", "a")]


def test_a_manifest_without_end_is_none(spark, tmp_path, pairs):
    path = str(tmp_path / "table")
    tables.write_table(pairs(("1", "a")), path, note={"run": 1})
    (tmp_path / "table/_commits/000000000002.json").write_text('{"marks": {"')
    assert values(read(spark, path)) == [("1", "a")]
    tables.write_table(pairs(("2", "b")), path, note={"run": 2})
    assert values(read(spark, path)) == [("2", "b")]
    assert (tables.last_commit(spark, path).number, tables.last_commit(spark, path).note) == (3, {"run": 2})


def test_the_slower_of_two_writers_fails(spark, tmp_path, pairs, monkeypatch):
    path = str(tmp_path / "table")
    tables.write_table(pairs(("1", "a")), path)
    add = tables._add_files

    def overtaken(frame, where, partition_by):
        found = add(frame, where, partition_by)
        monkeypatch.setattr(tables, "_add_files", add)
        tables.write_table(pairs(("2", "b")), path)
        return found

    monkeypatch.setattr(tables, "_add_files", overtaken)
    with pytest.raises(tables.ConcurrentWrite):
        tables.write_table(pairs(("3", "c")), path)
    assert values(read(spark, path)) == [("2", "b")]


def test_a_folder_without_manifests_is_taken_over(spark, tmp_path, pairs):
    path = str(tmp_path / "table")
    pairs(("1", "a"), ("2", "b")).write.partitionBy("value").parquet(path)
    assert tables.write_table(pairs(("3", "b")), path, ["value"], only_touched_partitions=True) == 1
    assert values(read(spark, path)) == [("1", "a"), ("3", "b")]


def test_untouched_partitions_keep_their_files(spark, tmp_path, pairs):
    path = str(tmp_path / "table")
    part = {"partition_by": ["value"], "only_touched_partitions": True}
    tables.write_table(pairs(("1", "a"), ("2", "b")), path, **part)
    before = json.loads((tmp_path / "table/_commits/000000000001.json").read_text())["marks"]
    tables.write_table(pairs(("3", "b")), path, **part)
    after = json.loads((tmp_path / "table/_commits/000000000002.json").read_text())["marks"]
    assert before["value=a"] == after["value=a"] and before["value=b"] != after["value=b"]


# --- changes and what is kept up by them ------------------------------------------------------------------------------


def test_changes_between_two_states(pairs):
    before = pairs(("1", "a"), ("2", "b"), ("3", None), ("4", "d"), (None, "x"))
    after = pairs(("2", "b"), ("3", None), ("4", "e"), ("5", None), (None, "y"))
    feed = change_feed(before, after, "id")
    assert values(feed.select("id", "change")) == [("1", "removed"), ("4", "replaced"), ("5", "inserted")]
    assert values(old_rows(feed)) == [("1", "a"), ("4", "d")]
    assert values(new_rows(feed)) == [("4", "e"), ("5", None)]
    assert change_feed(before, after, "id", ignore=("value",)).count() == 2


def test_teams_keep_their_numbers(spark):
    teams = lambda *names: spark.createDataFrame([(name,) for name in names], "team_name string")
    first = extend_registry(spark.createDataFrame([], S.DIM_TEAM), teams("b", "d", "b", None))
    assert values(first) == [(1, "b"), (2, "d")]
    second = extend_registry(first, teams("c", "a", "d"))
    assert values(second) == [(1, "b"), (2, "d"), (3, "a"), (4, "c")]
    assert values(extend_registry(second, teams())) == values(second)


def test_cells_that_reach_zero_go(spark):
    form = "fk_team_id long, fk_date_id date, fk_sentiment_id long, subjective long, facts long"
    day = dt.date(2025, 1, 1)
    cells = spark.createDataFrame([(1, day, 0, 1, 2), (1, day, 3, 0, 5)], form)
    signed = spark.createDataFrame([(1, day, 0, 1, -2), (1, day, 3, 0, 1), (2, day, 0, 0, 1)], form)
    assert values(add_cells(cells, signed)) == [(1, day, 3, 0, 6), (2, day, 0, 0, 1)]


def test_a_maintained_trend_equals_a_rebuild(spark, tmp_path):
    chance = random.Random(6)
    lexicon = spark.createDataFrame([("good", 70, 60), ("bad", -65, 40)], S.LEXICON)
    state, maintained = {}, MaintainedTrend(spark, str(tmp_path))

    def frame(articles):
        return spark.createDataFrame([(*row, key) for key, row in articles.items()], S.ARTICLES)

    for run in range(1, 4):
        before = dict(state)
        for _ in range(25):
            key = f"k{chance.randrange(40)}"
            if chance.random() < 0.25:
                state.pop(key, None)
            else:
                day = dt.date(2024, 12, 1) + dt.timedelta(days=chance.randrange(60))
                title = chance.choice(["Late win", "Vote: the fans' verdict", "A good day"])
                text = " ".join(chance.choice(["good", "bad", "day", "goal"]) for _ in range(4))
                state[key] = (chance.choice("ABCDEF"[: run * 2]), day, title, text)
        counts = maintained.apply(run, frame(before), frame(state), lexicon)
        again = maintained.apply(run, frame(before), frame(state), lexicon)
        assert sum(counts.values()) > 0 and set(again.values()) == {0}
        articles, teams = frame(state), maintained.teams()
        sentiments = gold.dim_sentiment(spark)
        reactions = gold.fact_reaction(gold.reaction(articles, teams), sentiments, lexicon)
        titles = gold.fact_title(gold.article(articles, teams), sentiments, lexicon)
        wanted = gold.sentiment_trend(reactions, titles, sentiments, gold.dim_date(articles))
        assert values(maintained.trend()) == values(wanted)
    assert maintained.changes().select("run").distinct().count() == 3


def test_only_months_of_changed_articles_are_written(spark, tmp_path):
    lexicon = spark.createDataFrame([("good", 70, 60)], S.LEXICON)
    row = lambda key, month, text: ("A", dt.date(2025, month, 3), "Late win", text, key)
    frame = lambda *rows: spark.createDataFrame(list(rows), S.ARTICLES)
    maintained = MaintainedTrend(spark, str(tmp_path))
    first = frame(row("a", 1, "good"), row("b", 2, "good"))
    maintained.apply(1, frame(), first, lexicon)
    before = tables.last_commit(spark, maintained._cells).marks
    maintained.apply(2, first, frame(row("a", 1, "good"), row("b", 2, "day")), lexicon)
    after = tables.last_commit(spark, maintained._cells).marks
    assert before["month=2025-01"] == after["month=2025-01"] and before["month=2025-02"] != after["month=2025-02"]
