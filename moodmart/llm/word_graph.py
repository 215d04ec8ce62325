"""Removal of repeated word sequences over a compacted de Bruijn graph.

The nodes of the graph are the runs of ``window - 1`` words, its edges the runs of ``window`` words, each from its first
words to its last ones. Only edges that several documents hold are in it. Where a path of edges does not branch it is
compacted into one; documents that repeat a passage walk along such a path, and their coordinates in the text and on the
path advance together. So a document's repeated words are a few spans on compacted paths, each with the coordinates of
the earliest document that holds it: words that a smaller doc_id already has go.

* Texts are cut into stretches at words that the hashes around them pick. A stretch is a path from its first node to its last
  one. Equal stretches are counted together; all documents after the first that holds one are done with it, and their
  coordinates lead to the first one's. Only what is left of the texts is looked at window by window.
* Of the runs of ``gram`` words in a window the one with the least hash (leftmost on ties) is its anchor. Equal windows
  have equal anchors, so windows whose anchor one document alone holds are not repeated. An anchor that always has the
  same windows around it has them as one path; the windows of other anchors are edges of their own.
* Paths and edges that several documents hold are joined where a node has one way in and one way out. Neighbours in the
  text of the earliest document are joined along its coordinates; what is left is joined by pointer jumping, whose rounds
  are joins of chains and not of edges. A path that closes on itself is opened at its least coordinates.
* Occurrences look up their path. Neighbouring ones that advance alike in their document, on the path and in the
  earliest document are one span.

A node is a 64-bit hash of its words; an edge or short path is known by its two nodes, which hold all its words, and a
stretch by two hashes of its own. What is counted per stretch, anchor, path or node is combined before the shuffle, and occurrences meet paths in joins that adaptive execution can split, so a passage in a
third of all documents burdens no task.

Rules: words are runs of characters other than 0x20 and 0x09 to 0x0D, and are compared unchanged. A null text has no
words. A document without doc_id neither removes nor loses words. Rows with one doc_id are one document: neither of them
is the smaller. Windows are judged on the input. Only doc_id and text are read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodmart.llm.longest_previous import anchors
from moodmart.llm.tables import MAX_FILTER_BITS, KeyFilter, key_filter, let_go
from moodmart.llm.texts import Powers, RangeHash, mix, pieces
from moodmart.operators.joins import dimension_join
from moodmart.session import stage

WINDOW = 13
GRAM = 6
# Windows of a stretch, on average
STRETCH = 32
# With fewer bits a key, a filter lets too much through to be worth sending
LEAST_BITS_PER_KEY = 8

_BYTES = np.arange(256)
IS_WORD = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))


class Words:
    """Byte ranges of the words of a run of texts, and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.rows, size = offsets.size - 1, data.size
        inside = np.zeros(size + 2, bool)
        inside[1 : size + 1] = IS_WORD[data]
        cut = np.zeros(size + 1, bool)
        cut[offsets] = True
        here = inside[1 : size + 1]
        self.start = np.flatnonzero(here & (~inside[:size] | cut[:size]))
        self.end = np.flatnonzero(here & (~inside[2:] | cut[1:])) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, offsets)


class RunHash:
    """Hashes of runs of words, from prefix sums over the words' own hashes."""

    _powers = (Powers(0x9FB21C651E98DF25), Powers(0xC2B2AE3D27D4EB4F))

    def __init__(self, words: np.ndarray, seed: int = 0):
        up, self._down = self._powers[seed].of(words.size + 1)
        self._sums = np.zeros(words.size + 1, np.uint64)
        np.cumsum(mix(words + np.uint64(seed)) * up[: words.size], out=self._sums[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def of(self, size: int) -> np.ndarray:
        """The hash of every run of ``size`` words, whatever rows it lies in."""
        start = np.arange(self._sums.size - size)
        return self.between(start, start + size)


class Windows:
    """The windows of a run of texts: number of the first word, row, and the hashes of their grams and nodes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.words, self.window = Words(data, offsets), window
        row = self.words.row
        total = max(0, row.size - window + 1)
        self.at = np.flatnonzero(row[:total] == row[window - 1 :]) if total else np.zeros(0, np.int64)
        self.row = row[self.at]
        self.place = self.at - self.words.first[self.row]
        if self.at.size:
            self.hashes = RangeHash(data).of(self.words.start, self.words.end)
            self.runs = RunHash(self.hashes)
            self.grams, self.nodes = self.runs.of(gram), self.runs.of(window - 1)

    def picked(self, length: int) -> np.ndarray:
        """Which windows begin with a gram less than all others up to ``length`` / 2 before and after it, in one row.

        So picks depend on their neighbourhood alone, and are at least half of ``length`` apart whatever the text; one
        that repeats itself has none.
        """
        reach, grams = length // 2, self.grams
        found = np.zeros(grams.size, bool)
        if grams.size > 2 * reach:
            middle = np.arange(reach, grams.size - reach)
            leftmost = anchors(grams, 2 * reach + 1)
            rightmost = grams.size - 1 - anchors(grams[::-1], 2 * reach + 1)[::-1]
            row = self.words.row
            within = row[middle - reach] == row[np.minimum(middle + reach + row.size - grams.size, row.size - 1)]
            found[middle] = (leftmost == middle) & (rightmost == middle) & within
        return found[self.at]

    def runs_from(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of the runs that begin where ``cut`` is true or a row begins."""
        cut = cut.copy()
        cut[:1] = True
        cut[1:] |= self.row[1:] != self.row[:-1]
        begin = np.flatnonzero(cut)
        return begin, np.diff(np.append(begin, self.at.size))


def _rows(batch: pa.RecordBatch, first: int, row: np.ndarray, names: tuple[str, ...]) -> list[pa.Array]:
    at = pa.array(first + row)
    return [batch.column(name).take(at) for name in names]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )


def stretches(docs: DataFrame, window: int, gram: int, length: int) -> DataFrame:
    """Runs of windows between words that the text around them picks, one in ``length``: doc_id, text_id, place, n (windows),
    their name (k1, k2) and the nodes that they lead from and to."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in pieces(batch.column("text")):
                found = Windows(data, offsets, window, gram)
                if not found.at.size:
                    continue
                begin, n = found.runs_from(found.picked(length))
                start = found.at[begin]
                end = start + n + window - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        *_rows(batch, first, found.row[begin], ("doc_id", "text_id")),
                        pa.array(found.place[begin]),
                        pa.array(n),
                        _signed(found.runs.between(start, end)),
                        _signed(RunHash(found.hashes, 1).between(start, end)),
                        _signed(found.nodes[start]),
                        _signed(found.nodes[start + n]),
                    ],
                    names=["doc_id", "text_id", "place", "n", "k1", "k2", "tail", "head"],
                )

    schema = f"doc_id {_kind(docs)}, text_id bigint, place bigint, n bigint, k1 bigint, k2 bigint, tail bigint, head bigint"
    return _keyed(docs).mapInArrow(scan, schema)


def remainders(docs: DataFrame, repeated: DataFrame, window: int, gram: int) -> DataFrame:
    """The parts of the texts whose windows are not in ``repeated`` (doc_id, text_id, place, n): doc_id, text_id, the
    number of their first word, and their text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, counts = batch.column("places"), batch.column("counts")
            for first, last, data, offsets in pieces(batch.column("text")):
                words = Words(data, offsets)
                rows, starts, texts = [], [], []
                for row in range(first, last):
                    low, high = words.first[row - first], words.first[row - first + 1] - window + 1
                    if high <= low:
                        continue
                    change = np.zeros(high - low + 1, np.int64)
                    if places[row].is_valid:
                        begin, n = places[row].values.to_numpy(), counts[row].values.to_numpy()
                        np.add.at(change, begin, 1)
                        np.add.at(change, begin + n, -1)
                    left = np.concatenate([[False], np.cumsum(change)[:-1] == 0, [False]])
                    edges = np.flatnonzero(left[1:] != left[:-1])
                    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        rows.append(row)
                        starts.append(begin)
                        texts.append(data[words.start[low + begin] : words.end[low + end + window - 2]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *_rows(batch, 0, np.array(rows, np.int64), ("doc_id", "text_id")),
                        pa.array(starts, pa.int64()),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "text_id", "start", "text"],
                )

    listed = repeated.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("place", "n")).alias("gone"))
    listed = listed.select("doc_id", "text_id", F.col("gone.place").alias("places"), F.col("gone.n").alias("counts"))
    # Rows equal in doc_id and text hold the same windows
    keyed = _keyed(docs).join(listed, ["doc_id", "text_id"], "left")
    return keyed.mapInArrow(cut, f"doc_id {_kind(docs)}, text_id bigint, start bigint, text string")


class Anchored:
    """Runs of windows of one anchor, in the parts of texts given by ``remainders``."""

    def __init__(self, parts: DataFrame, window: int, gram: int):
        self.parts, self.window, self.gram = parts, window, gram

    def _scan(self, columns: str, only: KeyFilter | None, split: KeyFilter | None, every: bool) -> DataFrame:
        """``every`` window is a run of its own, or those whose anchor is in ``split``."""
        window, gram = self.window, self.gram
        names = [part.strip().split()[0] for part in columns.split(",")]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, _, data, offsets in pieces(batch.column("text")):
                    found = Windows(data, offsets, window, gram)
                    if not found.at.size:
                        continue
                    anchor_at = anchors(found.grams, window - gram + 1)[found.at]
                    anchor = found.grams[anchor_at]
                    cut = np.ones(anchor.size, bool)
                    if not every:
                        cut[1:] = anchor_at[1:] != anchor_at[:-1]
                        if split is not None:
                            cut |= split.may_hold(anchor)
                    begin, n = found.runs_from(cut)
                    if only is not None:
                        chosen = only.may_hold(anchor[begin])
                        begin, n = begin[chosen], n[chosen]
                    start, row = found.at[begin], found.row[begin]
                    tail, head = found.nodes[start], found.nodes[start + n]
                    made = {
                        "anchor": lambda: _signed(anchor[begin]),
                        "kind": lambda: _signed(mix(tail + mix(head) * np.uint64(3) + n.astype(np.uint64))),
                        "doc_id": lambda: _rows(batch, first, row, ("doc_id",))[0],
                        "text_id": lambda: _rows(batch, first, row, ("text_id",))[0],
                        "place": lambda: pa.array(
                            found.place[begin] + batch.column("start").to_numpy()[first + row]
                        ),
                        "n": lambda: pa.array(n),
                        "tail": lambda: _signed(tail),
                        "head": lambda: _signed(head),
                    }
                    yield pa.RecordBatch.from_arrays([made[name]() for name in names], names=names)

        return self.parts.mapInArrow(scan, columns)

    @staticmethod
    def _filter(keys: DataFrame) -> KeyFilter | None:
        """A filter of fixed size, whose false positives only cost work, unless there are more keys than it can tell
        apart."""
        return key_filter(keys, "anchor") if keys.count() * LEAST_BITS_PER_KEY <= MAX_FILTER_BITS else None

    def occurrences(self) -> DataFrame:
        """Runs whose anchor several documents hold: doc_id, text_id, place, n, tail and head.

        An anchor that always has the same windows around it has them in one run. Others have every window as a run, and
        so have all if there are too many anchors for filters: these are joined with.
        """
        doc_id = f"doc_id {_kind(self.parts)}"
        counted = self._scan("anchor bigint", None, None, False).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        repeated = self._filter(stage(counted.where(F.col("n") > 1).select("anchor")))
        kinds = self._scan(f"anchor bigint, kind bigint, {doc_id}", repeated, None, False)
        shared = stage(
            kinds.groupBy("anchor")
            .agg(
                (F.min("kind") != F.max("kind")).alias("split"),
                F.min("doc_id").alias("low"),
                F.max("doc_id").alias("high"),
            )
            .where(F.col("low") < F.col("high"))
            .select("anchor", "split")
        )
        several, split = self._filter(shared.select("anchor")), self._filter(shared.where("split").select("anchor"))
        columns = f"{doc_id}, text_id bigint, place bigint, n bigint, tail bigint, head bigint"
        if several is not None and split is not None:
            return self._scan(columns, several, split, False)
        single = self._scan(f"anchor bigint, {columns}", None, None, True)
        return single.join(shared.select("anchor"), "anchor", "left_semi").drop("anchor")


def units(found: DataFrame, name: list[str]) -> DataFrame:
    """The runs that several documents hold, by name: their nodes, number of windows and earliest occurrence."""
    ends = [F.first(column).alias(column) for column in ("tail", "head", "n") if column not in name]
    source = F.min(F.struct("doc_id", "text_id", "place")).alias("source")
    grouped = found.groupBy(*name).agg(*ends, source, F.max("doc_id").alias("last"))
    return stage(grouped.where(F.col("source.doc_id") < F.col("last")).drop("last"))


def _follow(links: DataFrame) -> DataFrame:
    """(chain, start, distance) for chains with one before them, from ``links`` (chain, before, distance), by doubling.

    A chain has at most one before and one after it. One that is on its way after enough rounds for all links lies on a
    circle; circles are opened before their least chain and followed again.
    """
    state = stage(links.select("chain", F.col("before").alias("start"), "distance", F.col("chain").alias("least")))
    rounds, moving = state.count().bit_length() + 1, True
    while moving and rounds:
        ahead = state.select(
            F.col("chain").alias("start"), F.col("start").alias("next"),
            F.col("distance").alias("further"), F.col("least").alias("other"),
        )
        state = stage(
            state.join(ahead, "start", "left").select(
                "chain",
                F.coalesce("next", "start").alias("start"),
                (F.col("distance") + F.coalesce("further", F.lit(0))).alias("distance"),
                F.least("least", "other").alias("least"),
                F.col("next").isNotNull().alias("moving"),
            )
        )
        moving, rounds = not state.where("moving").isEmpty(), rounds - 1
    if not moving:
        return state.select("chain", "start", "distance")
    circles = state.where("moving").select("chain", "least")
    opened = links.join(circles, "chain").where(F.col("chain") != F.col("least")).select("chain", "before", "distance")
    return state.where("not moving").select("chain", "start", "distance").unionByName(_follow(opened))


def compact(graph: DataFrame) -> DataFrame:
    """``graph`` (tail, head, n, source and further columns) with the path of every unit, named by the path's first
    coordinates, and its offset on it."""
    ways = graph.select(F.col("tail").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        graph.select(F.col("head").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    ways = ways.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    branching = stage(ways.where("out > 1 OR into > 1").select("node"))
    text = ["source.doc_id", "source.text_id"]
    before = F.lag(F.struct((F.col("source.place") + F.col("n")).alias("end"), "head")).over(
        Window.partitionBy(*text).orderBy("source.place")
    )
    marked = dimension_join(
        graph, branching.select(F.col("node").alias("tail"), F.lit(True).alias("branches")), "tail", "left"
    ).withColumn("before", before)
    goes_on = (
        F.col("branches").isNull()
        & (F.col("before.end") == F.col("source.place"))
        & (F.col("before.head") == F.col("tail"))
    )
    begin = F.max(F.when(F.coalesce(~goes_on, F.lit(True)), F.col("source.place"))).over(
        Window.partitionBy(*text).orderBy("source.place")
    )
    placed = stage(
        marked.withColumn("chain", F.struct(*text, begin.alias("place"))).drop("before", "branches")
    )
    chains = stage(
        placed.groupBy("chain").agg(
            F.min_by("tail", "source.place").alias("tail"),
            F.max_by("head", "source.place").alias("head"),
            (F.max(F.col("source.place") + F.col("n")) - F.min("source.place")).alias("n"),
        )
    )
    ends = chains.select(F.col("head").alias("node"), F.col("chain").alias("before"), F.col("n").alias("distance"))
    starts = chains.select(F.col("tail").alias("node"), "chain")
    links = ends.join(starts, "node").join(branching, "node", "left_anti").where(F.col("chain") != F.col("before"))
    followed = stage(_follow(stage(links.select("chain", "before", "distance"))))
    return dimension_join(placed, followed, "chain", "left").select(
        *graph.columns,
        F.xxhash64(F.coalesce("start", "chain")).alias("path"),
        (F.coalesce("distance", F.lit(0)) + F.col("source.place") - F.col("chain.place")).alias("offset"),
    )


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, length: int = STRETCH) -> DataFrame:
    """Spans of ``docs`` (doc_id, text) whose windows a smaller doc_id holds: doc_id, text_id, start and windows (number
    of the first word, and of windows), path and offset, and the earliest occurrence (source_id, source_start).

    Spans on one path that advance with their source are as long as they can be; they overlap by less than a window.
    """
    if not 1 < gram < window:
        raise ValueError("gram must be from 2 to window - 1")
    found = stage(stretches(docs, window, gram, length))
    whole = units(found, ["k1", "k2"])
    source = whole.select("k1", "k2", F.col("source.doc_id").alias("source_id"))
    # Whatever the documents after the first hold there, the first holds too: only its own windows are looked at again
    later = stage(found.drop("tail", "head").join(source, ["k1", "k2"]).where(F.col("doc_id") > F.col("source_id")))
    let_go(found)
    parts = stage(remainders(docs, later, window, gram))
    pieces_found = stage(Anchored(parts, window, gram).occurrences())
    let_go(parts)
    name = ["tail", "head", "n"]
    single = units(pieces_found, name).withColumns({"k1": F.lit(None).cast("long"), "k2": F.lit(None).cast("long")})
    graph = stage(whole.unionByName(single))
    let_go(whole)
    paths = stage(compact(graph))
    let_go(graph)
    found_in = ["source.doc_id AS source_id", "source.place AS source_start", "path", "offset"]
    placed = later.drop("source_id").join(paths.where("k1 IS NOT NULL").selectExpr("k1", "k2", *found_in), ["k1", "k2"])
    pieces_placed = pieces_found.join(paths.where("k1 IS NULL").selectExpr(*name, *found_in), name)
    columns = ["doc_id", "text_id", "place", "n", "path", "offset", "source_id", "source_start"]
    both = placed.select(*columns).unionByName(pieces_placed.select(*columns)).where(F.col("doc_id") > F.col("source_id"))
    row = Window.partitionBy("doc_id", "text_id").orderBy("place")
    before = F.lag(F.struct("n", "place", "path", "offset", "source_id", "source_start")).over(row)
    same = (F.col("before.path") == F.col("path")) & (F.col("before.source_id") == F.col("source_id"))
    for advancing in ("place", "offset", "source_start"):
        same = same & (F.col(f"before.{advancing}") + F.col("before.n") == F.col(advancing))
    number = F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(row)
    return (
        both.withColumn("before", before)
        .withColumn("span", number)
        .groupBy("doc_id", "text_id", "span")
        .agg(
            F.min(F.struct("place", "path", "offset", "source_id", "source_start")).alias("first"),
            F.sum("n").alias("windows"),
        )
        .select(
            "doc_id", "text_id", F.col("first.place").alias("start"), "windows",
            "first.path", "first.offset", "first.source_id", "first.source_start",
        )
    )


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The byte ranges of words one after another, each with a space behind it, and where each begins in that."""
    length = end - start + 1
    limits = np.concatenate([[0], np.cumsum(length)])
    source = np.repeat(start - limits[:-1], length) + np.arange(limits[-1])
    joined = data[np.minimum(source, data.size - 1)] if source.size else np.zeros(0, np.uint8)
    joined[limits[1:] - 1] = 0x20
    return joined.tobytes(), limits


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, length: int = STRETCH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept, the remaining words joined by single spaces (binary)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, windows = (batch.column(name) for name in ("starts", "windows"))
            for first, last, data, offsets in pieces(batch.column("text")):
                words = Words(data, offsets)
                change = np.zeros(words.start.size + 1, np.int64)
                for place in range(first, last):
                    if starts[place].is_valid:
                        begin = words.first[place - first] + starts[place].values.to_numpy()
                        np.add.at(change, begin, 1)
                        np.add.at(change, begin + windows[place].values.to_numpy() + window - 1, -1)
                kept = np.cumsum(change)[:-1] == 0
                total = np.diff(words.first)
                left = np.bincount(words.row[kept], minlength=words.rows)
                joined, limits = _joined(data, words.start[kept], words.end[kept])
                place = limits[np.concatenate([[0], np.cumsum(left)])].tolist()
                # The last word of a row has a space after it as well
                texts = [joined[low : max(low, high - 1)] for low, high in zip(place[:-1], place[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(total.astype(np.int64)),
                        pa.array((total - left).astype(np.int64)),
                        pa.array(texts, pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    spans = repeated_spans(docs, window, gram, length)
    listed = spans.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    listed = listed.select("doc_id", "text_id", F.col("spans.start").alias("starts"), F.col("spans.windows").alias("windows"))
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text")
        .join(listed, ["doc_id", "text_id"], "left")
        .select("doc_id", "text", "starts", "windows")
        .mapInArrow(cut, f"doc_id {_kind(docs)}, n_words bigint, n_removed bigint, kept binary")
    )


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
