"""Removal of repeated passages by longest-previous-factor lengths over sampled suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere (``keep_first``: that also starts
earlier, in the order of the row keys and places). In suffix order the suffixes that share their first ``length``
bytes are neighbours; the previous or next smaller position among them is an earlier match, so the longest previous
factor at a position is at least ``length`` just where a smaller position has the same first ``length`` bytes. Only that
question is asked, so the order is needed no deeper than ``length`` bytes, and the neighbours that share them are one
group under a 128-bit hash of these bytes: its least position is the previous smaller one for all others. Positions are
not listed one by one, which would multiply the text: they are handled in blocks of starts and split as needed.

* Of the ``gram``-byte strings in a window of ``length`` bytes the one with the least hash (the leftmost on ties) is the
  window's anchor. Equal windows have their anchor at the same place, so only suffixes around equal anchors can match.
* A block is a run of windows of one anchor. Its core, the bytes common to all windows of the block, must repeat if any
  window does; if its whole range repeats, every window does.
* Blocks shrink by level, from all windows of an anchor to single windows. Blocks whose core is alone are settled as
  unique, blocks whose whole range has a twin as repeated. Where a core lies in different ranges, one block of each
  range goes one level down: what it finds there its twins need not find again.

What goes down is told to the next scan by two filters of fixed size, of cores and of blocks; their false positives cost
work and change nothing.
Groups are only counted and their least position taken, both combined before the shuffle, so a passage in a third of all
documents costs no task more than another.

Rules: a null text counts as empty; texts shorter than ``length`` stay whole. Rows are documents of their own: a row
repeated with its identifier repeats its text. Matches never cross documents. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodmart.llm.tables import KeyFilter, key_filter, row_key
from moodmart.llm.texts import RangeHash, mix, pieces
from moodmart.session import stage

LENGTH = 400
GRAM = 40
MIDDLE = 24
# Small hashes are those that a window has about ten of
SMALL = 10


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the least hash, leftmost on ties, in every run of ``width`` hashes.

    Least places from the left and from the right within blocks of ``width``; every run spans at most two blocks.
    """
    count = grams.size - width + 1
    blocks = -(-grams.size // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: grams.size] = grams
    table = padded.reshape(blocks, width)
    places = np.arange(padded.size, dtype=np.int64).reshape(blocks, width)
    left = np.minimum.accumulate(table, axis=1)
    new = np.ones(table.shape, bool)
    new[:, 1:] = table[:, 1:] < left[:, :-1]
    left_at = np.maximum.accumulate(np.where(new, places, -1), axis=1).reshape(-1)
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1]
    new[:] = True
    new[:, :-1] = table[:, :-1] <= right[:, 1:]
    right_at = np.minimum.accumulate(np.where(new, places, padded.size)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    ends = slice(width - 1, width - 1 + count)
    return np.where(right.reshape(-1)[:count] <= left.reshape(-1)[ends], right_at[:count], left_at[ends])


def _next_less(values: np.ndarray, steps: int, equal: bool) -> np.ndarray:
    """Place of the next value that is less (``equal``: or as small); beyond ``steps`` places or the end if there is none.

    Least values of runs of 1, 2, 4, ... tell how far every place may leap.
    """
    count, levels = values.size, steps.bit_length()
    least = [np.append(values, np.full(2 << levels, np.iinfo(np.uint64).max, np.uint64))]
    for level in range(levels - 1):
        least.append(np.minimum(least[-1][: -1 << level], least[-1][1 << level :]))
    place = np.arange(1, count + 1)
    for level in reversed(range(levels)):
        ahead = least[level][place]
        place += (ahead > values if equal else ahead >= values).astype(np.int64) << level
    return np.minimum(place, count)


def anchored_runs(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places that ``anchors`` finds, each once, with the first and last run that has its anchor there.

    A run's least hash is among the small ones, if it has any. So only places of small hashes are compared, and all
    places of stretches where whole runs have none.
    """
    last_run = grams.size - width
    small = grams <= np.uint64((1 << 64) * SMALL // max(width, SMALL + 1))
    at = np.flatnonzero(small)
    edges = np.concatenate([[-1], at, [grams.size]])
    bare = np.flatnonzero(np.diff(edges) > width)
    if bare.size:
        for begin, end in zip((edges[bare] + 1).tolist(), edges[bare + 1].tolist()):
            small[begin:end] = True
        at = np.flatnonzero(small)
    if at.size * 4 > grams.size:
        every = anchors(grams, width)
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        return every[first], first, np.append(first[1:], every.size) - 1
    values = grams[at]
    # No run holds more of the places than this
    steps = int((np.searchsorted(at, at + width) - np.arange(at.size)).max())
    after = np.append(at, grams.size + width)[_next_less(values, steps, False)]
    before = np.append(at[::-1], -1)[_next_less(values[::-1], steps, True)][::-1]
    first = np.maximum(np.maximum(before + 1, at - width + 1), 0)
    last = np.minimum(np.minimum(after - width, at), last_run)
    some = np.flatnonzero(first <= last)
    return at[some], first[some], last[some]


class Blocks:
    """The blocks of windows of a run of texts, at the level reached by the filters given."""

    def __init__(self, length: int, gram: int, steps: list[int]):
        self.length, self.gram, self.steps = length, gram, steps

    def of(
        self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, filters: list[tuple[KeyFilter, ...]], exact: bool
    ):
        """Row, first and last start (offsets in the row), core hash, name of the block and, if ``exact``, two hashes of
        the whole range. ``keys`` are hashes that stand for the rows."""
        none = np.zeros(0, np.int64)
        nothing = (none, none, none, *[none.view(np.uint64)] * 4)
        if data.size < self.length:
            return nothing
        hashes = RangeHash(data)
        at, low, high = anchored_runs(hashes.of_size(self.gram), self.length - self.gram + 1)
        # Windows lie in the row of their anchor
        row = np.searchsorted(offsets, at, side="right") - 1
        low, high = np.maximum(low, offsets[row]), np.minimum(high, offsets[row + 1] - self.length)
        going = low <= high
        for level, step in enumerate(self.steps):
            at, row, low, high = at[going], row[going], low[going], high[going]
            if not at.size:
                return nothing
            # Starts of one part are up to ``step`` places apart, counted back from the anchor
            most = (at - low) // step
            parts = most - (at - high) // step + 1
            if parts.max() > 1:
                at, row, low, high, most = (np.repeat(x, parts) for x in (at, row, low, high, most))
                part = most - (np.arange(at.size) - np.repeat(np.cumsum(parts) - parts, parts))
                edge = at - part * step
                low, high = np.maximum(low, edge - step + 1), np.minimum(high, edge)
            else:
                edge = at - most * step
            core = hashes.of(edge, edge - step + 1 + self.length)
            name = mix(keys[row] + (low - offsets[row]).astype(np.uint64))
            if level == len(filters):
                break
            going = filters[level][0].may_hold(core)
            for only in filters[level][1:]:
                going &= only.may_hold(name)
        first = second = none.view(np.uint64)
        if exact:
            again = RangeHash(data, 1)
            # The start within the block belongs to the hash, so that equal ranges cover the same windows
            shift = (edge - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            first, second = hashes.of(low, high + self.length) + shift, again.of(low, high + self.length) ^ shift
        return row, low - offsets[row], high - offsets[row], core, name, first, second


def _scan(docs: DataFrame, blocks: Blocks, filters: list[tuple[KeyFilter, ...]], exact: bool) -> DataFrame:
    ranges = ", name bigint, id bigint, text_id bigint, low int, high int, first bigint, second bigint"
    schema = "core bigint" + ranges * exact
    names = [part.split()[0] for part in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(name).to_numpy() for name in ("id", "text_id"))
            keys = mix(ids.view(np.uint64) + mix(texts.view(np.uint64)))
            for begin, end, data, offsets in pieces(batch.column("text")):
                row, low, high, core, name, first, second = blocks.of(data, offsets, keys[begin:end], filters, exact)
                columns = [core.view(np.int64)]
                if exact:
                    columns += [name.view(np.int64), ids[begin + row], texts[begin + row], low.astype(np.int32), high.astype(np.int32)]
                    columns += [first.view(np.int64), second.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=names)

    return docs.select("id", "text_id", "text").mapInArrow(scan, schema)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, middle: int = MIDDLE, keep_first: bool = False
) -> DataFrame:
    """Byte ranges [start, end) of ``docs`` (doc_id, text) covered by repeated strings; ranges may overlap.

    Keyed by (id, text_id), the parts of ``row_key``.
    """
    width = length - gram + 1
    if not 0 < middle <= width:
        raise ValueError("middle must be from 1 to length - gram + 1")
    keyed = docs.select(row_key().alias("key"), "text").select("key.id", F.col("key.text").alias("text_id"), "text")
    blocks = Blocks(length, gram, [width, middle, 1])
    cores = _scan(keyed, blocks, [], exact=False).groupBy("core").agg(F.count(F.lit(1)).alias("n"))
    filters: list[tuple[KeyFilter, ...]] = [(key_filter(stage(cores.where(F.col("n") > 1).select("core")), "core"),)]
    spans = None
    # The first filter is applied to the same level again, now with ranges; later ones to the next
    for level in range(3):
        rows = stage(_scan(keyed, _at_level(blocks, level), filters, exact=True))
        same = ["first", "second"]
        # Equal ranges have equal cores. Any block of a range may stand for it, unless the first is asked for
        order = F.struct("id", "text_id", "low", "name") if keep_first else F.struct("name")
        classes = stage(
            rows.groupBy(*same).agg(
                F.count(F.lit(1)).alias("n"), F.first("core").alias("core"), F.min(order).alias("least")
            )
        )
        twins = rows.drop("core").join(classes.where(F.col("n") > 1), same)
        if keep_first:
            twins = twins.where(order != F.col("least"))
        found = twins.select("id", "text_id", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
        spans = found if spans is None else spans.unionByName(found)
        if level < 2:
            split = classes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > 1)
            split = stage(split.select("core"))
            firsts = stage(classes.join(split, "core").select("least.name").distinct())
            filters = [*filters, (key_filter(split, "core"), key_filter(firsts, "name"))]
    return spans


def _at_level(blocks: Blocks, level: int) -> Blocks:
    """Blocks whose filters select anchors, then split cores, and which stop at ``level``."""
    return Blocks(blocks.length, blocks.gram, [blocks.steps[0], *blocks.steps[: level + 1]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        texts, starts, ends = (batch.column(name) for name in ("text", "starts", "ends"))
        rows = []
        for place in range(batch.num_rows):
            text = texts[place].as_buffer() if texts[place].is_valid else b""
            data = memoryview(text)
            removed = spans = done = 0
            kept = []
            if starts[place].is_valid:
                begin, end = (column[place].values.to_numpy() for column in (starts, ends))
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], np.maximum.accumulate(end[order])
                new = np.ones(begin.size, bool)
                new[1:] = begin[1:] > end[:-1]
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], begin.size) - 1
                for low, high in zip(begin[heads].tolist(), end[tails].tolist()):
                    kept.append(data[done:low])
                    done, removed, spans = high, removed + high - low, spans + 1
            kept.append(data[done:])
            rows.append((len(data), removed, spans, b"".join(kept)))
        sizes, cuts, counts, rest = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(list(column), pa.int64()) for column in (sizes, cuts, counts)),
                pa.array(list(rest), pa.binary()),
            ],
            names=names,
        )


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept, the remaining bytes."""
    spans = repeated_spans(docs, **settings)
    removed = spans.groupBy("id", "text_id").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    ).select("id", "text_id", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", row_key().alias("key"), "text")
        .select("doc_id", "key.id", F.col("key.text").alias("text_id"), "text")
        .join(removed, ["id", "text_id"], "left")
        .select("doc_id", "text", "starts", "ends")
        .mapInArrow(_cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    )


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
