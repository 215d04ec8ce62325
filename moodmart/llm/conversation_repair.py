"""Repair of conversations whose turns are damaged, by Hirschberg's divide and conquer over four states.

The role initials of a repaired conversation are ``(s?(ua)+)?``: what was given so far ends in one of four states, and
every edit of a row (keep, change the role, delete, each after inserted rows) is a step from one state to another. The
cheapest edits are wanted, and of these the ones whose audit, their initials in order, is least in ASCII.

A range of rows is cut in the middle. Cost vectors of four states run forward from its first state to the middle and
backward from its last state to the middle, and meet there; the state with the least sum is where the best edits cross.
On ties the audit-least is taken: forward vectors carry, besides costs, the order of the states' least audits. Inserted
rows go with the next row's edit, so every audit of a range ends with the edit of a row, none begins another of the same
rows, and comparing the halves one after the other compares the whole. Both halves are cut again, down to single rows, so
nothing but the rows and one vector is held, never a table of costs.

Conversations of up to ``LONG`` rows are repaired one at a time by the task they are sorted into. A longer one is sorted
by range over many tasks, in blocks. Every block is reduced to one step (costs and orders from each state to each), the
same divide and conquer over the blocks' steps gives the states between them, and each block is then repaired between
its two. Only its texts' hash, which the contract wants over the whole, is one task's work; it streams.

Rules: nulls in conv_id name a conversation of their own; null roles and texts are one space. Rows are ordered by turn
(nulls first), then role, then text; rows equal in all are repeated. An initial is the role's first character; a row of
another one can be deleted or get a new role. Empty texts are blank. Only conv_id, turn, role and text are read. A
conversation without rows has zeros, an empty audit and the hash of nothing; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmart.operators.joins import dimension_join, salted_join
from moodmart.session import settle, stage

# Conversations of more rows are dealt over several tasks, in blocks of as many rows
LONG = 4096
BLOCK_BITS = 12

BLANKS = " \t\n\x0b\x0c\r"
CLEAN, TRUNCATED, UNWANTED = 0, 1, 2
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after the system row, after a user, after an assistant
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEVER = math.inf
# Whom an inserted or changed row speaks for
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
TAILS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
KEEP, CHANGE, DELETE, INSERT = 0, 2, 3, 2
# Two inserts lead from any state to the one after an assistant, which saves at most a kept system row and an insert less
# than any other: a state dearer than the cheapest by more than 4 + 3 is on no best way
SLACK = 8

# Per state and next state: cost, and what orders the audits of one state's steps; missing if there is no step
Step = dict[tuple[int, int], tuple[float, object]]
Costs = tuple[float, ...]
# Costs and orders of all states; of those reached, the one with the least audit has order 0
Vector = tuple[Costs, tuple[int, ...]]


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row that is kept, if it may stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if NEXT[state] == USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def row_step(initial: str, fault: int) -> Step:
    """All edits of one row, each after none, one or two inserted rows; the cheapest of each pair of states, ASCII-least."""
    step: Step = {}
    late = int(fault == TRUNCATED)
    for state in STATES:
        here = state
        for inserted in range(3):
            edits = [(DELETE, "D", here)]
            if fault != UNWANTED:
                edits.append((CHANGE + late, "R", NEXT[here]))
                kept = kept_state(here, initial)
                if kept is not None:
                    edits.append((KEEP + late, "K", kept))
            for cost, letter, after in edits:
                found = (cost + INSERT * inserted, "I" * inserted + letter)
                step[state, after] = min(step.get((state, after), found), found)
            here = NEXT[here]
    return step


def ordered(reached: dict[int, tuple[float, object]]) -> Vector:
    """A vector from costs and whatever orders the audits of the states reached."""
    order = {state: place for place, state in enumerate(sorted(reached, key=lambda state: reached[state][1]))}
    costs = tuple(reached[state][0] if state in reached else NEVER for state in STATES)
    return costs, tuple(order.get(state, 4) for state in STATES)


def only(state: int) -> Vector:
    return ordered({state: (0, 0)})


def advance(vector: Vector, step: Step) -> Vector:
    """Costs and orders one step further: the cheapest way to each state, on ties the one with the least audit."""
    costs, orders = vector
    reached: dict[int, tuple[float, object]] = {}
    for (state, after), (cost, order) in step.items():
        if costs[state] < NEVER:
            found = (costs[state] + cost, (orders[state], order))
            reached[after] = min(reached.get(after, found), found)
    return ordered(reached)


def retreat(costs: Costs, step: Step) -> Costs:
    """Costs from each state to the end, one step earlier."""
    return tuple(
        min((cost + costs[after] for (state, after), (cost, _) in step.items() if state == here), default=NEVER)
        for here in STATES
    )


def without_least(costs: Costs, most: float = NEVER) -> tuple[float, Costs]:
    least = min(costs)
    return least, tuple(cost - least if cost - least <= most else NEVER for cost in costs)


class Repair:
    """Divide and conquer over steps. What one step does to a vector is remembered: there are few vectors once their least
    cost is taken off and states that are too dear are left out."""

    def __init__(self) -> None:
        self._rows: dict[tuple[str, int], Step] = {}
        self._forward: dict = {}
        self._backward: dict = {}
        self._known: dict = {}

    def step(self, initial: str, fault: int) -> Step:
        kind = (initial if initial in ("s", "u", "a") and fault != UNWANTED else "", fault)
        if kind not in self._rows:
            self._rows[kind] = row_step(*kind)
        return self._rows[kind]

    def forward(self, steps: Sequence[Step], low: int, high: int, vector: Vector) -> Vector:
        total, known = 0, self._forward
        for step in steps[low:high]:
            found = known.get((vector, id(step)))
            if found is None:
                costs, orders = advance(vector, step)
                least, costs = without_least(costs, SLACK)
                found = self._remember(known, (vector, id(step)), (least, (costs, orders), step))
            least, vector, _ = found
            total += least
        return tuple(cost + total for cost in vector[0]), vector[1]

    def backward(self, steps: Sequence[Step], low: int, high: int, costs: Costs) -> Costs:
        total, known = 0, self._backward
        for step in reversed(steps[low:high]):
            found = known.get((costs, id(step)))
            if found is None:
                found = self._remember(known, (costs, id(step)), (*without_least(retreat(costs, step)), step))
            least, costs, _ = found
            total += least
        return tuple(cost + total for cost in costs)

    @staticmethod
    def _remember(known: dict, key: tuple, result: tuple) -> tuple:
        """Results hold their step, so that no other gets its identity."""
        if len(known) >= 1 << 16:
            known.clear()
        known[key] = result
        return result

    def crossings(self, steps: Sequence[Step], first: int, last: int) -> list[int]:
        """The states between the steps of the best edits, from ``first`` to ``last``; one more than steps."""
        states = [first] * (len(steps) + 1)
        states[-1] = last
        ranges = [(0, len(steps))]
        while ranges:
            low, high = ranges.pop()
            if high - low < 2:
                continue
            middle = (low + high) // 2
            front = self.forward(steps, low, middle, only(states[low]))
            back = self.backward(steps, middle, high, only(states[high])[0])
            states[middle] = min(STATES, key=lambda state: (front[0][state] + back[state], front[1][state]))
            ranges += [(low, middle), (middle, high)]
        return states

    def end(self, steps: Sequence[Step]) -> tuple[int, int]:
        """The state that the best edits end in, and their cost with the rows inserted after it."""
        costs, orders = self.forward(steps, 0, len(steps), only(START))
        total = [costs[state] + INSERT * len(TAILS[state]) for state in STATES]
        last = min(STATES, key=lambda state: (total[state], orders[state]))
        return last, int(total[last])

    def edits(self, steps: Sequence[Step], first: int, last: int) -> list[str]:
        """Per row, the initials of the edits that end with its own."""
        states = self.crossings(steps, first, last)
        return [step[pair][1] for step, pair in zip(steps, zip(states, states[1:]))]

    def whole(self, kinds: tuple[tuple[str, int], ...]) -> tuple[int, list[str], str]:
        """Cost, edits per row and the inserts after all rows, of a conversation."""
        found = self._known.get(kinds)
        if found is None:
            steps = [self.step(*kind) for kind in kinds]
            last, cost = self.end(steps)
            found = cost, self.edits(steps, START, last), TAILS[last]
            if len(kinds) <= 16:
                if len(self._known) >= 1 << 16:
                    self._known.clear()
                self._known[kinds] = found
        return found


def edited(state: int, edits: str, role: str, text: str) -> tuple[int, list[tuple[str, str, str]]]:
    """The state after a row's edits, and the rows (edit, role, text) that they leave."""
    rows = []
    for edit in edits:
        if edit == "K":
            state = kept_state(state, role[:1])
            rows.append((edit, role, text))
        elif edit != "D":
            state = NEXT[state]
            rows.append((edit, ROLE[state], text if edit == "R" else ""))
    return state, rows


def illegal_pairs(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a rule of conversation and turn, with ``present``, false for those dropped."""
    known = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    how = F.pmod(F.crc32(F.concat(known["conv_id"], F.lit(":"), known["turn"]).cast("binary")), F.lit(20))
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(known["text"], "[.!?]", "")).otherwise(known["text"])
    return conversations.select(
        "conv_id",
        "turn",
        F.when(how == 4, "user").otherwise(known["role"]).alias("role"),
        text.alias("text"),
        (how != 0).alias("present"),
        F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _prepared(rows: DataFrame) -> DataFrame:
    """The columns that repair needs; ``fault`` is 2 for blank rows, 1 for truncated ones, before repeats are known."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    end = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    fault = F.when(end == "", UNWANTED).when(end.isin(".", "!", "?"), CLEAN).otherwise(TRUNCATED)
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        fault.alias("fault"),
        present.alias("present"),
    )


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = ", ".join(f"{name} bigint" for name in _NUMBERS) + ", audit string, repaired_sha256 string"
_ORDER = ("key", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The conversations of a sorted partition, one after another."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["key"] != row["key"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _repaired(repair: Repair, rows: list[dict]) -> tuple[dict, Iterator[tuple[str, str, str]]]:
    """Report and repaired rows of one conversation, given in order."""
    rows = [row for row in rows if row["present"]]
    turns = {row["turn"] for row in rows} - {None}
    report = dict.fromkeys(_NUMBERS, 0)
    if turns:
        report["gaps"] = max(turns) - min(turns) + 1 - len(turns)
    seen, kinds = set(), []
    for row in rows:
        fault = row["fault"]
        same = (row["role"], row["text"])
        if fault == UNWANTED:
            report["blank"] += 1
        elif same in seen:
            fault = UNWANTED
            report["duplicate"] += 1
        elif fault == TRUNCATED:
            report["truncated"] += 1
        seen.add(same)
        kinds.append((row["role"][:1], fault))
    report["illegal"] = illegal_pairs([initial for initial, _ in kinds])
    report["cost"], edits, tail = repair.whole(tuple(kinds))
    report["audit"] = "".join(edits) + tail

    def repaired() -> Iterator[tuple[str, str, str]]:
        state = START
        for row, edit in zip(rows, edits):
            state, left = edited(state, edit, row["role"], row["text"])
            yield from left
        yield from edited(state, tail, "", "")[1]

    return report, repaired()


def _digest(rows: Iterator[tuple[str, str, str]]) -> str:
    found, sign = hashlib.sha256(), ""
    for _, role, text in rows:
        found.update(f"{sign}{role}:{text}".encode())
        sign = "\n"
    return found.hexdigest()


def _kind(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions(*_ORDER)


def _short_reports(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair()
        form, found = None, []

        def listed() -> pa.RecordBatch:
            columns = [pa.array([row[0] for row in found], form)]
            columns += [pa.array([row[1][name] for row in found], pa.int64()) for name in _NUMBERS]
            columns += [pa.array([row[place] for row in found], pa.string()) for place in (2, 3)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_NUMBERS, "audit", "repaired_sha256"])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal form
            for batch in batches:
                form = batch.schema.field("conv_id").type
                yield batch

        for rows in _conversations(typed()):
            report, left = _repaired(repair, rows)
            found.append((rows[0]["conv_id"], report, report["audit"], _digest(left)))
            if len(found) >= 4096:
                yield listed()
                found = []
        if found:
            yield listed()

    return _sorted(rows).mapInArrow(run, f"conv_id {_kind(rows)}, {_REPORT}")


def _short_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair()
        for rows in _conversations(batches):
            made = [(rows[0]["key"], place, *row) for place, row in enumerate(_repaired(repair, rows)[1])]
            columns = zip(*made) if made else [[]] * 5
            forms = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), form) for column, form in zip(columns, forms)],
                names=["key", "place", "edit", "role", "text"],
            )

    return _sorted(rows).mapInArrow(run, "key string, place bigint, edit string, role string, text string")


class _Long:
    """Conversations of many rows, dealt by range over tasks and repaired block by block."""

    def __init__(self, rows: DataFrame, block_bits: int):
        self.rows = self._ordered(rows, block_bits)
        self.blocks = stage(self._block_steps())
        self.crossings = stage(self._crossings())
        self.edits = stage(self._edits())

    @staticmethod
    def _ordered(rows: DataFrame, block_bits: int) -> DataFrame:
        """Rows with their place in order and their block. Repeats are found by a hash that names role and text."""
        numbered = stage(
            rows.withColumns(
                {
                    "same": F.sha2(F.to_json(F.array("key", "role", "text")), 256),
                    "tie": F.monotonically_increasing_id(),
                }
            )
        )
        at = F.struct("turn", "tie")
        repeats = numbered.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("earliest")).where("n > 1")
        marked = salted_join(numbered, repeats.drop("n"), "same", "left").select(
            *rows.columns, "tie", (F.col("earliest").isNotNull() & ~at.eqNullSafe(F.col("earliest"))).alias("repeated")
        )
        order = [*_ORDER, "tie"]
        fault = F.when(F.col("repeated"), UNWANTED).otherwise(F.col("fault"))
        return stage(
            marked.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .withColumn("place", F.monotonically_increasing_id())
            .withColumns({"kind": fault, "block": F.shiftright("place", block_bits)})
        )

    def _narrow(self) -> DataFrame:
        return self.rows.select("key", "block", "place", F.left("role", F.lit(1)).alias("initial"), "kind")

    def _block_steps(self) -> DataFrame:
        def reduce(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("place")
            repair, initials = Repair(), rows["initial"].tolist()
            steps = [repair.step(*kind) for kind in zip(initials, rows["kind"].tolist())]
            vectors = [repair.forward(steps, 0, len(steps), only(state)) for state in STATES]
            return pd.DataFrame(
                {
                    "key": rows["key"].iloc[:1],
                    "block": rows["block"].iloc[0],
                    "first": initials[0],
                    "last": initials[-1],
                    "illegal": illegal_pairs(initials),
                    "costs": [[cost for costs, _ in vectors for cost in costs]],
                    "orders": [[order for _, orders in vectors for order in orders]],
                }
            )

        return self._narrow().groupBy("key", "block").applyInPandas(
            reduce,
            "key string, block bigint, first string, last string, illegal bigint, costs array<double>, orders array<bigint>",
        )

    def _crossings(self) -> DataFrame:
        """Per block its first and last state; one conversation's blocks, a row each, are one group."""

        def choose(blocks: pd.DataFrame) -> pd.DataFrame:
            blocks = blocks.sort_values("block")
            steps: list[Step] = [
                {
                    (place // 4, place % 4): (cost, order)
                    for place, (cost, order) in enumerate(zip(costs, orders))
                    if cost < NEVER
                }
                for costs, orders in zip(blocks["costs"], blocks["orders"])
            ]
            repair = Repair()
            last, cost = repair.end(steps)
            states = repair.crossings(steps, START, last)
            between = sum(a + b not in LEGAL for a, b in zip(blocks["last"].iloc[:-1], blocks["first"].iloc[1:]))
            tails = [""] * (len(steps) - 1) + [TAILS[last]]
            return pd.DataFrame(
                {
                    "key": blocks["key"],
                    "block": blocks["block"],
                    "before": states[:-1],
                    "after": states[1:],
                    "tail": tails,
                    "cost": cost,
                    "illegal": int(blocks["illegal"].sum()) + between,
                }
            )

        return self.blocks.groupBy("key").applyInPandas(
            choose,
            "key string, block bigint, before bigint, after bigint, tail string, cost bigint, illegal bigint",
        )

    def _edits(self) -> DataFrame:
        """Per row: key, block, place, the state before it and its edits; the last one's with what follows it."""

        def choose(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("place")
            repair, tail = Repair(), rows["tail"].iloc[0]
            steps = [repair.step(*kind) for kind in zip(rows["initial"].tolist(), rows["kind"].tolist())]
            first, last = int(rows["before"].iloc[0]), int(rows["after"].iloc[0])
            states, edits = repair.crossings(steps, first, last), repair.edits(steps, first, last)
            edits[-1] += tail
            return pd.DataFrame(
                {"key": rows["key"], "block": rows["block"], "place": rows["place"], "state": states[:-1], "edits": edits}
            )

        known = self.crossings.select("key", "block", "before", "after", "tail")
        return self._narrow().join(known, ["key", "block"]).groupBy("key", "block").applyInPandas(
            choose, "key string, block bigint, place bigint, state bigint, edits string"
        )

    def repaired(self) -> DataFrame:
        """Key, place (rows that are edited together share it), number within it, edit, role and text."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forms = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            for batch in batches:
                made = [
                    (row["key"], row["place"], number, *left)
                    for row in batch.to_pylist()
                    for number, left in enumerate(edited(row["state"], row["edits"], row["role"], row["text"])[1])
                ]
                columns = zip(*made) if made else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(column), form) for column, form in zip(columns, forms)],
                    names=["key", "place", "number", "edit", "role", "text"],
                )

        texts = self.rows.select("place", "role", "text").join(self.edits, "place")
        return texts.select("key", "place", "state", "edits", "role", "text").mapInArrow(
            run, "key string, place bigint, number bigint, edit string, role string, text string"
        )

    def reports(self) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, found, sign, done = None, None, "", []
            for batch in batches:
                for row in batch.to_pylist():
                    if row["key"] != key:
                        if found is not None:
                            done.append((key, found.hexdigest()))
                        key, found, sign = row["key"], hashlib.sha256(), ""
                    found.update(f"{sign}{row['role']}:{row['text']}".encode())
                    sign = "\n"
            if found is not None:
                done.append((key, found.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[place] for row in done], pa.string()) for place in (0, 1)], names=["key", "hash"]
            )

        order = ("key", "place", "number")
        hashes = self.repaired().repartition("key").sortWithinPartitions(*order).mapInArrow(run, "key string, hash string")
        parts = self.edits.groupBy("key", "block").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "edits"))), lambda e: e["edits"]), "").alias("part")
        )
        audits = parts.groupBy("key").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "part"))), lambda e: e["part"]), "").alias("audit")
        )
        count = lambda condition: F.count(F.when(condition, 1))
        counts = self.rows.groupBy("key").agg(
            F.first("conv_id").alias("conv_id"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
            count(F.col("fault") == UNWANTED).alias("blank"),
            count(F.col("repeated") & (F.col("fault") != UNWANTED)).alias("duplicate"),
            count(~F.col("repeated") & (F.col("fault") == TRUNCATED)).alias("truncated"),
        )
        totals = self.crossings.groupBy("key").agg(F.first("illegal").alias("illegal"), F.first("cost").alias("cost"))
        return (
            counts.join(totals, "key")
            .join(audits, "key")
            .join(hashes, "key", "left")
            .select(
                "conv_id",
                *_NUMBERS,
                "audit",
                F.coalesce("hash", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
            )
        )


def _split(rows: DataFrame, long: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the conversations that one task may hold, and of those with more than ``long`` rows, if there are any."""
    prepared = _prepared(rows)
    size = prepared.where("present").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long)
    many = settle(size.select("key", F.lit(True).alias("long")))
    if many.isEmpty():
        return prepared, None
    marked = dimension_join(prepared, many, "key", "left")
    return marked.where("long is null").drop("long"), marked.where("long and present").drop("long", "present")


def reports(rows: DataFrame, long: int = LONG, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, and ``present``, if there, false for rows that only name
    their conversation): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    short, many = _split(rows, long)
    found = _short_reports(short)
    return found if many is None else found.unionByName(_Long(many, block_bits).reports())


def repaired(rows: DataFrame, long: int = LONG, block_bits: int = BLOCK_BITS) -> DataFrame:
    """The repaired conversations: key (``=`` and conv_id, or empty), place, edit (K, R or I), role and text.

    Places ascend within a conversation, without being numbered through in long ones.
    """
    short, many = _split(rows, long)
    found = _short_rows(short)
    if many is None:
        return found
    made = _Long(many, block_bits).repaired()
    within = F.row_number().over(Window.partitionBy("key", "place").orderBy("number")) - 1
    # A row is edited with at most four others, inserted beside it
    placed = made.withColumn("place", F.col("place") * 8 + within).drop("number")
    return found.unionByName(placed)
