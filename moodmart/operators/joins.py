"""Joins with dimensions: broadcast behind a measured size, salted beyond it."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodmart.session import settle

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is split over several tasks
ROWS_PER_TASK = 500_000
# At most so many keys can hold a part in so many of all rows; these are known to every task
_HOT_PARTS = 100_000

_SALT, _TASKS, _ROWS = "_salt", "_tasks", "_rows"


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def measure(frame: DataFrame) -> Size:
    """Rows and approximate bytes of a frame, in one distributed aggregation that returns one row."""
    varying = (T.StringType, T.BinaryType)
    fixed = sum(8 for f in frame.schema if not isinstance(f.dataType, varying)) + 16
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 for f in frame.schema if isinstance(f.dataType, varying)]
    width = sum(texts, F.lit(fixed)).cast("long")
    row = frame.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return Size(row["rows"], row["bytes"])


def fits_broadcast(frame: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measure(frame).fits(max_rows, max_bytes)


def _hot_keys(rows: DataFrame, on: str, rows_per_task: int) -> tuple[DataFrame, int]:
    """Keys with more rows than one task is to have, with the number of tasks each needs, and the tasks for no key.

    Counts are combined before the shuffle, so finding a hot key does not suffer from it. A key is hot from
    ``rows_per_task`` rows on, or from a part in ``_HOT_PARTS`` of all rows if that is more. So there are at most
    ``_HOT_PARTS`` hot keys, whatever the table's size, and no other key has more than that part of the rows: where it
    is more than ``rows_per_task``, the table has so many rows that its tasks are larger anyway.
    """
    counts = settle(rows.groupBy(on).agg(F.count(F.lit(1)).alias(_ROWS)).where(F.col(_ROWS) > rows_per_task))
    missing = counts.where(F.col(on).isNull()).agg(F.coalesce(F.sum(_ROWS), F.lit(0))).first()[0]
    # Keys below rows_per_task are not in these counts, so the total is a lower bound, and so is the part
    total = counts.agg(F.coalesce(F.sum(_ROWS), F.lit(0))).first()[0]
    least = max(rows_per_task, total // _HOT_PARTS)
    hot = counts.where(F.col(on).isNotNull() & (F.col(_ROWS) > least))
    tasks = F.ceil(F.col(_ROWS) / rows_per_task).cast("int")
    return hot.select(on, tasks.alias(_TASKS)), max(1, -(-missing // rows_per_task))


def salted_join(
    big: DataFrame, small: DataFrame, on: str, how: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Equi-join of two shuffled sides, of which the big one may hold one key in a large share of its rows, or none.

    Hot keys of the big side are counted first. Their rows go to as many tasks as their number asks for, and only their
    rows of the small side are copied, once per task; all other keys are joined as usual. The task is picked by a hash
    of the whole row, so a task that is run again makes the same choice. Rows equal in every column stay together;
    adaptive execution splits a partition that is still too large. ``how`` is inner, left or left_anti: the joins in
    which a row of the big side is matched on its own.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    keys, for_none = _hot_keys(big, on, rows_per_task)
    hot = F.broadcast(keys)
    # Rows without a key match nothing, so spreading them copies nothing
    tasks = F.coalesce(_TASKS, F.when(F.col(on).isNull(), for_none), F.lit(1))
    spread = big.join(hot, on, "left").select(
        *big.columns, F.pmod(F.xxhash64(*[F.col(name) for name in big.columns]), tasks).cast("int").alias(_SALT)
    )
    copies = small.join(hot, on, "left").select(
        *small.columns, F.explode(F.sequence(F.lit(0), F.coalesce(_TASKS, F.lit(1)) - 1)).alias(_SALT)
    )
    return spread.join(copies, [on, _SALT], how).drop(_SALT)


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join facts with a dimension without moving the facts, as long as the dimension is measured to be small.

    The measuring reads the dimension once; pass a stored one rather than one that has to be derived first.
    """
    if fits_broadcast(dimension, max_rows, max_bytes):
        return facts.join(F.broadcast(dimension), on, how)
    return salted_join(facts, dimension, on, how, rows_per_task)
