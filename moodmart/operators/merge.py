"""Latest row per key, keyed upsert, and unions that check their columns."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmart.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, ROWS_PER_TASK, fits_broadcast, salted_join
from moodmart.schemas import same_columns
from moodmart.session import settle

_RANK = "_rank"


def dedup_latest(rows: DataFrame, key: str | Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, which should be total to make the choice repeatable.

    Null keys form one group. Catalyst turns "rank = 1" into a limit per key on both sides of the shuffle, so a key
    with a third of all rows sends one row per input task, not all of them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return rows.withColumn(_RANK, F.row_number().over(first)).where(F.col(_RANK) == 1).drop(_RANK)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept. Frames must agree in column names and types, not in order."""
    for other in frames[1:]:
        if not same_columns(frames[0], other):
            raise ValueError(f"columns differ: {frames[0].dtypes} and {other.dtypes}")
    return reduce(DataFrame.unionByName, frames)


def unmatched(
    history: DataFrame,
    batch: DataFrame,
    key: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows of ``history`` whose key is not in ``batch``; a null key matches nothing, so those rows stay.

    The batch's keys are stored once, then measured. Usually they are few: they are broadcast and history is only
    streamed through. If they are not, both sides are shuffled, with null keys and keys of very many rows spread.
    """
    return split_by_keys(history, batch, key, max_rows, max_bytes, rows_per_task).unmatched


@dataclass(frozen=True)
class Split:
    matched: DataFrame
    unmatched: DataFrame


def split_by_keys(
    history: DataFrame,
    batch: DataFrame,
    key: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> Split:
    """The rows of ``history`` whose key is in ``batch``, and the others; see :func:`unmatched`."""
    keys = settle(batch.select(key).where(F.col(key).isNotNull()).distinct())
    if fits_broadcast(keys, max_rows, max_bytes):
        few = F.broadcast(keys)
        return Split(history.join(few, key, "left_semi"), history.join(few, key, "left_anti"))
    return Split(
        salted_join(history, keys, key, "inner", rows_per_task).select(*history.columns),
        salted_join(history, keys, key, "left_anti", rows_per_task).select(*history.columns),
    )


def upsert(
    history: DataFrame, batch: DataFrame, key: str, batch_keys: DataFrame | None = None, **limits: int
) -> DataFrame:
    """The batch, and the history rows it does not replace. Duplicates within either side stay.

    ``batch_keys`` is any frame with the batch's keys, for a batch whose keys are cheaper to get than its rows.
    """
    keys = batch if batch_keys is None else batch_keys
    return union_all(batch, unmatched(history.select(*batch.columns), keys, key, **limits))
