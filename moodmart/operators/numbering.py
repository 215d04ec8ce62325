"""Consecutive numbers for the sorted values of a small column."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodmart.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast
from moodmart.session import settle

_PART = "_part"


def number_sorted(
    rows: DataFrame,
    value: str,
    number: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Distinct values of a column, numbered from 1 in ascending order.

    Few values are numbered by one window. More are range-partitioned and numbered in parallel: a number is the count
    of values in the partitions before, plus the rank in its own. The partitions are stored first, because their
    bounds come from a sample and must be the same for the counts and for the ranks.
    """
    values = settle(rows.select(value).distinct())
    if fits_broadcast(values, max_rows, max_bytes):
        rank = F.row_number().over(Window.orderBy(value))
        return values.select(rank.cast("long").alias(number), value)

    ranged = settle(values.repartitionByRange(value).withColumn(_PART, F.spark_partition_id()))
    # one row per partition, so this window and this broadcast are bounded by the number of partitions
    before = (
        ranged.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(_PART, (F.sum("_rows").over(Window.orderBy(_PART)) - F.col("_rows")).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy(_PART).orderBy(value))
    return (
        ranged.withColumn("_rank", rank)
        .join(F.broadcast(before), _PART)
        .select((F.col("_before") + F.col("_rank")).cast("long").alias(number), value)
    )
