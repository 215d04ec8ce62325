"""What every run wrote: a table with a partition per run, so that a run that is recorded again replaces its own rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodmart.sources.tables import partition_name, read_table, write_table

RUNS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("num_records", T.LongType()),
        T.StructField("run_time", T.TimestampNTZType()),
        T.StructField("recorded", T.TimestampType()),
        T.StructField("run", T.LongType()),
    ]
)


def record_run(spark: SparkSession, path: str, run: int, run_time: Column, counts: dict[str, int]) -> None:
    """Record the rows that run ``run`` wrote to each table. Other runs' partitions are neither read nor written."""
    rows = spark.createDataFrame(sorted(counts.items()), "table_name string, num_records long").select(
        "table_name",
        "num_records",
        run_time.cast("timestamp_ntz").alias("run_time"),
        F.current_timestamp().alias("recorded"),
        F.lit(run).cast("long").alias("run"),
    )
    emptied = [] if counts else [partition_name(spark, run=run)]
    write_table(rows, path, partition_by=["run"], only_touched_partitions=True, emptied=emptied)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RUNS)
