"""Incremental refresh of the article table: each run takes the page files that have landed since the last one.

The batch refresh extracts every landed page again. Here the stream's checkpoint remembers which files were taken, so
a run costs what its new pages cost. Articles are merged by key, in an order that stored articles carry with them, and
rejected pages are replaced page by page. So neither the number of files per batch nor their order changes the result,
and taking a page twice changes nothing: a file that is written again by a second landing on its day, or a batch
repeated after a failure, does no harm.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from moodmart.plans.refresh import LANDED, Warehouse, refresh_articles


def refresh_new_articles(
    spark: SparkSession, warehouse: Warehouse, progress_path: str, files_per_batch: int = 1000, **options
) -> StreamingQuery:
    """Start a run that takes all pages landed so far and then ends; ``progress_path`` keeps what was taken."""
    landed = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).parquet(warehouse.pages)

    def merge(batch: DataFrame, _: int) -> None:
        refresh_articles(batch.sparkSession, warehouse, batch, **options)

    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
