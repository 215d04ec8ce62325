"""Which rows of a keyed table differ between two states."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED, REPLACED, REMOVED = "inserted", "replaced", "removed"


def change_feed(before: DataFrame, after: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Every key that was inserted, replaced or removed: ``key``, ``change``, and the rows ``old`` and ``new``.

    Keys are unique on both sides. Rows are compared in all columns but the ignored ones, null being equal to null; keys
    whose row stayed the same are left out. A null key names no row and is left out too.
    """
    columns = [name for name in after.columns if name not in ignore]

    def side(frame: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[F.col(column) for column in after.columns])
        return frame.where(F.col(key).isNotNull()).select(F.col(key), row.alias(name))

    both = side(before, "old").join(side(after, "new"), key, "full")
    same = F.lit(True)
    for name in columns:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    change = F.when(F.col("old").isNull(), INSERTED).when(F.col("new").isNull(), REMOVED).otherwise(REPLACED)
    changed = both.where(F.col("old").isNull() | F.col("new").isNull() | ~same)
    return changed.select(key, change.alias("change"), "old", "new")


def old_rows(feed: DataFrame) -> DataFrame:
    """The rows that are no longer there."""
    return feed.where(F.col("old").isNotNull()).select("old.*")


def new_rows(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("new").isNotNull()).select("new.*")
