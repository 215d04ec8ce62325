"""Parquet tables: reading with a declared schema, replacing by commits, and counting what is written.

A table is a folder of Parquet files, partitioned or not, and a folder ``_commits`` of small manifests. A write adds
files whose names begin with the write's own mark, and then a manifest that names, for every partition, the marks whose
files make it up. The manifest is created under the next number, which fails if another writer was faster; it is the
only step by which a write becomes visible. Readers take the newest whole manifest, so

* a write that breaks off leaves files that no manifest names and no reader sees (``vacuum`` removes them),
* a table of which nothing is left has a manifest without partitions and is empty, which differs from one without a
  manifest,
* nothing is renamed, so object stores need not copy.

Files that a commit has replaced are deleted after it, so tools that read the folder itself find the same rows. A folder
without manifests is read as the Parquet files in it.
"""

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_COMMITS, _OLD = "_commits", ".old-"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentWrite(OSError):
    """Another write was committed first; what this one wrote is not part of the table."""


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and its path class: Spark has no writer of single files and none that deletes."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return where(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table with all its files; nothing happens if there is none."""
    files, where = _file_system(spark, path)
    files.delete(where(path), True)


@dataclass(frozen=True)
class Commit:
    """One state of a table: per partition (a folder such as ``day=2025-01-02``, or nothing) the marks of its files."""

    number: int = 0
    marks: dict[str, list[str]] = field(default_factory=dict)
    note: dict = field(default_factory=dict)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, where = _file_system(spark, path)
    folder = where(f"{path}/{_COMMITS}")
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _manifest(path: str, number: int) -> str:
    return f"{path}/{_COMMITS}/{number:012d}.json"


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    """The newest state of a table. A manifest that was not written to its end is none."""
    path = path.rstrip("/")
    files, where = _file_system(spark, path)
    for number in reversed(_numbers(spark, path)):
        stream = files.open(where(_manifest(path, number)))
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found = json.loads(text)
        except ValueError:
            continue
        return Commit(number, found["marks"], found["note"])
    return None


def _commit(spark: SparkSession, path: str, number: int, marks: dict[str, list[str]], note: dict) -> None:
    files, where = _file_system(spark, path)
    try:
        stream = files.create(where(_manifest(path, number)), False)
    except Py4JJavaError as error:
        raise ConcurrentWrite(f"{path} has been written by another since") from error
    try:
        stream.write(json.dumps({"marks": marks, "note": note}, sort_keys=True).encode())
    finally:
        stream.close()


def _files(spark: SparkSession, path: str, partition: str) -> list[str]:
    files, where = _file_system(spark, path)
    folder = where(f"{path}/{partition}".rstrip("/"))
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isFile()] if files.exists(folder) else []


def _delete(spark: SparkSession, path: str, partition: str, keep: Iterable[str]) -> None:
    """Delete the data files of a partition that do not begin with one of the marks."""
    files, where = _file_system(spark, path)
    kept = tuple(f"{mark}-" for mark in keep)
    for name in _files(spark, path, partition):
        if name.endswith(".parquet") and not name.startswith(kept):
            files.delete(where(f"{path}/{partition}/{name}" if partition else f"{path}/{name}"), False)


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete the files of writes that were broken off, in all partitions. No write may be under way."""
    path = path.rstrip("/")
    state = last_commit(spark, path)
    if state is None:
        return
    files, where = _file_system(spark, path)
    found, below = files.listFiles(where(path), True), where(path).toUri().getPath()
    folders = set()
    while found.hasNext():
        folders.add(found.next().getPath().getParent().toUri().getPath().removeprefix(below).strip("/"))
    for partition in folders - {_COMMITS}:
        _delete(spark, path, partition, state.marks.get(partition, []))


def _check_whole(spark: SparkSession, path: str) -> None:
    """A folder without manifests is a table if it holds something; one that an older release was replacing is not."""
    files, where = _file_system(spark, path)
    if files.exists(where(path)):
        if files.getFileStatus(where(path)).isDirectory() and not files.listStatus(where(path)):
            raise ValueError(f"{path} is an empty folder, so a write to it was broken off")
    elif files.globStatus(where(f"{path}{_OLD}*")):
        raise ValueError(f"{path} was being replaced; its old rows are beside it")


def _or_empty(spark: SparkSession, schema: StructType, read) -> DataFrame:
    """Only a path that is not there means an empty table; any other failure is raised, so it cannot erase history."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_table(
    spark: SparkSession, path: str, schema: StructType, partitions: Sequence[str] | None = None
) -> DataFrame:
    """A stored table, with its columns in the schema's order; empty if it was never written, or holds no rows.

    ``partitions`` are names of folders (``partition_name``); no others are listed then.
    """
    path = path.rstrip("/")
    state = last_commit(spark, path)
    if state is not None:
        wanted = {p: m for p, m in state.marks.items() if m and (partitions is None or p in partitions)}
        if not wanted:
            return spark.createDataFrame([], schema)
        found = [f"{path}/{p}/{mark}-*" if p else f"{path}/{mark}-*" for p, m in wanted.items() for mark in m]
        return spark.read.schema(schema).option("basePath", path).parquet(*found).select(*schema.fieldNames())
    _check_whole(spark, path)

    def read() -> DataFrame:
        found = [path] if partitions is None else [f"{path}/{partition}" for partition in partitions]
        return spark.read.schema(schema).option("basePath", path).parquet(*found).select(*schema.fieldNames())

    return _or_empty(spark, schema, read)


def partition_name(spark: SparkSession, **values: object) -> str:
    """The folder of a partition, as Spark names it."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{name}={_NULL_FOLDER if value in (None, '') else escape(str(value))}" for name, value in values.items())


def read_prefix(
    spark: SparkSession, root: str, prefix: str, schema: StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    """All Parquet files below ``root`` whose path starts with ``prefix``, as one table; empty if there are none.

    With ``partition_by`` these columns of the schema come from folders named ``column=value``, and filters on them are
    kept from listing other folders; the files then lie in such folders only. Otherwise folders of any names are read.
    """
    base = root.rstrip("/")

    def read() -> DataFrame:
        reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
        reader = reader.option("basePath", base) if partition_by else reader.option("recursiveFileLookup", "true")
        return reader.parquet(f"{base}/{prefix}*").select(*schema.fieldNames())

    return _or_empty(spark, schema, read)


def write_table(
    frame: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    only_touched_partitions: bool = False,
    emptied: Sequence[str] = (),
    append: bool = False,
    note: dict | None = None,
) -> int:
    """Replace a table and return the number of rows written, counted during the write.

    With ``only_touched_partitions`` the partitions that get no row are left as they are, but for the ``emptied`` ones,
    of which nothing stays. With ``append`` rows are added and none replaced, whatever there is; nothing is read then. A
    write that fails leaves the table as it was, and the frame may read the table itself. ``note`` is kept with the commit.
    """
    if only_touched_partitions and not partition_by:
        raise ValueError("only a partitioned table can be replaced in part")
    spark, path = frame.sparkSession, path.rstrip("/")
    number = 1 + max(_numbers(spark, path), default=0)
    before = last_commit(spark, path)
    if before is None and (only_touched_partitions or append):
        before = _adopted(spark, path)
    mark, rows, touched = _add_files(frame, path, partition_by)
    old = before.marks if before else {}
    marks = {partition: [mark] for partition in touched}
    if append:
        marks = old | {partition: [*old.get(partition, []), mark] for partition in touched}
    elif only_touched_partitions:
        marks = {p: m for p, m in old.items() if p not in emptied} | marks
    _commit(spark, path, number, marks, note or {})
    for partition in {*old, *touched, *emptied, *([""] if not partition_by else [])}:
        if marks.get(partition) != old.get(partition) or partition in touched:
            _delete(spark, path, partition, marks.get(partition, []))
    return rows


def _adopted(spark: SparkSession, path: str) -> Commit | None:
    """A partitioned folder without manifests, as if its files had been committed: every file's name is its mark."""
    files, where = _file_system(spark, path)
    if not files.exists(where(path)):
        return None
    found, below, marks = files.listFiles(where(path), True), where(path).toUri().getPath(), {}
    while found.hasNext():
        file = found.next().getPath()
        partition = file.getParent().toUri().getPath().removeprefix(below).strip("/")
        if file.getName().endswith(".parquet"):
            marks.setdefault(partition, []).append(file.getName().split("-")[0])
    return Commit(0, {partition: sorted(set(names)) for partition, names in marks.items()})


def _add_files(frame: DataFrame, path: str, partition_by: Sequence[str]) -> tuple[str, int, list[str]]:
    """Write the rows under a mark of their own; the mark, the number of rows and the partitions that got some."""
    spark, mark, counted = frame.sparkSession, f"w{uuid4().hex}", Observation()
    seen = [F.count(F.lit(1)).alias("num_records")]
    if partition_by:
        # Partitions are days, months or runs, gathered while they are written
        values = F.struct(*[F.col(name).cast("string").alias(name) for name in partition_by])
        seen.append(F.to_json(F.collect_set(values)).alias("partitions"))
    rows = frame.observe(counted, *seen)
    writer = rows.write.mode("append").option("mapreduce.output.basename", mark)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    found = counted.get
    if not partition_by:
        return mark, found["num_records"], [""] if found["num_records"] else []
    listed = json.loads(found["partitions"])
    names = [partition_name(spark, **{name: part.get(name) for name in partition_by}) for part in listed]
    return mark, found["num_records"], names


def record_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The counts that :func:`write_table` returned, as a table; one row per table of a warehouse."""
    return spark.createDataFrame(sorted(counts.items()), "table_name string, num_records long")
