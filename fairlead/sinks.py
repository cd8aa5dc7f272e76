"""Table writers: zstd Parquet, partition refresh, CSV export."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.config import scratch_dir, scratch_root
from fairlead.sources.files import CSV_FORMAT, SOURCE
from fairlead.sources.landing import list_files


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Replace a Parquet table; ``mode="ignore"`` leaves an existing one untouched.

    Overwriting in place would delete the stored table before the job runs. The rows are
    written beside it instead, in a folder whose leading underscore hides it from readers,
    and take its place when the whole job has succeeded; a failed one leaves it as it was.
    """
    if mode != "overwrite":
        _writer(df, partition_by).mode(mode).parquet(path)
        return
    publish(df.sparkSession, write_unpublished(df, path, partition_by), path)


def write_new(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a table to a folder of its own, which a snapshot may name later; nothing is left if that fails."""
    try:
        _writer(df, partition_by).parquet(path)
    except Exception:
        discard(df.sparkSession, path)
        raise
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a scratch table every executor can reach.

    Cuts the lineage: a lost executor costs the tasks that read the table, not those that made it.
    """
    path = scratch_dir(df.sparkSession, label)
    _writer(df, ()).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Drop all scratch tables of this application, once every result that reads them has been written."""
    discard(spark, scratch_root(spark))


def write_unpublished(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write what is to become the table at ``path``; returns where it waits for ``publish``."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_new-{uuid.uuid4().hex}-{name}"
    try:
        _writer(df, partition_by).parquet(staged)
    except Exception:
        discard(df.sparkSession, staged)
        raise
    return staged


def discard(spark: SparkSession, staged: str) -> None:
    """Drop a folder nobody reads, such as what ``write_unpublished`` wrote; none is fine."""
    _files(spark, staged, lambda fs, at: fs.delete(at, True))


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Rename ``staged`` to ``path``; what was there goes once that is done.

    Between the two renames the old table lies beside the new one, under a name that starts
    with ``_old-``; if the second fails it goes back.
    """
    parent, name = path.rstrip("/").rsplit("/", 1)
    old = f"{parent}/_old-{uuid.uuid4().hex}-{name}"

    def rename(source: str, target: str) -> None:
        to = spark._jvm.org.apache.hadoop.fs.Path(target)
        if not _files(spark, source, lambda fs, at: fs.rename(at, to)):
            raise OSError(f"cannot rename {source} to {target}")

    held = _files(spark, path, lambda fs, at: fs.exists(at))
    if held:
        rename(path, old)
    try:
        rename(staged, path)
    except Exception:
        if held:
            rename(old, path)
        raise
    if held:
        _files(spark, old, lambda fs, at: fs.delete(at, True))
    spark.catalog.refreshByPath(path)


def _files(spark: SparkSession, path: str, action: Callable):
    """``action`` on the file system of ``path``, whichever Spark resolves it to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return action(at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at)


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; the others stay as they are."""
    _writer(df, partition_by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def add_new_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Write only partitions the table does not hold yet."""
    held = stored_partitions(df.sparkSession, path, partition)
    new = df.where(~F.col(partition).isin(held)) if held else df
    _writer(new, [partition]).mode("append").parquet(path)


def stored_partitions(spark: SparkSession, path: str, partition: str) -> list[str]:
    """Partition values of a table from its file listing; empty for no table."""
    files = list_files(spark, path, "*.parquet")
    if files is None:
        return []
    value = F.regexp_extract("path", f"/{partition}=([^/]+)/", 1)
    return [row[0] for row in files.select(value).distinct().collect()]


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Cluster rows that mix partitions before a partitioned write.

    Adaptive execution splits large partitions and merges small ones, so a partition
    holding a third of the rows is still written by many tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def export_csv(df: DataFrame, path: str) -> None:
    """Result download: plain UTF-8 CSV with header."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def land_csv(df: DataFrame, path: str) -> None:
    """Publish rows in the format of the source files, one folder per ``SOURCE`` file."""
    named = df.withColumn(SOURCE, F.concat(SOURCE, F.lit(".csv")))
    (
        rebalanced(named, SOURCE)
        .write.mode("overwrite")
        .partitionBy(SOURCE)
        .options(**CSV_FORMAT, quoteAll="true")
        .csv(path)
    )


def land_csv_file(df: DataFrame, path: str, label: str) -> None:
    """Publish the rows of one ``SOURCE`` file anew; the others below ``path`` stay."""
    df.drop(SOURCE).write.mode("overwrite").options(**CSV_FORMAT, quoteAll="true").csv(f"{path}/{SOURCE}={label}.csv")


def _writer(df: DataFrame, partition_by: Sequence[str]):
    writer = df.write.option("compression", "zstd")
    return writer.partitionBy(*partition_by) if partition_by else writer
