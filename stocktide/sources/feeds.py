"""Scans of the delivered layout, and the table sink.

``<root>/raw/<feed>/<partition>=<value>/*.parquet``, ``<root>/reference/<name>.csv`` and
``<root>/_manifest/expected_partitions.csv``. Every scan has a declared schema: nothing is inferred, renamed
columns of a drifting feed stand side by side, and an unreadable file is never opened to find one out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.functions.cleaning import nan_to_null
from stocktide.session import releasing
from stocktide.sources import schemas


COMPRESSION = "zstd"  # of stored tables: a quarter smaller than the default
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def scan_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    *,
    skip_files: Sequence[str] = (),
    source_file: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Partitioned Parquet feed with its declared schema.

    ``skip_files`` names files, by the end of their path, that are known to be unreadable; their siblings stay.
    ``source_file`` adds the path of the file each row came from.
    """
    df = spark.read.schema(schema or schemas.FEEDS[feed]).parquet(f"{root}/raw/{feed}")
    for suffix in skip_files:
        df = df.where(~F.endswith(F.col("_metadata.file_path"), F.lit(suffix)))
    columns = [F.col(c) for c in df.columns]
    if source_file:
        columns.append(F.col("_metadata.file_path").alias(source_file))
    df = df.select(*columns)
    return df.withColumn("temp_value", nan_to_null("temp_value")) if "temp_value" in df.columns else df


def rowless_files(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Files of a feed that give no row, ``file`` (the end of its path) and ``length``: those whose footer can't be read.

    A job over file names: footers alone are opened, no column and no content is read. A sound file without rows is named
    too; nothing is lost by skipping it. Damage behind a sound footer is not found. ``scan_feed`` takes the names as
    ``skip_files``.
    """
    where = f"{root}/raw/{feed}"
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/raw/{re.escape(feed)}/(.*)$", 1).alias("file")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(where)
    sound = spark.read.schema("_none int").option("ignoreCorruptFiles", True).parquet(where).select(name).distinct()
    return files.select(name, "length").join(sound, "file", "left_anti")


def scan_reference(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _csv(spark, f"{root}/reference/{name}.csv", schemas.REFERENCE_FILES[name])


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    return _csv(spark, f"{root}/_manifest/expected_partitions.csv", schemas.MANIFEST_SCHEMA)


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def missing_inputs(spark: SparkSession, root: str) -> list[str]:
    """Expected feed and reference paths that are not there; asks the file system for names only."""
    wanted = [f"{root}/raw/{feed}" for feed in schemas.FEEDS]
    wanted += [f"{root}/reference/{name}.csv" for name in schemas.REFERENCE_FILES]
    wanted.append(f"{root}/_manifest/expected_partitions.csv")
    return [path for path in wanted if not path_exists(spark, path)]


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_feed(df: DataFrame, root: str, feed: str, partition: str) -> None:
    """Store a feed in the delivered layout. Rebalancing cuts a large day into several files and keeps a small
    one in a single file."""
    spread = df.hint("rebalance", F.col(partition))
    spread.write.mode("overwrite").partitionBy(partition).parquet(f"{root}/raw/{feed}")


def write_table(df: DataFrame, path: str, cluster_by: Iterable[str] = ()) -> DataFrame:
    """Full overwrite of one table, read back from storage.

    With ``cluster_by`` rows of like values share files and are sorted in them, so range filters skip row groups;
    AQE splits values that fill more than one file. Rows are stored once before they are dealt, so that disk does not hold
    the shuffled rows of both.
    """
    columns = [F.col(c) for c in cluster_by]
    if columns:
        undealt, schema = f"{path}_undealt", df.schema
        write_table(write_table(df, undealt).hint("rebalance", *columns).sortWithinPartitions(*columns), path)
        drop_table(df.sparkSession, undealt)
        return df.sparkSession.read.schema(schema).parquet(path)
    with releasing(df.sparkSession):
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that ``df`` has rows for; all others stay as they are, files and all.

    ``df`` may read the partitions it replaces: old files go when the last task has ended.
    """
    replace_partitions(df.hint("rebalance", F.col(partition)), path, partition)


def replace_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """The same, with the rows of a partition in as many files as there are tasks that hold some."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    with releasing(df.sparkSession):
        writer.partitionBy(*partitions).parquet(path)


def append_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Add rows to partitions, new ones among them; no stored file is read or replaced."""
    with releasing(df.sparkSession):
        df.hint("rebalance", F.col(partition)).write.mode("append").option("compression", COMPRESSION).partitionBy(partition).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table that a step stored for itself."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Iterable[object]) -> None:
    """Remove whole partitions of a stored table."""
    for value in values:
        drop_table(spark, f"{path}/{partition}={NULL_PARTITION if value is None else value}")
