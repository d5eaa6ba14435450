"""Portfolio tables, staged tables and report files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallybook.schema import APPLICATION_SCHEMA
from tallybook.sources.snapshots import PARTITIONS, ROWS_PER_FILE, is_snapshot_folder, read_snapshot


def create_database(spark: SparkSession, name: str) -> None:
    """Namespace for portfolio tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Does the folder hold the log of a stream? Readers of such a folder see its files only."""
    log, fs = _folder(spark, f"{path.rstrip('/')}/_spark_metadata")
    return fs.exists(log)


def has_partitions(spark: SparkSession, path: str) -> bool:
    """Does the folder hold partitions that ``write_portfolio`` has written?"""
    where, fs = _folder(spark, path)
    return fs.exists(where) and any("=" in f.getPath().getName() for f in fs.listStatus(where))


def write_portfolio(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write a portfolio, replacing only the scenarios and populations in ``df``.

    Rerunning a scenario therefore rebuilds it and leaves the others alone. Rows are
    rebalanced by partition first, so that the number of files follows from the data
    and not from tasks times scenarios. The old rows go before the new ones come, so use this for
    tables that can be made again; ``build_portfolio`` changes a portfolio in one step. A folder of
    snapshots, or of a file stream, is refused.
    """
    if is_snapshot_folder(df.sparkSession, path) or written_by_stream(df.sparkSession, path):
        raise ValueError(f"{path} is written in snapshots or by a stream; its readers would not see these rows")
    (
        df.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_portfolio(spark: SparkSession, path: str) -> DataFrame:
    """Read a portfolio in schema order; filters on scenario and population prune files.

    Of a folder of snapshots this is what the newest commit names.
    """
    if is_snapshot_folder(spark, path):
        return read_snapshot(spark, path)
    df = spark.read.schema(APPLICATION_SCHEMA).parquet(path)
    return df.select(*APPLICATION_SCHEMA.names)


def save_portfolio_table(df: DataFrame, table: str, buckets: int) -> None:
    """Save as a catalog table bucketed by application, so scenarios join in place."""
    (
        df.write.mode("overwrite")
        .format("parquet")
        .partitionBy("scenario_name")
        .bucketBy(buckets, "population_id", "application_seq")
        .sortBy("population_id", "application_seq")
        .saveAsTable(table)
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    path = tempfile.mkdtemp(prefix="tallybook-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use it for a table that several reports scan. The files outlive any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tallybook-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the folder of a staged table that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        where, fs = _folder(df.sparkSession, file)
        parent = where.getParent().getParent()  # tallybook-<id>/<name>/<file>
        if parent.getName().startswith("tallybook-"):
            fs.delete(parent, True)


def write_report(df: DataFrame, path: str) -> None:
    """Write a report as CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read report CSV files; an empty field is NULL."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS Z")
        .csv(path)
    )
