"""Keyed tables: where an application population starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.draws import add
from tallybook.functions.numeric import Sql, text


#: Keys that one task scores at most, and from which on it is worth a task of its own.
MOST_KEYS, LEAST_KEYS = 100_000, 25_000


def tasks_for(spark: SparkSession, keys: int) -> int:
    """Tasks that so many keys are dealt to: a task's work is bounded, and their number grows with the keys.

    More tasks than the session runs at once come in full rounds.
    """
    at_once = spark.sparkContext.defaultParallelism
    if keys > at_once * MOST_KEYS:
        return at_once * -(-keys // (at_once * MOST_KEYS))
    return max(1, min(at_once, -(-keys // LEAST_KEYS)))


def key_table(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Keys 1..n as ``application_seq``."""
    return spark.range(1, n + 1, 1, partitions).withColumnRenamed("id", "application_seq")


def keyed(df: DataFrame, key_col: str, partitions: int | None = None) -> DataFrame:
    """Use a column of an existing table as the application key.

    Scoring adds about 40 columns to each key. Give ``partitions`` for a table that is read in
    fewer tasks than the cluster can run: its keys are then spread while a row is a bare
    8-byte key. Without it the table keeps the partitions of its scan, and no job runs here.
    """
    keys = df.select(F.col(key_col).cast("bigint").alias("application_seq"))
    return keys.repartition(partitions) if partitions else keys


def padded_id(prefix: str, key: Sql, pad: int = 8) -> Sql:
    """``prefix`` and the key, zero-padded to ``pad`` digits. Longer keys keep all digits.

    The sign of a negative key comes before the zeros.
    """
    digits = f"CAST(abs({key}) AS STRING)"
    sign = f"if({key} < 0, '-', '')"
    return (
        f"concat({text(prefix)}, {sign}, if(length({digits}) < {pad}, lpad({digits}, {pad}, '0'), {digits}))"
    )


def with_ids(df: DataFrame, key: Sql = "application_seq", pad: int = 8) -> DataFrame:
    """Add ``application_id`` and ``applicant_id``."""
    return add(
        df,
        application_id=padded_id("APP-", key, pad),
        applicant_id=padded_id("CUST-", key, pad),
    )
