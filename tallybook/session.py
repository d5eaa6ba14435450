"""Session settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # A scored row fills more bytecode than the JVM will compile as one method. With
    # this limit Spark generates one method group per projection instead, which the
    # JVM does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
