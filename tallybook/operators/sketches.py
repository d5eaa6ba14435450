"""Approximate profiles from KLL sketches that are stored and merged instead of rescanning.

Every snapshot folder of a portfolio gets one small table of sketches, a row per scenario, population and variable. Folders never
change, so neither do their sketches. A profile merges the sketches of the folders that the newest commit names; a slice that a batch
or a stream appends costs a scan of that slice alone, and a rebuilt scenario leaves the others' sketches as they are.

The rank of an approximate quantile is off by more than ``rank_error(k)`` of the rows hardly ever; counts, limits and means are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.numeric import text
from tallybook.operators.quantiles import without_nan
from tallybook.operators.reports import PROFILE_SCALES
from tallybook.sources.snapshots import PARTITIONS, read_folders, state

SKETCHES = "_sketches"
K = 4096
PROBS = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def rank_error(k: int = K) -> float:
    """Share of the rows by which the rank of a quantile may be off, at 99% confidence."""
    return 2.296 / k**0.9723


def sketch(df: DataFrame, columns: Iterable[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row per group and variable: n, low, high, total and the sketch, in one scan. NaN counts as missing."""
    columns = list(columns)
    df = without_nan(df, columns)
    sums, rows = [], []
    for i, c in enumerate(columns):
        x = f"CAST({c} AS DOUBLE)"
        sums += [
            f"count({c}) AS _n{i}",
            f"CAST(min({c}) AS DOUBLE) AS _low{i}",
            f"CAST(max({c}) AS DOUBLE) AS _high{i}",
            f"CAST(sum({c}) AS DOUBLE) AS _sum{i}",
            f"kll_sketch_agg_double({x}, {k}) AS _kll{i}",
        ]
        rows.append(
            f"struct({text(c)} AS variable_name, _n{i} AS n, _low{i} AS low, _high{i} AS high, _sum{i} AS total, _kll{i} AS kll)"
        )
    grouped = df.groupBy(*by).agg(*[F.expr(s) for s in sums])
    return grouped.selectExpr(*by, f"inline(array({', '.join(rows)}))").where("n > 0")


def merged(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row per group and variable from any number of sketch rows."""
    whole = sketches.groupBy(*by, "variable_name").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("min_val"),
        F.max("high").alias("max_val"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.expr(f"kll_merge_agg_double(kll, {k})").alias("kll"),
    )
    quantiles = [f"kll_sketch_get_quantile_double(kll, {p}D) AS {name}" for name, p in PROBS.items()]
    return whole.selectExpr(*by, "variable_name", "n", "min_val", *quantiles, "mean", "max_val", f"{rank_error(k)!r}D AS rank_error")


def _folder(path: str, snapshot: str) -> str:
    return f"{path.rstrip('/')}/{SKETCHES}/snapshot={snapshot}"


def update_sketches(spark: SparkSession, path: str, columns: Iterable[str] = tuple(PROFILE_SCALES), k: int = K) -> list[str]:
    """Sketch the live snapshot folders that have no sketches yet; returns their ids.

    A folder is read whole and once. Its sketches count when Spark has marked them as complete, so a crash
    leaves a folder that is simply sketched again.
    """
    parts: dict[str, list[str]] = {}
    for f in state(spark, path)["folders"]:
        parts.setdefault(f["snapshot"], []).append(f["partition"])
    done = []
    for snapshot, partitions in sorted(parts.items()):
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(path, snapshot)}/_SUCCESS")
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            continue
        rows = read_folders(spark, path, [(snapshot, p) for p in partitions])
        sketch(rows, columns, PARTITIONS, k).coalesce(1).write.mode("overwrite").parquet(_folder(path, snapshot))
        done.append(snapshot)
    return done


def portfolio_profile(spark: SparkSession, path: str, by: Sequence[str] = PARTITIONS, k: int = K) -> DataFrame:
    """The profile of the newest commit from stored sketches; what has none yet is sketched first."""
    update_sketches(spark, path, k=k)
    live = []
    for f in state(spark, path)["folders"]:
        names = [unquote(part.split("=", 1)[1]) for part in f["partition"].split("/")]
        live.append((f["snapshot"], *names))
    if not live:
        raise ValueError(f"{path} holds no portfolio")
    tables = spark.read.option("basePath", f"{path.rstrip('/')}/{SKETCHES}").schema(
        "scenario_name string, population_id string, variable_name string, n long, low double, high double, total double,"
        " kll binary, snapshot string"
    )
    rows = tables.parquet(*sorted({_folder(path, s) for s, *_ in live}))
    wanted = spark.createDataFrame(live, "snapshot string, scenario_name string, population_id string").distinct()
    return merged(rows.join(wanted, ["snapshot", *PARTITIONS], "left_semi"), by, k)
