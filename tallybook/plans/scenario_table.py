"""Many scenarios at once: keys joined with a parameter table, parameters as columns.

A list of scenarios becomes literals, which is fastest for a few. A parameter table stays a table: the plan has the
same size for one row and for a hundred thousand, and the keys are scanned once. Rows multiply in three levels,
as late as they can: draws once for each population, borrower columns once for each distinct set of borrower parameters, and only
structure and risk once for each scenario. Each level's table is counted first. Up to ``BROADCAST_ROWS`` rows it is sent to
all tasks, so that nothing of the population is shuffled; a larger one is joined as Spark sees fit.

Draws and borrowers are staged in the shared folder before the next level joins them. They are small beside what the
scenarios make of them, and a lost executor then costs no draws.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.calibration import DEFAULT, Calibration
from tallybook.functions.draws import with_draws
from tallybook.operators.borrower import with_borrower
from tallybook.operators.risk import with_risk
from tallybook.operators.structure import with_structure
from tallybook.params import BORROWER_FIELDS, FIELD_NAMES, SCENARIO_SCHEMA
from tallybook.sources.keys import with_ids
from tallybook.sources.store import stage

#: A scenario has 45 fields, under 1 KB; so a broadcast is 200 MB at most.
BROADCAST_ROWS = 200_000

CONSTRAINTS = "spark.sql.constraintPropagation.enabled"
LATE_FIELDS = tuple(n for n in FIELD_NAMES if n not in BORROWER_FIELDS)


def column(name: str) -> str:
    """The parameter as a column of the joined table. The names are apart from those of the application."""
    return f"_p_{name}"


def sized(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint, if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table, written once. While it is planned, the optimizer derives no constraints: it would compare
    those of every column, which are expressions of parameter columns, for minutes, and find no filter."""
    conf = df.sparkSession.conf
    before = conf.get(CONSTRAINTS)
    conf.set(CONSTRAINTS, "false")
    try:
        return stage(df, name)
    finally:
        conf.set(CONSTRAINTS, before)


def checked(scenarios: DataFrame) -> DataFrame:
    """The parameter columns in their declared types; names must be present and distinct."""
    typed = scenarios.selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {column(f.name)}" for f in SCENARIO_SCHEMA]
    )
    names = [column("scenario_name"), column("population_id")]
    missing = " OR ".join(f"{n} IS NULL" for n in names)
    problem = typed.groupBy(*names).agg(F.count("*").alias("n")).where(f"n > 1 OR {missing}")
    if problem.head(1) or not typed.head(1):
        raise ValueError("scenarios need distinct scenario_name and population_id pairs")
    return typed


def score_table(
    keys: DataFrame, scenarios: DataFrame, cal: Calibration = DEFAULT, pad: int = 8, audit: bool = True
) -> DataFrame:
    """Score every key under every row of a parameter table."""
    from tallybook.plans.portfolio import fenced, finalize

    typed = checked(scenarios)
    early = [column(n) for n in BORROWER_FIELDS]
    late = [column(n) for n in LATE_FIELDS]
    # equal parameters have equal digests; NULLs are told apart from empty text by the struct
    code = F.md5(F.to_json(F.struct(*early), {"ignoreNullFields": "false"}))
    typed = typed.withColumn("_borrower", code)
    populations = typed.select(F.col(column("population_id")).alias("population_id")).distinct()
    borrowers = typed.select("_borrower", *early).distinct()

    df = with_ids(keys, pad=pad).join(sized(populations))
    df = staged(with_draws(df, "application_id", "population_id"), "draws")
    same = F.col("population_id") == F.col(column("population_id"))
    df = df.join(sized(borrowers), same).drop(column("population_id"))
    df = staged(with_borrower(df, column, cal).drop(*early), "borrowers")
    df = df.join(sized(typed.select("_borrower", *late)), "_borrower").drop("_borrower")
    df = df.withColumns({n: F.col(column(n)) for n in ("scenario_name", "anchor_date")})
    return finalize(with_risk(fenced(with_structure(df, column, cal)), column, cal), audit)
