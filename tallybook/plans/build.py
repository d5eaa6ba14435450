"""The batch job: check parameters, score, store, check the result."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.calibration import DEFAULT, Calibration
from tallybook.operators.validate import assert_valid, domain_check, key_checks, row_count_check
from tallybook.params import Scenario, scenarios_df
from tallybook.plans.portfolio import score_scenarios
from tallybook.session import configure
from tallybook.sources.keys import tasks_for
from tallybook.sources.snapshots import is_snapshot_folder, read_folders, replace_batch, write_folder
from tallybook.sources.store import has_partitions, read_portfolio, written_by_stream


def build_portfolio(
    keys: DataFrame,
    scenarios: Sequence[Scenario],
    path: str,
    cal: Calibration = DEFAULT,
    strict: bool = True,
) -> DataFrame:
    """Build the scenarios' portfolios at ``path`` and return their stored rows.

    Stops before any work if a parameter breaks a rule, if a key is missing, repeated or
    does not fit its id, or if the number of keys is not a scenario's ``application_count``.
    Rows are written as a snapshot that no commit names, and checked there; only then does one commit
    put them in the place of the scenarios' old rows, so a rebuild that fails or crashes at any step leaves
    those as they were. Other scenarios at ``path`` stay as they are, and so do rows that a stream has added.
    """
    spark = configure(keys.sparkSession)
    if not is_snapshot_folder(spark, path) and (written_by_stream(spark, path) or has_partitions(spark, path)):
        raise ValueError(f"{path} holds a portfolio that is not written in snapshots")
    assert_valid(scenarios_df(spark, scenarios), strict)
    require(key_checks(keys))
    count = keys.count()
    for s in scenarios:
        if s.application_count != count:
            raise ValueError(f"{s.scenario_name}: application_count {s.application_count}, {count} keys")

    dealt = keys.repartition(tasks_for(spark, count))  # bare keys move, not the rows that scoring makes of them
    name, partitions = write_folder(score_scenarios(dealt, scenarios, cal), path, dealt=True)
    rows = read_folders(spark, path, [(name, p) for p in partitions])
    require(row_count_check(rows, count * len(scenarios)).unionByName(domain_check(rows)))
    replace_batch(spark, path, name, partitions)

    wanted = [
        (F.col("scenario_name") == s.scenario_name) & (F.col("population_id") == s.population_id)
        for s in scenarios
    ]
    return read_portfolio(spark, path).where(reduce(or_, wanted))


def require(checks: DataFrame) -> None:
    """Raise ``ValueError`` with the checks that fail; there are a handful at most."""
    problems = [f"{r.rule} ({r.observed})" for r in checks.where("NOT ok").collect()]
    if problems:
        raise ValueError("; ".join(problems))
