"""Checks of a finished report against what the reviewer expects to see.

Each check is a row: ``rule``, ``ok`` and the ``observed`` figure. A report is read once
for all its checks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.numeric import Sql, num, text


def trends(
    report: DataFrame, label: str, labels: Sequence[str], rising: Mapping[str, bool]
) -> DataFrame:
    """Does each value move one way along the listed labels?

    ``rising`` maps a value to its expected direction, and ``observed`` counts the steps
    that go the wrong way. Labels the report lacks are passed over.
    """
    checks = []
    for value, up in rising.items():
        path = ", ".join(f"max(if({label} = {text(v)}, {value}, NULL))" for v in labels)
        checks.append(F.expr(f"array_compact(array({path}))").alias(value))
    paths = report.agg(*checks)
    rows = []
    for value, up in rising.items():
        wrong = f"{value}[i + 1] {'<' if up else '>'} {value}[i]"
        steps = f"size(filter(sequence(0, size({value}) - 2), i -> {wrong}))"
        rule = f"{value} {'rises' if up else 'falls'} along {label}"
        rows.append(_check(rule, f"CAST(if(size({value}) < 2, 0, {steps}) AS DOUBLE)", 0))
    return _inlined(paths, rows)


def near_target(
    report: DataFrame, label: str, targets: Mapping[str, float], tolerance: float
) -> DataFrame:
    """Is every listed share within ``tolerance`` percentage points of its target?"""
    pairs = ", ".join(f"{text(k)}, {num(v)}" for k, v in targets.items())
    gap = f"abs(CAST(pct_of_total AS DOUBLE) - try_element_at(map({pairs}), {label}))"
    gaps = report.agg(F.expr(f"max({gap})").alias("gap"))
    return _inlined(gaps, [_check(f"{label} share near target", "gap", tolerance)])


def chi_square_limit(freedom: int, alpha: float) -> float:
    """The value that a chi-square figure exceeds with probability ``alpha``."""

    def above(x: float) -> float:
        # upper tail of the chi-square distribution, by the series of the lower incomplete gamma function
        a, half = freedom / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= half / n
            total += term
        return 1 - total * math.exp(a * math.log(half) - half - math.lgamma(a)) if half else 1.0

    low, high = 0.0, 10.0 * freedom + 100.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > alpha else (low, middle)
    return low


def mix_fits(
    df: DataFrame, label: str, targets: Mapping[str, float], alpha: float = 0.001
) -> DataFrame:
    """Do the counts of a label fit its target shares, given the number of rows?

    A fixed tolerance of a share is too wide for millions of rows and too narrow for a few hundred; the chi-square
    figure of counts against targets grows with a true deviation and not with the rows. ``observed`` is that figure, and
    a check fails where it would come about by chance with probability ``alpha``. Any row with a label that has no target, or a
    target of zero, fails. Shares need not sum to one.
    """
    whole = sum(targets.values())
    used = {k: v / whole for k, v in targets.items() if v > 0}
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    sums = [F.sum("n").alias("rows")]
    sums += [F.sum(F.when(F.col(label) == k, F.col("n")).otherwise(0)).alias(f"n{i}") for i, k in enumerate(used)]
    totals = counts.agg(*sums)
    parts = [f"pow(n{i} - rows * {num(p)}, 2) / (rows * {num(p)})" for i, p in enumerate(used.values())]
    other = " - ".join(["rows", *[f"n{i}" for i in range(len(used))]])
    figure = f"CASE WHEN coalesce(rows, 0) = 0 THEN 0D WHEN {other} > 0 THEN CAST('Infinity' AS DOUBLE) ELSE {' + '.join(parts)} END"
    limit = chi_square_limit(len(used) - 1, alpha) if len(used) > 1 else 0.0
    return _inlined(totals, [_check(f"{label} mix fits its targets", figure, limit)])


def at_limit(df: DataFrame, column: str, limit: str, most: float) -> DataFrame:
    """Is the share of rows that sit at a limit no more than ``most``?"""
    crowd = f"CAST(count_if({column} >= {limit}) AS DOUBLE) / nullif(count(*), 0)"
    shares = df.agg(F.expr(crowd).alias("crowd"))
    return _inlined(shares, [_check(f"{column} at limit", "crowd", most)])


def _check(rule: str, observed: Sql, most: float) -> Sql:
    return (
        f"struct({text(rule)} AS rule, {observed} <= {num(most)} AS ok, {observed} AS observed)"
    )


def _inlined(figures: DataFrame, checks: Sequence[Sql]) -> DataFrame:
    return figures.selectExpr(f"inline(array({', '.join(checks)}))")


# Direction in which each figure is expected to move.
BAND_TRENDS = {
    "avg_credit_score": False,
    "avg_income": False,
    "avg_dti": True,
    "avg_utilization": True,
    "avg_delinquency_count": True,
    "major_derog_rate": True,
    "bankruptcy_rate": True,
    "avg_pti": True,
    "avg_pd": True,
}
BUCKET_TRENDS = {"avg_pd": True, "avg_expected_loss": True}


def review_expectations(
    mixes: DataFrame,
    bands: DataFrame,
    buckets: DataFrame,
    band_order: Sequence[str],
    bucket_order: Sequence[str],
    targets: Mapping[str, float],
    tolerance: float = 1.0,
) -> DataFrame:
    """The standard set: mix on target, stronger bands look stronger, PD follows PTI."""
    return (
        near_target(mixes, "score_band", targets, tolerance)
        .unionByName(trends(bands, "score_band", band_order, BAND_TRENDS))
        .unionByName(trends(buckets, "pti_bucket", bucket_order, BUCKET_TRENDS))
    )
