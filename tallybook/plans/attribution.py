"""Attribution of the change between two scenarios to the parameters that changed.

The change of a total is split by Shapley values: a group of parameters gets the mean of what its change
adds, over all orders in which the groups could be changed one after the other. The parts
therefore add up to the whole change, and groups that work alike get alike parts.

All coalitions of groups are scenarios of one map-only scoring pass. A Shapley value is a sum of coalition totals
with fixed weights, so a single aggregation, with as many rows as there are segments, gives all of them; the weights are
whole numbers over k!, and all sums are exact decimals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from decimal import Decimal
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.calibration import DEFAULT, Calibration
from tallybook.functions.numeric import Sql, text
from tallybook.params import FIELD_NAMES, Scenario
from tallybook.plans.portfolio import SEGMENTS, fenced, score_scenarios
from tallybook.schema import APPLICATION_SCHEMA

#: Groups of parameters; what a scenario is called and when it is told change no figure.
FACTORS = {
    "mix": tuple(n for n in FIELD_NAMES if n.startswith("pct_")),
    "window": ("portfolio_start_date", "portfolio_end_date"),
    "borrowers": tuple(n for n in FIELD_NAMES if n.endswith(("_income", "_dti", "_utilization", "_credit_score"))),
    "amounts": tuple(n for n in FIELD_NAMES if n.endswith("_amt")),
    "rates": tuple(n for n in FIELD_NAMES if n.startswith("base_rate_") or n == "rate_shift_bps"),
    "lgd": tuple(n for n in FIELD_NAMES if n.startswith("lgd_")),
}
MEASURES = ("requested_amount", "monthly_payment_proxy", "expected_loss_amount")
#: 2^groups rows are scored for every key.
MOST_FACTORS = 8


def changed_factors(
    base: Scenario, alt: Scenario, factors: Mapping[str, Sequence[str]] = FACTORS
) -> dict[str, tuple[str, ...]]:
    """The groups in which the scenarios differ, with the fields that do.

    A changed field that is in no group, or in two, is an error: its effect would be lost or told twice.
    """
    silent = ("scenario_name", "application_count", "anchor_date")
    changed = [n for n in FIELD_NAMES if n not in silent and getattr(base, n) != getattr(alt, n)]
    if "population_id" in changed:
        raise ValueError("the scenarios have different populations")
    for name in changed:
        homes = [f for f, fields in factors.items() if name in fields]
        if len(homes) != 1:
            raise ValueError(f"{name} changes and is in {len(homes)} factors")
    found = {f: tuple(n for n in fields if n in changed) for f, fields in factors.items()}
    found = {f: fields for f, fields in found.items() if fields}
    if len(found) > MOST_FACTORS:
        raise ValueError(f"{len(found)} factors change; {MOST_FACTORS} at most, join some")
    return found


def coalitions(base: Scenario, alt: Scenario, factors: Mapping[str, Sequence[str]]) -> list[Scenario]:
    """A scenario for each set of changed factors, named by the set's number: bit i stands for factor i."""
    groups = list(factors.values())
    out = []
    for mask in range(2 ** len(groups)):
        fields = [n for i, g in enumerate(groups) if mask >> i & 1 for n in g]
        out.append(replace(base, scenario_name=str(mask), **{n: getattr(alt, n) for n in fields}))
    return out


def shapley_weights(k: int, factor: int) -> list[int]:
    """The weight of each coalition's total in k! times the factor's Shapley value."""
    out = []
    for mask in range(2**k):
        size = mask.bit_count()
        if mask >> factor & 1:
            out.append(factorial(size - 1) * factorial(k - size))
        else:
            out.append(-factorial(size) * factorial(k - size - 1))
    return out


def attribute(
    keys: DataFrame,
    base: Scenario,
    alt: Scenario,
    by: Sequence[str] = ("product_type",),
    measures: Sequence[str] = MEASURES,
    factors: Mapping[str, Sequence[str]] = FACTORS,
    cal: Calibration = DEFAULT,
) -> DataFrame:
    """One row per segment, measure and factor: totals under both scenarios and the factor's part of the change.

    Segments are those under ``base``, so that a borrower whom a changed mix labels anew is counted where they were.
    Parts are rounded to the measure's last digit so that they still add up to the change exactly. NULLs of a measure
    count as nothing. Scenarios that do not differ give no rows.
    """
    unknown = set(by) - set(SEGMENTS)
    if unknown:
        raise ValueError(f"no segments: {sorted(unknown)}")
    found = changed_factors(base, alt, factors)
    k, all_ = len(found), factorial(len(found))
    scored = score_scenarios(keys, coalitions(base, alt, found), cal, audit=False, reference=base)
    rows = fenced(scored.selectExpr(*[f"base_{c} AS {c}" for c in by], "CAST(scenario_name AS INT) AS mask", *measures))

    def weighted(weights: Sequence[int], measure: str) -> Sql:
        menu = ", ".join(f"CAST({w} AS DECIMAL(8,0))" for w in weights)
        return f"sum(coalesce({measure}, 0) * element_at(array({menu}), mask + 1))"

    sums = {f"t{j}_{i}": weighted(shapley_weights(k, i), m) for j, m in enumerate(measures) for i in range(k)}
    for j, m in enumerate(measures):
        sums[f"from{j}"] = f"sum(if(mask = 0, {m}, 0))"
        sums[f"to{j}"] = f"sum(if(mask = {2**k - 1}, {m}, 0))"
    totals = rows.groupBy(*by).agg(*[F.expr(sql).alias(name) for name, sql in sums.items()])
    return totals.selectExpr(*by, f"inline({_parts(found, measures, all_)})")


def _parts(found: Mapping[str, Sequence[str]], measures: Sequence[str], all_: int) -> Sql:
    """An array with a row for each measure and factor.

    A part is the difference of two rounded running sums; the last running sum is the whole change.
    """
    def row(measure: str, factor: str, base: Sql, alt: Sql, part: Sql) -> Sql:
        values = {"base_total": base, "alt_total": alt, "contribution": part}
        figures = ", ".join(f"CAST({v} AS DECIMAL(28,6)) AS {n}" for n, v in values.items())
        return f"struct({text(measure)} AS measure, {text(factor)} AS factor, {figures})"

    if not found:
        return f"filter(array({row('', '', '0', '0', '0')}), x -> false)"
    rows = []
    for j, measure in enumerate(measures):
        scale = APPLICATION_SCHEMA[measure].dataType.scale
        unit = f"{Decimal(1).scaleb(-scale):f}BD"
        before = "0L"
        for i, factor in enumerate(found):
            units = " + ".join(f"t{j}_{h}" for h in range(i + 1))
            whole = f"CAST(({units}) * {10**scale}BD AS DECIMAL(38,0))"
            half_up = f"(2BD * abs({whole}) + {all_}BD) div {2 * all_}BD"
            here = f"if({whole} < 0, -1L, 1L) * ({half_up})"
            rows.append(row(measure, factor, f"from{j}", f"to{j}", f"({here} - {before}) * {unit}"))
            before = here
    return f"array({', '.join(rows)})"
