"""Parameter gate and output checks. Every check is a row: ``rule``, ``ok``, ``observed``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.calibration import BAND_WEIGHT, BANDS, PRODUCT_FIELD, PRODUCT_WEIGHT, PRODUCTS
from tallybook.functions.numeric import Sql, text
from tallybook.params import FIELD_NAMES

MIX_TOLERANCE = "0.00001"


def _any(conditions) -> Sql:
    return " OR ".join(f"({c})" for c in conditions)


def _unit_range(low: str, high: str) -> Sql:
    return f"{low} < 0 OR {low} >= {high} OR {high} > 1"


def _off_unit(weights) -> Sql:
    return f"abs({' + '.join(weights)} - 1) > {MIX_TOLERANCE}"


def violations() -> dict[str, tuple[Sql, list[str]]]:
    """Rule name to (condition that breaks it, parameters to show)."""
    products = list(PRODUCT_FIELD.values())
    ranges = [(f"min_{p}_amt", f"max_{p}_amt") for p in products]
    rates, lgds = [f"base_rate_{p}" for p in products], [f"lgd_{p}" for p in products]
    product_mix, score_mix = list(PRODUCT_WEIGHT.values()), list(BAND_WEIGHT.values())
    return {
        "application_count": ("application_count <= 0", ["application_count"]),
        "date_window": (
            "portfolio_start_date > portfolio_end_date",
            ["portfolio_start_date", "portfolio_end_date"],
        ),
        "product_mix": (_off_unit(product_mix), product_mix),
        "score_mix": (_off_unit(score_mix), score_mix),
        "credit_score_bounds": (
            "min_credit_score >= max_credit_score",
            ["min_credit_score", "max_credit_score"],
        ),
        "income_bounds": (
            "min_income <= 0 OR min_income >= max_income",
            ["min_income", "max_income"],
        ),
        "dti_bounds": (_unit_range("min_dti", "max_dti"), ["min_dti", "max_dti"]),
        "utilization_bounds": (
            _unit_range("min_utilization", "max_utilization"),
            ["min_utilization", "max_utilization"],
        ),
        "amount_bounds": (
            _any(f"{low} >= {high}" for low, high in ranges),
            [name for pair in ranges for name in pair],
        ),
        "base_rates": (_any(f"{r} <= 0" for r in rates), rates),
        "lgd_range": (_any(f"{v} <= 0 OR {v} >= 1" for v in lgds), lgds),
    }


def strict_violations(pad: int = 8) -> dict[str, tuple[Sql, list[str]]]:
    """Further rules: gaps that the base rules let through."""
    weights = [*PRODUCT_WEIGHT.values(), *BAND_WEIGHT.values()]
    mins = [f"min_{p}_amt" for p in PRODUCT_FIELD.values()]
    return {
        "no_null_parameter": (_any(f"{n} IS NULL" for n in FIELD_NAMES), list(FIELD_NAMES)),
        "weights_not_negative": (_any(f"{w} < 0" for w in weights), weights),
        "amount_minimums_positive": (_any(f"{m} <= 0" for m in mins), mins),
        "anchor_after_window": (
            "anchor_date < portfolio_end_date",
            ["anchor_date", "portfolio_end_date"],
        ),
        "ids_fit_width": (f"application_count > {10**pad - 1}L", ["application_count"]),
    }


def _check(rule: str, ok: Sql, observed: Sql) -> Sql:
    return f"struct({text(rule)} AS rule, {ok} AS ok, {observed} AS observed)"


def _shown(names) -> Sql:
    parts = [f"concat('{n}=', coalesce(CAST({n} AS STRING), 'NULL'))" for n in names]
    return f"concat_ws(', ', {', '.join(parts)})"


def validate_scenarios(scenarios: DataFrame, strict: bool = False, pad: int = 8) -> DataFrame:
    """Check every row of a parameter table against every rule. Map-only.

    As in SQL, a rule that compares with NULL does not fail; ``strict`` adds a rule
    against NULL parameters and a few more.
    """
    rules = violations() | (strict_violations(pad) if strict else {})
    checks = ", ".join(
        _check(rule, f"NOT coalesce({broken}, false)", _shown(names))
        for rule, (broken, names) in rules.items()
    )
    return scenarios.selectExpr("scenario_name", f"inline(array({checks}))")


def duplicate_scenarios(scenarios: DataFrame) -> DataFrame:
    """Scenario and population pairs that occur more than once."""
    return (
        scenarios.groupBy("scenario_name", "population_id")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def first_rows(df: DataFrame, shown: int = 20) -> tuple[list, str]:
    """The first rows, and a note on how many more there are."""
    rows = df.take(shown)
    more = df.count() - shown if len(rows) == shown else 0
    return rows, f"; and {more} more" if more > 0 else ""


def assert_valid(scenarios: DataFrame, strict: bool = False, pad: int = 8) -> None:
    """Raise ``ValueError`` if any scenario breaks a rule; name the first broken rules and count the rest."""
    broken, more = first_rows(validate_scenarios(scenarios, strict, pad).where(~F.col("ok")))
    if broken:
        raise ValueError("; ".join(f"{r.scenario_name}: {r.rule} ({r.observed})" for r in broken) + more)
    if strict:
        twice, more = first_rows(duplicate_scenarios(scenarios))
        if twice:
            raise ValueError("; ".join(f"{r.scenario_name}: {r.n} rows" for r in twice) + more)


def key_checks(keys: DataFrame, key: str = "application_seq", pad: int = 8) -> DataFrame:
    """Keys that are missing, negative, too long for their ids or repeated, counted."""
    wrong = {
        "key_present": f"{key} IS NULL",
        "key_not_negative": f"{key} < 0",
        "key_fits_width": f"{key} > {10**pad - 1}L",
    }
    per_key = keys.groupBy(key).agg(F.count("*").alias("n"))
    sums = [F.expr(f"coalesce(sum(if({w}, n, 0)), 0)").alias(rule) for rule, w in wrong.items()]
    twice = F.expr(f"coalesce(sum(if({key} IS NOT NULL, n - 1, 0)), 0)").alias("key_unique")
    rules = (*wrong, "key_unique")
    checks = ", ".join(_check(r, f"{r} = 0", f"CAST({r} AS STRING)") for r in rules)
    return per_key.agg(*sums, twice).selectExpr(f"inline(array({checks}))")


def row_count_check(df: DataFrame, expected: int) -> DataFrame:
    """Does the table have the expected number of rows?"""
    counted = df.agg(F.count("*").alias("n"))
    check = _check("row_count", f"n = {expected}L", "CAST(n AS STRING)")
    return counted.selectExpr(f"inline(array({check}))")


def domain_check(df: DataFrame) -> DataFrame:
    """Rows with a missing key or an unknown product or band, counted in one pass."""

    def unknown(column: str, labels) -> Sql:
        return f"coalesce({column} NOT IN ({', '.join(text(v) for v in labels)}), true)"

    wrong = {
        "application_id_present": "application_id IS NULL",
        "product_type_known": unknown("product_type", PRODUCTS),
        "score_band_known": unknown("score_band", BANDS),
        "estimated_pd_present": "estimated_pd IS NULL",
    }
    totals = df.agg(*[F.expr(f"count_if({w})").alias(rule) for rule, w in wrong.items()])
    checks = ", ".join(_check(r, f"{r} = 0", f"CAST({r} AS STRING)") for r in wrong)
    return totals.selectExpr(f"inline(array({checks}))")


def duplicate_keys(df: DataFrame, key: str = "application_seq") -> DataFrame:
    """Keys that occur more than once. One shuffle; counts are combined before it."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
