"""Every rule fails alone on a scenario made for it."""

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest

from tallybook.operators.validate import (
    assert_valid,
    domain_check,
    duplicate_keys,
    duplicate_scenarios,
    row_count_check,
    validate_scenarios,
)
from tallybook.params import Scenario, load_scenarios, scenarios_df

GOOD = Scenario()
BROKEN = {
    "application_count": {"application_count": 0},
    "date_window": {"portfolio_start_date": date(2026, 1, 1), "anchor_date": date(2026, 2, 1)},
    "product_mix": {"pct_mortgage": "0.300011"},
    "score_mix": {"pct_prime": "0.279989"},
    "credit_score_bounds": {"min_credit_score": 850},
    "income_bounds": {"min_income": "300000"},
    "dti_bounds": {"max_dti": "1.0001"},
    "utilization_bounds": {"min_utilization": "0.95"},
    "amount_bounds": {"min_heloc_amt": "250000"},
    "base_rates": {"base_rate_auto": "0"},
    "lgd_range": {"lgd_revolving": "1"},
}
STRICT = {
    "no_null_parameter": {"lgd_auto": None},
    "weights_not_negative": {"pct_mortgage": "-0.1", "pct_revolving": "0.65"},
    "amount_minimums_positive": {"min_auto_amt": "0"},
    "anchor_after_window": {"anchor_date": date(2025, 12, 30)},
    "ids_fit_width": {"application_count": 100_000_000},
}


def failing(spark, changes, strict):
    rows = validate_scenarios(scenarios_df(spark, [replace(GOOD, **changes)]), strict)
    return [r.rule for r in rows.where("NOT ok").collect()]


def test_baseline_passes(spark):
    assert failing(spark, {}, True) == []
    assert_valid(scenarios_df(spark, [GOOD]), strict=True)


@pytest.mark.parametrize("rule", BROKEN)
def test_rule_fails_alone(spark, rule):
    assert failing(spark, BROKEN[rule], True) == [rule]
    with pytest.raises(ValueError, match=rule):
        assert_valid(scenarios_df(spark, [replace(GOOD, **BROKEN[rule])]))


@pytest.mark.parametrize("rule", STRICT)
def test_strict_rule(spark, rule):
    assert failing(spark, STRICT[rule], False) == []
    assert failing(spark, STRICT[rule], True) == [rule]


def test_mix_within_tolerance_passes(spark):
    assert failing(spark, {"pct_mortgage": "0.300010"}, False) == []


def test_many_scenarios(spark):
    many = [replace(GOOD, scenario_name=f"S{i}", rate_shift_bps=i) for i in range(20)]
    checks = validate_scenarios(scenarios_df(spark, many))
    assert checks.count() == 220 and checks.where("NOT ok").count() == 0


def test_duplicate_scenarios(spark):
    twice = scenarios_df(spark, [GOOD, GOOD])
    assert duplicate_scenarios(twice).first().n == 2
    with pytest.raises(ValueError, match="2 rows"):
        assert_valid(twice, strict=True)


def test_parameter_table_round_trip(spark):
    back = load_scenarios(scenarios_df(spark, [GOOD]))[0]
    assert back.pct_mortgage == Decimal("0.3") and back.anchor_date == GOOD.anchor_date


def test_output_checks(spark, baseline):
    assert row_count_check(baseline, 50000).first().ok
    assert not row_count_check(baseline, 49999).first().ok
    assert {r.ok for r in domain_check(baseline).collect()} == {True}
    odd = spark.sql("SELECT CAST(NULL AS STRING) application_id, 'X' product_type, 'X' score_band, 1 estimated_pd")
    assert [r.ok for r in domain_check(odd).collect()] == [False, False, False, True]
    assert duplicate_keys(baseline).count() == 0
    assert duplicate_keys(baseline.unionByName(baseline.limit(3))).count() == 3


def test_the_message_counts_what_it_leaves_out(spark):
    bad = [replace(GOOD, scenario_name=f"S{i}", base_rate_auto=Decimal(0)) for i in range(25)]
    with pytest.raises(ValueError, match="and 5 more"):
        assert_valid(scenarios_df(spark, bad))
