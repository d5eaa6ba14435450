"""Draws and scoring: invariants and edges."""

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.calibration import BAND_WEIGHT, PRODUCT_WEIGHT
from tallybook.functions import draws as D
from tallybook.functions import numeric as N
from tallybook.operators import risk, structure
from tallybook.params import BORROWER_FIELDS, Scenario, bind
from tallybook.plans.portfolio import compare_scenarios, score_portfolio, score_scenarios
from tallybook.schema import APPLICATION_SCHEMA, MULTIPLIERS
from tallybook.sources.keys import key_table, keyed, with_ids

BASE = Scenario()
STRESS = replace(BASE, scenario_name="UP", rate_shift_bps=200)
OTHER = replace(BASE, scenario_name="OTHER", population_id="P2", max_income=Decimal("90000"))


def fingerprint(df):
    names = [n for n in df.columns if n != "created_ts"]
    row = df.select(F.xxhash64(*names).cast("decimal(38,0)").alias("h"))
    return row.agg(F.count("*"), F.sum("h")).first()


@pytest.mark.parametrize("partitions", [4, 200])
def test_partitioning_does_not_matter(spark, partitions):
    one = fingerprint(score_portfolio(key_table(spark, 3000, 1)))
    assert fingerprint(score_portfolio(key_table(spark, 3000, partitions))) == one


def test_schema(spark):
    assert score_portfolio(key_table(spark, 1)).schema.simpleString() == (
        APPLICATION_SCHEMA.simpleString()
    )
    assert len(APPLICATION_SCHEMA) == 43


def test_draws_are_uniform(spark):
    df = D.with_draws(with_ids(key_table(spark, 20000)), "application_id", "'P'")
    us = [f"u{i}" for i in range(1, 16)]
    row = df.agg(
        F.min(F.least(*us)).alias("lo"), F.max(F.greatest(*us)).alias("hi"),
        *[F.avg(u).alias(u) for u in us],
    ).first()
    assert row.lo >= 0 and row.hi < 1
    assert all(abs(row[u] - 0.5) < 4 * 0.2887 / 20000**0.5 for u in us)


def test_highest_digest_stays_below_one(spark):
    top = "(CAST(shiftright(CAST(conv('ffffffffffffff', 16, 10) AS BIGINT), 3) AS DOUBLE) * "
    assert spark.range(1).selectExpr(top + f"{2.0**-53!r}D) < 1 AS ok").first().ok


def test_mix_is_near_its_weights(baseline):
    n = baseline.count()
    for column, weights in (("product_type", PRODUCT_WEIGHT), ("score_band", BAND_WEIGHT)):
        counts = {r[0]: r[1] for r in baseline.groupBy(column).count().collect()}
        for label, name in weights.items():
            p = float(getattr(BASE, name))
            assert abs(counts[label] - n * p) < 4 * (n * p * (1 - p)) ** 0.5


def test_limits_hold(baseline):
    broken = (
        ~F.col("estimated_pd").between(0.005, 0.45)
        | ~F.col("debt_to_income_ratio").between(0.05, 0.70)
        | ~F.col("utilization_rate").between(0, 0.95)
        | ~F.col("tradeline_count").between(1, 25)
        | (F.col("loan_term_months").isNull() != (F.col("product_type") == "REVOLVING_LINE"))
        | (F.col("bankruptcy_flag") & F.col("score_band").isin("SUPER_PRIME"))
    )
    assert baseline.where(broken).count() == 0
    required = [n for n in APPLICATION_SCHEMA.names if n != "loan_term_months"]
    nulls = [F.count_if(F.col(n).isNull()).alias(n) for n in required]
    assert set(baseline.agg(*nulls).first()) == {0}


def test_mortgage_may_fall_below_the_minimum(baseline):
    mortgages = baseline.where("product_type = 'MORTGAGE'")
    assert mortgages.where("requested_amount < 75000").count() > 0


def test_sweep_equals_separate_runs(spark):
    keys = key_table(spark, 2000)
    together = score_scenarios(keys, [BASE, STRESS, OTHER])
    assert together.count() == 6000
    for s in (BASE, STRESS, OTHER):
        part = together.where(
            (F.col("scenario_name") == s.scenario_name) & (F.col("population_id") == s.population_id)
        )
        assert fingerprint(part) == fingerprint(score_portfolio(keys, s))


def test_rate_shift_keeps_borrowers(spark):
    rows = score_scenarios(key_table(spark, 2000), [BASE, STRESS])
    borrower = ["product_type", "score_band", "annual_income", "requested_amount"]
    pairs = rows.groupBy("application_id").agg(F.countDistinct(F.struct(*borrower)).alias("n"))
    assert pairs.where("n > 1").count() == 0
    assert "rate_shift_bps" not in BORROWER_FIELDS


def test_sweep_refuses_equal_names(spark):
    with pytest.raises(ValueError):
        score_scenarios(key_table(spark, 1), [BASE, BASE])


def test_compare_counts_unmatched_rows(spark):
    rows = score_scenarios(key_table(spark, 500), [BASE, STRESS])
    kept = rows.where("NOT (scenario_name = 'UP' AND application_seq <= 20)").where(
        "NOT (scenario_name = 'BASELINE' AND application_seq > 490)"
    )
    total = compare_scenarios(kept, "BASELINE", "UP", ("population_id",)).first()
    assert (total.matched, total.only_base, total.only_alt) == (470, 20, 10)
    assert total.delta_monthly_payment_proxy > 0


def test_ids(spark):
    df = spark.createDataFrame([(7,), (99999999,), (123456789,), (None,)], "k long")
    ids = [r.application_id for r in with_ids(df, "k").collect()]
    assert ids == ["APP-00000007", "APP-99999999", "APP-123456789", None]
    assert [r.application_id for r in with_ids(df, "k", pad=12).collect()][2] == "APP-000123456789"


def test_null_key_gives_null_draws(spark):
    df = keyed(spark.createDataFrame([(None,), (1,)], "k long"), "k")
    rows = D.with_draws(with_ids(df), "application_id", "'P'", 2).collect()
    assert sorted(r.u1 is None for r in rows) == [False, True]
    assert score_portfolio(df).count() == 2


@pytest.mark.parametrize(
    "product, amount, apr, term, want",
    [
        ("AUTO_LOAN", "12000.00", "0.060000", 12, "1032.80"),
        ("AUTO_LOAN", "12000.00", "0.060000", None, None),
        ("MORTGAGE", "12000.00", "0.060000", 0, None),
        ("UNSECURED_PERSONAL_LOAN", "12000.00", "0.000000", 12, "1000.00"),
        ("REVOLVING_LINE", "100.50", "0.200000", None, "3.02"),
        ("REVOLVING_LINE", "1000.17", "0.200000", None, "30.01"),
        ("HELOC", "10000.00", "0.120000", 120, "100.00"),
        ("OTHER", "10000.00", "0.120000", 120, None),
    ],
)
def test_payment(spark, product, amount, apr, term, want):
    df = spark.createDataFrame(
        [(product, Decimal(amount), Decimal(apr), term)],
        "p string, a decimal(18,2), r decimal(12,6), t int",
    )
    got = df.selectExpr(f"{structure.monthly_payment('p', 'a', 'r', 't')} AS x").first().x
    assert got == (None if want is None else Decimal(want))


def test_zero_income_gives_null_ratios(spark):
    df = spark.sql("SELECT 100BD AS a, 0BD AS i, CAST(NULL AS DECIMAL(18,6)) AS pti")
    row = df.selectExpr(
        f"{structure.amount_to_income('a', 'i')} AS ati",
        f"{structure.payment_to_income('a', 'i')} AS pti",
        f"{risk.pd_components()['mult_pti'].replace('payment_to_income_ratio', 'pti')} AS m",
    ).first()
    assert row.ati is None and row.pti is None and row.m == Decimal("1.45")


@pytest.mark.parametrize(
    "column, kind, points",
    [
        ("mult_util", "decimal(12,4)", {"0.0999": "0.95", "0.1": "1.00", "0.5": "1.25", "0.75": "1.45"}),
        ("mult_dti", "decimal(12,4)", {"0.1999": "0.95", "0.2": "1.00", "0.4499": "1.10", "0.55": "1.45"}),
        ("mult_inquiry", "int", {"1": "1.00", "2": "1.05", "3": "1.05", "5": "1.12", "6": "1.20"}),
        ("mult_tradeline", "int", {"0": "1.08", "2": "1.12", "3": "1.05", "12": "1.00", "18": "1.03", "19": "1.08"}),
        ("mult_file_age", "int", {"11": "1.18", "12": "1.10", "59": "1.05", "60": "1.00"}),
        ("mult_pti", "decimal(18,6)", {"0.049999": "0.95", "0.05": "1.00", "0.2": "1.45"}),
        ("mult_amt_income", "decimal(18,6)", {"0.099999": "1.00", "0.1": "1.03", "1": "1.25"}),
        ("mult_delinq", "int", {"0": "1.00", "3": "1.75", "4": "2.10", "9": "2.10"}),
    ],
)
def test_step_edges(spark, column, kind, points):
    source = {
        "mult_util": "utilization_rate",
        "mult_dti": "debt_to_income_ratio",
        "mult_inquiry": "recent_inquiry_count",
        "mult_tradeline": "tradeline_count",
        "mult_file_age": "months_since_oldest_trade",
        "mult_pti": "payment_to_income_ratio",
        "mult_amt_income": "amount_to_income_ratio",
        "mult_delinq": "delinquency_count_12m",
    }[column]
    df = spark.createDataFrame([(k,) for k in points], "k string")
    df = df.selectExpr("k", f"CAST(k AS {kind}) AS {source}")
    got = df.selectExpr("k", f"{risk.pd_components()[column]} AS m").collect()
    assert {r.k: r.m for r in got} == {k: Decimal(v) for k, v in points.items()}


def test_unknown_labels(spark):
    df = spark.sql("SELECT 'NEW' AS product_type, 'NEW' AS score_band, 0.5D AS u4, 0.5D AS u5")
    params = bind([BASE])
    row = df.selectExpr(
        f"{risk.lgd('product_type', params)} AS lgd",
        f"{structure.apr_bounded('0.1BD')} AS apr",
        f"{risk.pd_components()['base_pd']} AS base_pd",
        f"{D.draw_int_by('score_band', 'u4', {'A': (1, 1), '*': (500, 80)})} AS score",
    ).first()
    assert row.lgd is None and row.apr is None
    assert row.base_pd == Decimal("0.26") and row.score == 540


def test_expected_loss_keeps_all_digits(spark):
    sql = risk.expected_loss("CAST(125000.01 AS DECIMAL(18,2))", "0.450000BD", "0.850000BD")
    exact = Decimal("125000.01") * Decimal("0.45") * Decimal("0.85")
    assert spark.sql(f"SELECT {sql} AS x").first().x == exact.quantize(Decimal("0.01"))


def test_settle_rounds_ties_up(spark):
    row = spark.sql(
        f"SELECT {N.settle('(1.01D + 1.02D) / 2', 2)} AS a, {N.settle('-1.005D', 2)} AS b,"
        f" {N.to_decimal('2.675D', 18, 2)} AS c"
    ).first()
    assert (row.a, row.b) == (Decimal("1.02"), Decimal("-1.01"))
    assert row.c == Decimal("2.68")


def test_ratios_are_exact(spark):
    df = spark.range(1, 100_001).selectExpr(
        "CAST(id / 100 AS DECIMAL(18,2)) AS a", "CAST(40000 + id % 7 AS DECIMAL(18,2)) AS i"
    )
    exact = "CAST(floor((CAST(a * 100 AS DECIMAL(38,0)) * {} + i * 100) / (2 * i * 100)) AS DECIMAL(18,0)) * 0.000001BD"
    row = df.selectExpr(
        f"{structure.amount_to_income('a', 'i')} <> {exact.format(2_000_000)} AS x",
        f"{structure.payment_to_income('a', 'i')} <> {exact.format(24_000_000)} AS y",
    ).selectExpr("count_if(x) AS x", "count_if(y) AS y", "count(*) AS n").first()
    assert (row.x, row.y, row.n) == (0, 0, 100_000)
    one = spark.sql(
        f"SELECT {structure.amount_to_income('0.95BD', '100000BD')} AS ratio,"
        f" {structure.amortizing_payment('0.42BD', '0BD', '12')} AS payment"
    ).first()
    assert (one.ratio, one.payment) == (Decimal("0.000010"), Decimal("0.04"))


def test_multiplier_count():
    assert len(MULTIPLIERS) == 11
