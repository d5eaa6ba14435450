"""Attribution of a change to its parameters, and scenarios as a table."""

from collections import defaultdict
from dataclasses import replace
from decimal import Decimal
from fractions import Fraction
from itertools import permutations

import pytest

from tallybook.params import Scenario, scenarios_df
from tallybook.plans import attribution as A
from tallybook.plans import portfolio as P
from tallybook.plans import scenario_table as T
from tallybook.plans.portfolio import score_portfolio, score_scenarios
from tallybook.sources.keys import key_table

BASE = Scenario()
ALT = replace(
    BASE,
    scenario_name="ALT",
    pct_mortgage=Decimal("0.2"),
    pct_heloc=Decimal("0.2"),
    rate_shift_bps=150,
    lgd_auto=Decimal("0.6"),
    max_income=Decimal(90000),
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_are_the_mean_over_all_orders(spark):
    keys = key_table(spark, 300)
    factors = {f: v for f, v in A.changed_factors(BASE, ALT).items() if f in ("rates", "lgd", "mix")}
    alt = replace(BASE, **{n: getattr(ALT, n) for v in factors.values() for n in v})
    segment = {r.application_seq: r.product_type for r in score_portfolio(keys).collect()}

    def totals(names):
        s = replace(BASE, **{n: getattr(ALT, n) for f in names for n in factors[f]})
        out = defaultdict(Fraction)
        for r in score_portfolio(keys, s).collect():
            out[segment[r.application_seq]] += Fraction(r.expected_loss_amount)
        return out

    known = {frozenset(o[:i]): totals(o[:i]) for o in permutations(factors) for i in range(4)}
    rows = A.attribute(keys, BASE, alt, measures=("expected_loss_amount",)).collect()
    assert len(rows) == 15
    for r in rows:
        steps = [(frozenset(o[: o.index(r.factor)]), frozenset(o[: o.index(r.factor) + 1])) for o in permutations(factors)]
        mean = sum(known[b][r.product_type] - known[a][r.product_type] for a, b in steps) / 6
        assert abs(Fraction(r.contribution) - mean) < Fraction(1, 100)


def test_parts_add_up_exactly(spark):
    rows = A.attribute(key_table(spark, 200), BASE, ALT, by=("score_band", "product_type")).collect()
    sums = defaultdict(Decimal)
    for r in rows:
        sums[r.score_band, r.product_type, r.measure, r.alt_total - r.base_total] += r.contribution
    assert {r.factor for r in rows} == {"mix", "borrowers", "rates", "lgd"}
    assert sums and all(total == key[-1] for key, total in sums.items())


def test_attribution_is_one_pass(spark):
    text = plan(A.attribute(key_table(spark, 100), BASE, ALT))
    assert text.count("Exchange") == 1 and text.count("Range (") == 1 and "Join" not in text


def test_attribution_of_nothing_and_of_too_much(spark):
    keys = key_table(spark, 5)
    assert A.attribute(keys, BASE, replace(BASE, scenario_name="same")).count() == 0
    with pytest.raises(ValueError, match="populations"):
        A.attribute(keys, BASE, replace(BASE, population_id="other"))
    with pytest.raises(ValueError, match="in 0 factors"):
        A.attribute(keys, BASE, ALT, factors={"rates": ("rate_shift_bps",)})
    with pytest.raises(ValueError, match="at most"):
        A.changed_factors(BASE, ALT, {n: (n,) for n in A.FIELD_NAMES}) if A.MOST_FACTORS < 5 else A.changed_factors(
            BASE, replace(ALT, **{f"lgd_{p}": Decimal("0.5") for p in ("mortgage", "personal", "revolving", "heloc")}), {n: (n,) for n in A.FIELD_NAMES}
        )
    with pytest.raises(ValueError, match="segments"):
        A.attribute(keys, BASE, ALT, by=("loan_term_months",))


def test_weights_of_a_factor_sum_to_zero():
    for k in range(1, 6):
        for i in range(k):
            w = A.shapley_weights(k, i)
            assert sum(w) == 0 and sum(x for x in w if x > 0) == A.factorial(k)


MANY = [replace(BASE, scenario_name=f"S{i}", rate_shift_bps=10 * i, max_income=Decimal(90000 + 10000 * (i % 3))) for i in range(12)] + [
    replace(BASE, scenario_name="S0", population_id="OTHER")
]


@pytest.mark.parametrize("limit", [200_000, 1])
def test_a_table_scores_like_a_list(spark, monkeypatch, limit):
    monkeypatch.setattr(T, "BROADCAST_ROWS", limit)
    keys = key_table(spark, 40)
    got = score_scenarios(keys, scenarios_df(spark, MANY), audit=False)
    want = score_scenarios(keys, MANY, audit=False)
    assert got.count() == 520 and got.exceptAll(want).count() == 0


def test_the_plan_of_a_table_does_not_grow(spark):
    def plan_of(n):
        rows = spark.range(n).selectExpr("concat('S', id) AS scenario_name", "CAST(id AS INT) AS rate_shift_bps")
        rest = scenarios_df(spark, [BASE]).drop("scenario_name", "rate_shift_bps")
        return plan(score_scenarios(key_table(spark, 2), rest.crossJoin(rows), audit=False))

    few, many = plan_of(3), plan_of(20_000)
    assert len(many.splitlines()) == len(few.splitlines()) and many.count("FileScan") == 1
    assert "Exchange hashpartitioning" not in many and "SortMergeJoin" not in many


def test_names_of_a_table_must_be_distinct_and_present(spark):
    keys = key_table(spark, 2)
    for bad in (scenarios_df(spark, [BASE, BASE]), scenarios_df(spark, [replace(BASE, scenario_name=None)]), scenarios_df(spark, [BASE]).limit(0)):
        with pytest.raises(ValueError, match="distinct"):
            score_scenarios(keys, bad)


def test_a_stream_takes_a_parameter_table(spark, tmp_path):
    key_table(spark, 4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("application_seq long").parquet(str(tmp_path / "in"))
    assert score_scenarios(stream, scenarios_df(spark, [BASE])).isStreaming


def test_a_list_is_scored_in_slices(spark, monkeypatch):
    monkeypatch.setattr(P, "SLICE", 2)
    many = [replace(BASE, scenario_name=f"S{i}") for i in range(5)]
    rows = score_scenarios(key_table(spark, 4), many).groupBy("scenario_name").count()
    assert {r[0]: r[1] for r in rows.collect()} == {s.scenario_name: 4 for s in many}


def test_structure_is_made_once_for_scenarios_that_differ_in_loss(spark, monkeypatch):
    made = []
    plain = P.with_structure
    monkeypatch.setattr(P, "with_structure", lambda df, *args: made.append(df.count()) or plain(df, *args))
    rates = ("0.2", "0.3", "0.4")
    few = [replace(BASE, scenario_name=f"L{r}", lgd_auto=Decimal(r)) for r in rates] + [replace(BASE, scenario_name="UP", rate_shift_bps=100)]
    rows = score_scenarios(key_table(spark, 30), few, audit=False)
    assert made == [60] and rows.count() == 120
    for s in few:
        alone = score_scenarios(key_table(spark, 30), [s], audit=False)
        assert rows.where(rows.scenario_name == s.scenario_name).exceptAll(alone).count() == 0
