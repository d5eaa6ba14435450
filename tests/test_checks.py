"""Scorecards from breakpoint tables, stored sketches, mix tests and two-scan profiles."""

import math
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import expectations as X
from tallybook.operators import quantiles as Q
from tallybook.operators import reports as R
from tallybook.operators import scorecard as C
from tallybook.operators import sketches as K
from tallybook.params import Scenario
from tallybook.plans.build import build_portfolio
from tallybook.plans.portfolio import score_portfolio
from tallybook.sources.keys import key_table
from tallybook.sources.snapshots import append_batch
from tallybook.sources.store import read_portfolio, stage, unstage

POINTS = "characteristic string, low double, high double, points double"


def breakpoints(spark, *rows):
    return spark.createDataFrame([(c, *map(lambda v: None if v is None else float(v), r)) for c, *r in rows], POINTS)


def test_points_at_edges_and_for_missing_values(spark):
    table = breakpoints(spark, ("a", None, 1, 10), ("a", 1, 2.5, 20), ("a", 2.5, None, 30), ("b", None, None, 5))
    values = [-1e300, 0.999, 1.0, 2.4999, 2.5, 1e300, float("inf"), float("-inf"), None, float("nan")]
    df = spark.createDataFrame([(v, "keep") for v in values], "v double, points_x string")
    got = C.with_points(df, table, {"a": "v", "b": "v * 2"}, missing="-1D").collect()
    assert [r.points_a for r in got] == [10, 10, 20, 20, 30, 30, 30, 10, -1, -1]
    assert [r.points_b for r in got] == [5] * 8 + [-1, -1] and got[0].points_x == "keep"


def test_binary_search_finds_every_interval(spark):
    edges = list(range(0, 997, 3))
    rows = [("x", None, 0, -1)] + [("x", a, b, a) for a, b in zip(edges, [*edges[1:], None])]
    df = spark.range(-5, 1010).selectExpr("CAST(id AS DOUBLE) AS v")
    got = C.with_points(df, breakpoints(spark, *rows), {"x": "v"}).collect()
    assert all(r.points_x == (-1 if r.v < 0 else min(r.v // 3 * 3, edges[-1])) for r in got)


def test_breakpoints_must_meet(spark):
    good = ("b", None, None, 1)
    bad = {
        "no_gap": [("a", None, 1, 1), ("a", 2, None, 2)],
        "no_overlap": [("a", None, 2, 1), ("a", 1, None, 2)],
        "first_is_open_below": [("a", 0, None, 1)],
        "last_is_open_above": [("a", None, 1, 1)],
        "interval_not_empty": [("a", None, 1, 1), ("a", 1, 1, 2), ("a", 1, None, 3)],
        "points_present": [("a", None, None, None)],
        "characteristic_present": [(None, None, None, 1)],
    }
    for rule, rows in bad.items():
        with pytest.raises(ValueError, match=rule):
            C.with_points(spark.range(1), breakpoints(spark, good, *rows), {"b": "id"})
    with pytest.raises(ValueError, match="no breakpoints"):
        C.with_points(spark.range(1), breakpoints(spark, good), {"z": "id"})
    assert C.breakpoint_checks(breakpoints(spark, good)).where("ok").count() == 8


def test_a_scorecard_is_map_only(spark):
    table = stage(breakpoints(spark, ("a", None, 1, 1), ("a", 1, None, 2)), "points")
    text = C.with_points(key_table(spark, 10), table, {"a": "application_seq"})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastNestedLoopJoin" in text


def test_chi_square_limits():
    for freedom, alpha, want in ((1, 0.05, 3.841459), (4, 0.001, 18.466827), (10, 0.5, 9.341818), (100, 0.01, 135.806723)):
        assert math.isclose(X.chi_square_limit(freedom, alpha), want, rel_tol=1e-6)


@pytest.mark.parametrize("rows", [500, 50_000_000])
def test_mix_at_small_and_large_sizes(spark, rows):
    """Shares off by 0.7 points pass at 500 rows and fail at 50 million; a fixed tolerance of a point passes both."""
    targets = {"a": 0.5, "b": 0.3, "c": 0.2}
    at = "pmod(id * 389, 1000)"  # spread, so that few rows have these shares too
    half = spark.range(rows).selectExpr(f"CASE WHEN {at} < 507 THEN 'a' WHEN {at} < 800 THEN 'b' ELSE 'c' END AS k")
    check = X.mix_fits(half, "k", targets).first()
    figure = sum((o - e) ** 2 / e for o, e in ((0.507, 0.5), (0.293, 0.3), (0.2, 0.2)))
    if rows > 500:
        assert math.isclose(check.observed, figure * rows, rel_tol=1e-9) and not check.ok
        exact = spark.range(rows).selectExpr("CASE WHEN id % 10 < 5 THEN 'a' WHEN id % 10 < 8 THEN 'b' ELSE 'c' END AS k")
        assert X.mix_fits(exact, "k", targets).first().observed == 0
    else:
        assert check.ok


def test_mix_with_strangers_zero_targets_and_no_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert not X.mix_fits(df, "k", {"a": 0.5, "b": 0.5}).first().ok
    assert not X.mix_fits(df.where("k IS NOT NULL"), "k", {"a": 1.0, "b": 0.0}).first().ok
    assert X.mix_fits(df.where("k IN ('a', 'b')"), "k", {"a": 0.5, "b": 0.5}).first().ok
    assert X.mix_fits(df.limit(0), "k", {"a": 0.5, "b": 0.5}).first().ok


def ranks_near(rows, profile, columns):
    for r in profile.collect():
        values = sorted(float(x[0]) for x in rows.select(r.variable_name).where(f"{r.variable_name} IS NOT NULL").collect())
        assert r.n == len(values) and (r.min_val, r.max_val) == (values[0], values[-1])
        for name, p in K.PROBS.items():
            below = sum(v < r[name] for v in values) / len(values)
            upto = sum(v <= r[name] for v in values) / len(values)
            assert below <= p + r.rank_error and upto >= p - r.rank_error


def test_sketches_of_new_slices_only(spark, tmp_path):
    path = str(tmp_path / "p")
    columns = ("credit_score", "annual_income", "estimated_pd")
    scenarios = [Scenario(application_count=3000), Scenario(application_count=3000, scenario_name="a/b=c %{d}")]
    build_portfolio(key_table(spark, 3000), scenarios, path)
    assert len(K.update_sketches(spark, path, columns)) == 1 and K.update_sketches(spark, path, columns) == []
    append_batch(score_portfolio(key_table(spark, 500).selectExpr("application_seq + 9000 AS application_seq")), 0, path, "s")
    assert len(K.update_sketches(spark, path, columns)) == 1
    profile = K.portfolio_profile(spark, path)
    assert {(r.scenario_name, r.n) for r in profile.collect()} == {("BASELINE", 3500), ("a/b=c %{d}", 3000)}
    rows = read_portfolio(spark, path).where("scenario_name = 'BASELINE'")
    ranks_near(rows, profile.where("scenario_name = 'BASELINE'"), columns)
    # a rebuilt scenario: its old sketches count no more, the other's are kept
    build_portfolio(key_table(spark, 1000), [replace(scenarios[1], application_count=1000)], path)
    assert len(K.update_sketches(spark, path, columns)) == 1
    assert {(r.scenario_name, r.n) for r in K.portfolio_profile(spark, path).collect()} == {("BASELINE", 3500), ("a/b=c %{d}", 1000)}
    whole = K.portfolio_profile(spark, path, by=()).where("variable_name = 'credit_score'").first()
    assert whole.n == 4500


def test_small_sketches_keep_their_error(spark):
    df = spark.range(200_000).selectExpr("CAST(pmod(xxhash64(id), 100000) AS DOUBLE) AS x", "CAST('NaN' AS DOUBLE) AS y", "id % 3 AS g")
    parts = [K.sketch(df.where(f"g = {i}"), ["x", "y"], (), 200) for i in range(3)]
    merged = K.merged(parts[0].unionAll(parts[1]).unionAll(parts[2]), k=200)
    ranks_near(df, merged, ["x"])
    assert merged.count() == 1  # a column of NaN has no values


# two-scan reports


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_profile_counts_nan_and_keeps_wide_values(spark):
    wide = 9007199254740993
    rows = [(wide + 2 * i, Decimal(wide + i) / 100, float(i), i) for i in range(4)] + [(None, None, float("nan"), None)] * 2
    df = spark.createDataFrame(rows, "a long, b decimal(20,2), c double, d int")
    got = {r.variable_name: r for r in R.profile(df, {"a": 2, "b": 4, "c": 2, "d": 2}, count_nan=True).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.n, a.n_nan, int(a.min_val), int(a.max_val)) == (4, 0, wide, wide + 6)
    assert (a.p25, a.median, a.p75) == (Decimal(wide) + Decimal("1.5"), Decimal(wide + 3), Decimal(wide) + Decimal("4.5"))
    assert b.median == (Decimal(wide) + Decimal("1.5")) / 100 and b.mean is not None
    assert (c.n, c.n_nan, c.median, c.mean, c.max_val, got["d"].n_nan) == (4, 2, Decimal("1.5"), Decimal("1.5"), 3, 0)
    assert "n_nan" not in R.profile(df, {"a": 2}).columns


@pytest.mark.parametrize("path", ["windows", "too many values", "missed"])
def test_quantiles_by_windows_and_beyond(spark, monkeypatch, path):
    df = spark.range(30_000).selectExpr(
        "CAST(id % 7 AS INT) AS g", "CAST(pmod(xxhash64(id), 997) AS DOUBLE) AS x", "CAST(pmod(id * 31, 5) AS DECIMAL(8,2)) AS t",
        "if(id % 11 = 0, NULL, CAST(pow(pmod(xxhash64(id, 3), 1000), 3) AS BIGINT)) AS y",
    )
    if path == "too many values":
        monkeypatch.setattr(Q, "WINDOW_VALUES", 10)
    if path == "missed":
        real = Q._outward  # windows that hold nothing
        monkeypatch.setattr(Q, "_outward", lambda edges, at, kind, side: real(edges, at, kind, side) and type(edges[0])(10**6 - 1))
    wanted = {f"{c}_{int(p * 100)}": (c, p) for c in ("x", "t", "y") for p in (0.1, 0.5, 0.99)}
    got = {r.g: r for r in Q.aggregate_with_quantiles(df, ["g"], {"n": "count(*)"}, wanted).collect()}
    for row in df.groupBy("g").agg(*[F.expr(f"percentile({c}, {p}D)").alias(n) for n, (c, p) in wanted.items()]).collect():
        for name in wanted:
            assert math.isclose(float(got[row.g][name]), row[name], rel_tol=1e-12), (name, row.g)
    assert sum(r.n for r in got.values()) == 30_000
    one = Q.aggregate_with_quantiles(df, [], {"n": "count(*)"}, {"m": ("x", 0.5)}).first()
    assert (one.n, one.m) == (30_000, df.selectExpr("percentile(x, 0.5D)").first()[0])
    none = Q.aggregate_with_quantiles(df.limit(0), [], {"n": "count(*)"}, {"m": ("x", 0.5)}).first()
    assert (none.n, none.m) == (0, None)


def test_a_share_needs_no_second_scan(baseline):
    report = R.segment_profile(baseline, "score_band", [R.avg("a", "annual_income")])
    report.collect()
    text = report._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan") <= 1 or "ReusedExchange" in final or "ReusedSubquery" in final


def test_staged_tables_can_go(spark):
    held = stage(spark.range(5), "held")
    file = held.inputFiles()[0]
    unstage(held)
    with pytest.raises(Exception, match="(?i)not.exist|PATH_NOT_FOUND|No such file"):
        spark.read.parquet(file).count()
