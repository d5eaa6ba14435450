"""Stored tables, report files, the review and streams."""

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.calibration import BANDS
from tallybook.operators import expectations as X
from tallybook.operators import reports as R
from tallybook.params import Scenario, scenarios_df
from tallybook.plans.build import build_portfolio
from tallybook.plans.portfolio import score_portfolio, score_scenarios
from tallybook.plans.review import expectations, write_review
from tallybook.sources.keys import key_table
from tallybook.sources.store import (
    read_portfolio,
    read_report,
    shared_dir,
    stage,
    write_portfolio,
    write_report,
)
from tallybook.streaming.scoring import append_portfolio, report_batches, score_stream

BASE = Scenario()
UP = replace(BASE, scenario_name="UP", rate_shift_bps=200)


def test_rebuild_replaces_only_its_scenario(spark, tmp_path):
    path = str(tmp_path / "p")
    write_portfolio(score_scenarios(key_table(spark, 300), [BASE, UP]), path)
    write_portfolio(score_portfolio(key_table(spark, 100), UP), path)
    counts = read_portfolio(spark, path).groupBy("scenario_name").count().collect()
    assert {r[0]: r[1] for r in counts} == {"BASELINE": 300, "UP": 100}


def counted(n, *scenarios):
    return [replace(s, application_count=n) for s in scenarios]


def test_build_job(spark, tmp_path):
    path = str(tmp_path / "p")
    build_portfolio(key_table(spark, 300), counted(300, BASE, UP), path)
    built = build_portfolio(key_table(spark, 200), counted(200, UP), path)
    assert built.count() == 200
    assert read_portfolio(spark, path).count() == 500


def test_failed_build_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    build_portfolio(key_table(spark, 20), counted(20, UP), path)
    bad = {
        "base_rates": (key_table(spark, 1), counted(1, replace(UP, base_rate_auto=0))),
        "application_count": (key_table(spark, 20), counted(50000, UP)),
        "key_present": (spark.createDataFrame([(1,), (None,)], "application_seq long"), counted(2, UP)),
        "key_unique": (spark.createDataFrame([(1,), (1,), (2,)], "application_seq long"), counted(3, UP)),
        "key_fits_width": (spark.createDataFrame([(10**8,)], "application_seq long"), counted(1, UP)),
        "key_not_negative": (spark.createDataFrame([(-5,)], "application_seq long"), counted(1, UP)),
    }
    for rule, (keys, scenarios) in bad.items():
        with pytest.raises(ValueError, match=rule):
            build_portfolio(keys, scenarios, path)
    assert read_portfolio(spark, path).count() == 20


def test_names_are_not_joined(spark, tmp_path):
    path = str(tmp_path / "p")
    a = replace(BASE, scenario_name="A|B", population_id="C", application_count=5)
    b = replace(BASE, scenario_name="A", population_id="B|C", application_count=5)
    build_portfolio(key_table(spark, 5), [a], path)
    assert build_portfolio(key_table(spark, 5), [b], path).count() == 5


def test_files_follow_the_data(spark, tmp_path):
    path = str(tmp_path / "p")
    scenarios = [replace(BASE, scenario_name=f"S{i}") for i in range(4)]
    write_portfolio(score_scenarios(key_table(spark, 2000, 16), scenarios), path)
    assert len(read_portfolio(spark, path).inputFiles()) <= 8


def test_sweep_from_a_parameter_table(spark):
    table = scenarios_df(spark, [BASE, UP])
    assert score_scenarios(key_table(spark, 50), table).count() == 100


def test_many_scenarios_in_slices(spark, monkeypatch):
    from tallybook.plans import portfolio

    monkeypatch.setattr(portfolio, "SLICE", 2)
    many = [replace(BASE, scenario_name=f"S{i}") for i in range(5)]
    rows = score_scenarios(key_table(spark, 4), scenarios_df(spark, many)).groupBy("scenario_name").count()
    assert {r[0]: r[1] for r in rows.collect()} == {s.scenario_name: 4 for s in many}


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)
    assert shared_dir(spark) in staged.inputFiles()[0]


def test_report_files_round_trip(spark, baseline, tmp_path):
    path = str(tmp_path / "mix")
    report = R.band_mix(baseline)
    write_report(report, path)
    back = read_report(spark, path, report.schema)
    assert sorted(back.collect()) == sorted(report.collect())


def test_report_file_with_nulls(spark, tmp_path):
    path = str(tmp_path / "head")
    head = R.sample_head(baseline_small(spark), k=20).drop("created_ts")
    write_report(head, path)
    back = read_report(spark, path, head.schema)
    assert back.where("loan_term_months IS NULL").count() == (
        head.where("product_type = 'REVOLVING_LINE'").count()
    )


def baseline_small(spark):
    return score_portfolio(key_table(spark, 100))


def test_write_review(spark, baseline, tmp_path):
    write_review(baseline, str(tmp_path), ("record_count", "product_mix"))
    counts = read_report(spark, str(tmp_path / "record_count"), "application_count long")
    assert counts.first()[0] == 50000


def test_expectations_of_the_baseline(baseline):
    rows = {r.rule: r for r in expectations(baseline).collect()}
    assert len(rows) == 13 and all(r.ok for r in rows.values())


def test_expectations_find_trouble(spark, baseline):
    bands = R.band_profile(baseline)
    wrong = X.trends(bands, "score_band", BANDS, {"avg_expected_loss": True}).first()
    assert not wrong.ok and wrong.observed == 1.0
    some = X.trends(bands, "score_band", ("PRIME", "NONE", "SUBPRIME"), {"avg_pd": True}).first()
    assert some.ok and some.observed == 0.0
    assert X.trends(bands, "score_band", ("NONE",), {"avg_pd": True}).first().ok
    off = X.near_target(R.band_mix(baseline), "score_band", {"PRIME": 40.0}, 1.0).first()
    assert not off.ok and off.observed > 11
    assert not X.at_limit(baseline, "estimated_pd", "0.45", 0.01).first().ok


def test_mix_of_many_labels_and_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    rows = [tuple(r) for r in R.mix(df, "k").collect()]
    assert rows[0] == ("a", 2, Decimal("50.00"))
    assert {r[0]: r[2] for r in rows[1:]} == {None: Decimal("25.00"), "b": Decimal("25.00")}


def test_segment_profile_null_group_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("b", 5.0)], "k string, v double")
    rows = R.segment_profile(df, "k", [R.median("mid", "v"), R.avg("mean", "v")]).collect()
    assert {r.k: (r.mid, r.mean) for r in rows} == {
        None: (Decimal("1.50"), Decimal("1.50")),
        "b": (Decimal("5.00"), Decimal("5.00")),
    }


def test_bucket_takes_null_in_last_label(spark):
    df = spark.sql("SELECT * FROM VALUES (0.05BD), (0.0499BD), (NULL) AS t(v)")
    got = df.select(R.bucket("v", ("0.05", "0.10"), ("low", "mid", "rest")).alias("b")).collect()
    assert [r.b for r in got] == ["mid", "low", "rest"]


def test_rate_counts_null_as_false(spark):
    df = spark.createDataFrame([(True,), (None,), (False,), (True,)], "f boolean")
    row = R.segment_profile(df.withColumn("g", F.lit(1)), "g", [R.rate("r", "f")]).first()
    assert row.r == Decimal("0.5000")


def test_approx_profile_is_close(baseline):
    near = {r.variable_name: r.median for r in R.approx_profile(baseline, ["annual_income"]).collect()}
    assert abs(near["annual_income"] - 118422.23) < 200


def test_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (1, 2):
        keys = key_table(spark, 400).where(F.col("application_seq") % 2 == part - 1)
        keys.write.mode("append").parquet(source)
    stream = spark.readStream.schema("application_seq long").parquet(source)
    append_portfolio(score_stream(stream), out, str(tmp_path / "c1")).awaitTermination(120)
    got = read_portfolio(spark, out).drop("created_ts")
    want = score_portfolio(key_table(spark, 400)).drop("created_ts")
    assert got.exceptAll(want).count() == 0 and got.count() == 400


def test_batch_reports(spark, tmp_path):
    source = str(tmp_path / "in")
    key_table(spark, 200).write.parquet(source)
    stream = spark.readStream.schema("application_seq long").parquet(source)
    seen = []
    report_batches(
        score_stream(stream), lambda df, _: seen.append(R.record_count(df).first()[0]),
        str(tmp_path / "c2"),
    ).awaitTermination(120)
    assert sum(seen) == 200


def test_a_build_moves_keys_and_not_rows(spark, tmp_path, monkeypatch):
    from tallybook.plans import build
    from tallybook.sources import keys

    monkeypatch.setattr(keys, "MOST_KEYS", 10)
    plans = []
    plain = build.write_folder

    def seen(df, path, **how):
        plans.append((df.rdd.getNumPartitions(), how))
        return plain(df, path, **how)

    monkeypatch.setattr(build, "write_folder", seen)
    path = str(tmp_path / "p")
    at_once = spark.sparkContext.defaultParallelism
    for n in (5, 400):
        scenarios = [replace(s, application_count=n) for s in (BASE, UP)]
        assert build_portfolio(key_table(spark, n), scenarios, path).count() == 2 * n
    assert plans == [(1, {"dealt": True}), (at_once * -(-400 // (10 * at_once)), {"dealt": True})]
