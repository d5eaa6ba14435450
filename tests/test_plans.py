"""What the plans must and must not contain."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallybook.functions.draws import with_draws
from tallybook.operators import reports as R
from tallybook.params import Scenario
from tallybook.plans.portfolio import (
    compare_scenarios,
    match_scenarios,
    score_portfolio,
    score_scenarios,
)
from tallybook.plans.review import review
from tallybook.sources.keys import key_table, keyed, with_ids
from tallybook.sources.store import (
    create_database,
    read_portfolio,
    save_portfolio_table,
    write_portfolio,
)

BASE = Scenario()
UP = replace(BASE, scenario_name="UP", rate_shift_bps=200)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    utils = df.sparkSession._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def test_scoring_is_map_only(spark):
    text = plan(score_portfolio(key_table(spark, 1000)))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_sweep_is_map_only(spark):
    text = plan(score_scenarios(key_table(spark, 1000), [BASE, UP]))
    assert "Exchange" not in text and "Join" not in text


def test_unused_draws_are_pruned(spark):
    text = plan(with_draws(with_ids(key_table(spark, 1000)), "application_id", "'P'").select("u3"))
    assert text.count("md5(") == 1


def test_a_filter_does_not_repeat_the_draws(spark):
    text = plan(R.large_exposure_low_pti(score_portfolio(key_table(spark, 1000))))
    assert text.count("md5(") <= 15 and "Exchange" not in text


def test_keys_are_spread_on_demand_and_without_a_job(spark):
    ids = spark.range(0, 1000, 1, 4).withColumnRenamed("id", "k")
    grouped = ids.groupBy("k").count()
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert "Exchange" not in plan(keyed(ids, "k"))
    assert "Exchange" in plan(keyed(ids, "k", 16))
    keyed(grouped, "k", 16)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_comparison_scans_and_exchanges_once(spark, tmp_path):
    path = str(tmp_path / "p")
    write_portfolio(score_scenarios(key_table(spark, 300), [BASE, UP]), path)
    text = plan(match_scenarios(read_portfolio(spark, path), "BASELINE", "UP", ["product_type"], ["estimated_pd"]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_repeated_keys_are_refused(spark):
    keys = spark.createDataFrame([(1,), (1,), (2,)], "application_seq long")
    with pytest.raises(Exception, match="application repeated"):
        compare_scenarios(score_scenarios(keys, [BASE, UP]), "BASELINE", "UP").collect()


def test_matrix_scans_once(baseline):
    text = plan(R.matrix(baseline, ("product_type", "score_band"), R.CELL_METRICS))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_spot_check_pushes_down(baseline):
    text = plan(R.strong_credit_high_pti(baseline))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "GreaterThanOrEqual(credit_score,700)" in formatted(R.strong_credit_high_pti(baseline))


def test_report_reads_only_its_columns(baseline):
    text = plan(R.mix(baseline, "product_type"))
    assert "ReadSchema: struct<product_type:string>" in text


def test_share_has_no_global_window(baseline):
    assert "Window" not in plan(R.mix(baseline, "product_type"))


def test_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    write_portfolio(score_scenarios(key_table(spark, 200), [BASE, UP]), path)
    text = plan(read_portfolio(spark, path).where(F.col("scenario_name") == "UP").select("credit_score"))
    assert "PartitionFilters: [isnotnull(scenario_name" in text


@pytest.mark.parametrize("buckets", [4])
def test_bucketed_compare_joins_in_place(spark, buckets):
    create_database(spark, "books")
    rows = score_scenarios(key_table(spark, 400), [BASE, UP])
    save_portfolio_table(rows, "books.portfolio", buckets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        saved = spark.table("books.portfolio")
        text = plan(match_scenarios(saved, "BASELINE", "UP", ["product_type"], ["estimated_pd"]))
        assert "Exchange" not in text
        total = compare_scenarios(saved, "BASELINE", "UP", ("population_id",)).first()
        assert total.matched == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_review_is_lazy(spark, baseline):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    reports = review(baseline)
    reports["record_count"]
    assert len(tracker.getJobIdsForGroup(None)) == before and len(reports) == 13


def test_profile_keeps_wide_integers(spark):
    df = spark.createDataFrame([(9007199254740993, 1.0), (None, None)], "a long, b double")
    rows = {r.variable_name: r for r in R.profile(df, {"a": 2, "b": 2}).collect()}
    assert int(rows["a"].max_val) == 9007199254740993 and (rows["a"].n, rows["b"].n) == (1, 1)


def orders_of(spark, path, n):
    spark.range(n).selectExpr("id AS o_orderkey").write.parquet(f"{path}/{n}/orders.parquet")
    return f"{path}/{n}"


def test_tasks_grow_with_the_orders(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry
    from tallybook.sources import keys

    monkeypatch.setattr(keys, "MOST_KEYS", 10)
    at_once = spark.sparkContext.defaultParallelism
    few, many = (entry.order_keys(spark, orders_of(spark, tmp_path, n)).rdd.getNumPartitions() for n in (40, 400))
    assert few == at_once and many == at_once * -(-400 // (10 * at_once)) and many * 10 >= 400


def test_the_mix_needs_two_draws(spark, tmp_path):
    import __spark_entry__ as entry

    path = orders_of(spark, tmp_path, 50)
    text = plan(entry.mix_fits_targets(spark, path))
    assert text.count("md5(") == 2 and "ReadSchema: struct<o_orderkey:bigint>" in text


def test_a_bucket_is_one_file_a_scenario(spark, tmp_path):
    import __spark_entry__ as entry

    create_database(spark, "tallybook_reports")
    known = {t.name for t in spark.catalog.listTables("tallybook_reports")}
    assert entry.bucketed_compare(spark, orders_of(spark, tmp_path, 3000)).selectExpr("sum(matched)").first()[0] == 3000
    (new,) = {t.name for t in spark.catalog.listTables("tallybook_reports")} - known
    assert len(spark.table(f"tallybook_reports.{new}").inputFiles()) <= 8 * 3
