
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal
from importlib.util import find_spec

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle
from tallybook.calibration import BAND_WEIGHT, BANDS, DEFAULT, PRODUCT_WEIGHT
from tallybook.functions import draws as D
from tallybook.functions.draws import add
from tallybook.functions.numeric import text
from tallybook.operators import reports as R
from tallybook.operators import structure as S
from tallybook.operators.borrower import (
    with_borrower,
    with_capacity,
    with_credit_file,
    with_flags,
    with_score_and_term,
    with_segments,
)
from tallybook.operators.expectations import mix_fits
from tallybook.operators.risk import expected_loss, scorecard_pd, with_risk
from tallybook.operators.scorecard import with_points
from tallybook.operators.sketches import PROBS, portfolio_profile
from tallybook.operators.structure import with_base_amount, with_structure
from tallybook.operators.validate import (
    domain_check,
    key_checks,
    row_count_check,
    validate_scenarios,
)
from tallybook.params import FIELD_NAMES, Scenario, bind, literal
from tallybook.plans.attribution import attribute
from tallybook.plans.build import build_portfolio
from tallybook.plans.portfolio import compare_scenarios, score_portfolio, score_scenarios
from tallybook.plans.review import expectations
from tallybook.schema import MULTIPLIERS
from tallybook.session import configure
from tallybook.sources.keys import key_table, keyed, tasks_for, with_ids
from tallybook.sources.snapshots import append_batch
from tallybook.sources.store import (
    create_database,
    read_portfolio,
    read_report,
    save_portfolio_table,
    shared_dir,
    stage,
    write_report,
)
from tallybook.streaming.scoring import append_portfolio, score_stream

# The corpus queries are there if their folder is; a library that they lack is an error, not fewer queries.
if find_spec("tallybook.llm") and find_spec("tallybook.llm.queries") and find_spec("corpus_pipeline"):
    from tallybook.llm import queries as corpus
else:
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

BASE = Scenario()
STRESS = replace(BASE, scenario_name="RATE_STRESS_UP_200BP", rate_shift_bps=200)
TIGHT = replace(
    BASE,
    scenario_name="TIGHTER_CREDIT_BOX",
    pct_super_prime=Decimal("0.26"),
    pct_prime=Decimal("0.34"),
    pct_near_prime=Decimal("0.24"),
    pct_subprime=Decimal("0.12"),
    pct_deep_subprime=Decimal("0.04"),
    max_mortgage_amt=Decimal("900000"),
    lgd_revolving=Decimal("0.80"),
)
SWEEP = (BASE, STRESS, TIGHT)

_staged: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(configure(spark), sf_dir, "orders")
    spread = max(spark.sparkContext.defaultParallelism, tasks_for(spark, orders.count()))
    return keyed(orders, "o_orderkey", spread)


def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = with_ids(order_keys(spark, sf_dir))
    return D.with_draws(keys, "application_id", text(BASE.population_id))


def borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_borrower(draws(spark, sf_dir), bind([BASE]))


def structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_structure(borrowers(spark, sf_dir), bind([BASE]))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_risk(structured(spark, sf_dir), bind([BASE]))


def staged(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    """A table that several reports scan: written once per session, then read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        _staged[key] = stage(build(spark, sf_dir), name)
    return _staged[key]


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(
        configure(spark),
        sf_dir,
        "portfolio",
        lambda s, d: score_portfolio(order_keys(s, d), BASE),
    )


def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(
        configure(spark),
        sf_dir,
        "sweep",
        lambda s, d: score_scenarios(order_keys(s, d), SWEEP),
    )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, so that any client compares them alike."""

    def column(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType) or f.name == "loan_term_months":
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[column(f) for f in df.schema if f.name != "created_ts"])


def pick(source: Query, *columns: str) -> Query:
    return lambda spark, sf_dir: plain(
        source(spark, sf_dir).select("application_id", *columns)
    )


def report(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(portfolio(spark, sf_dir)))


def ordered_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws for every order, beside its date, price, priority and its customer's balance."""
    orders, customers = (table(configure(spark), sf_dir, n) for n in ("orders", "customer"))
    known = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").selectExpr(
        "CAST(o_orderkey AS BIGINT) AS application_seq", "o_orderpriority", "o_totalprice", "o_orderdate", "c_acctbal"
    )
    return D.with_draws(with_ids(known), "application_id", text(BASE.population_id))


def order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as applications: dated as they are, product by priority, band by the customer's balance."""
    products = ", ".join(text(p) for p in PRODUCT_WEIGHT)
    bands = R.bucket("c_acctbal", ("0D", "2500D", "5000D", "7500D"), BANDS[::-1])
    labelled = add(
        ordered_draws(spark, sf_dir),
        application_date="CAST(o_orderdate AS DATE)",
        product_type=f"element_at(array({products}), CAST(substr(o_orderpriority, 1, 1) AS INT))",
    )
    return labelled.withColumn("score_band", F.when(F.col("c_acctbal").isNull(), BANDS[-1]).otherwise(bands))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_base_amount(with_score_and_term(order_segments(spark, sf_dir)), bind([BASE]))


def order_borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segmented = with_score_and_term(order_segments(spark, sf_dir))
    return with_flags(with_credit_file(with_capacity(segmented, bind([BASE]))))


def category_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weighted category for every order, and what each priority sends to it."""
    weights = {p: bind([BASE])(w) for p, w in PRODUCT_WEIGHT.items()}
    drawn = add(ordered_draws(spark, sf_dir), kind=D.draw_category("u2", weights), price="CAST(o_totalprice AS DECIMAL(18,2))")
    by = drawn.groupBy("o_orderpriority", "kind")
    return plain(by.agg(F.count("*").alias("applications"), F.sum("price").alias("price")))


def ladder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ("score_band", "delinquency_count_12m")
    return order_borrowers(spark, sf_dir).groupBy(*by).agg(F.count("*").alias("applications"))


def flag_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = ("major_derogatory", "bankruptcy", "prequalified", "returning_customer")
    rates = [R.rate(f"{f}_rate", f"{f}_flag", 4) for f in flags]
    return plain(R.segment_profile(order_borrowers(spark, sf_dir), "score_band", rates))


def customer_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shaped draws, draws with outliers and counts with a tail, by market segment and within real balances."""
    segment, rest = "c_mktsegment", "*"
    u = {i: D.hash_uniform("CAST(c_custkey AS STRING)", "'SEGMENT_V1'", f"u{i}") for i in range(1, 6)}
    shapes = {"BUILDING": (-1000, 8000, 0.65), rest: (500, 9000, 1.0)}
    ranges = {"BUILDING": (0.18, 0.22), rest: (0.3, 0.25)}
    outliers = {"below": (0.08, 0.15), "above": (0.93, 0.10)}
    counts = {"BUILDING": (6, 12, 0.93, 8), rest: (1, 8, 0.98, 7)}
    drawn = add(
        table(configure(spark), sf_dir, "customer"),
        balance=D.draw_power_by(segment, u[1], shapes, "-500D", "c_acctbal + 5000D"),
        share=D.draw_with_outliers(segment, u[2], u[3], ranges, outliers, "0.05D", "0.7D"),
        lines=D.draw_count_with_tail(segment, u[4], u[5], counts, (1, 25)),
    )
    return plain(drawn.select("c_custkey", "c_mktsegment", "balance", "share", "lines"))


def mix_fits_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Do products and bands come as often as the scenario says, for this many rows?

    The labels follow from two draws; nothing else of the portfolio is computed or stored for them.
    """
    rows = with_segments(draws(spark, sf_dir), bind([BASE]))
    checks = [
        mix_fits(rows, label, {k: float(getattr(BASE, w)) for k, w in weights.items()})
        for label, weights in (("product_type", PRODUCT_WEIGHT), ("score_band", BAND_WEIGHT))
    ]
    return checks[0].unionByName(checks[1]).select("rule", "ok", F.round("observed", 6).alias("observed"))


def sketched_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile merged from the sketches of two slices; ``near`` if the ranks of all quartiles are within the error."""
    keys = order_keys(spark, sf_dir)
    path = workspace(spark, "sketched")
    build_portfolio(keys, (replace(BASE, application_count=keys.count()),), path)
    portfolio_profile(spark, path)
    added = keyed(table(spark, sf_dir, "customer"), "c_custkey").selectExpr("application_seq + 50000000 AS application_seq")
    append_batch(score_portfolio(added, BASE), 0, path, "customers")
    rows = portfolio_profile(spark, path).collect()  # one row a variable
    tests = []
    for r in rows:
        for name, p in PROBS.items():
            value = f"{r[name]!r}D"
            below, upto = (f"count_if(CAST({r.variable_name} AS DOUBLE) {op} {value}) / count({r.variable_name})" for op in ("<", "<="))
            tests.append(f"({below} <= {p + r.rank_error} AND {upto} >= {p - r.rank_error}) AS {r.variable_name}_{name}")
    near = read_portfolio(spark, path).agg(*[F.expr(t) for t in tests]).first()
    told = [
        (r.variable_name, r.n, r.min_val, r.max_val, r["mean"], all(near[f"{r.variable_name}_{p}"] for p in PROBS)) for r in rows
    ]
    shown = spark.createDataFrame(told, "variable_name string, n long, min_val double, max_val double, mean double, near boolean")
    digits = F.expr("CASE " + " ".join(f"WHEN variable_name = '{c}' THEN {R.report_value('mean', s)}" for c, s in R.PROFILE_SCALES.items()) + " END")
    return shown.withColumn("mean", digits.cast("double"))


def lineitem_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of every line item by a table of breakpoints, its PD, LGD and expected loss."""
    breakpoints = spark.sql(
        "SELECT * FROM VALUES ('discount', NULL, 0.02D, 0.90BD), ('discount', 0.02D, 0.05D, 1.00BD), ('discount', 0.05D, 0.08D, 1.15BD),"
        " ('discount', 0.08D, NULL, 1.40BD), ('quantity', NULL, 5D, 1.20BD), ('quantity', 5D, 20D, 1.05BD), ('quantity', 20D, 40D, 1.00BD),"
        " ('quantity', 40D, NULL, 0.95BD), ('age', NULL, 0D, 1.30BD), ('age', 0D, 365D, 1.10BD), ('age', 365D, NULL, 1.00BD)"
        " AS t(characteristic, low, high, points)"
    )
    values = {"discount": "l_discount", "quantity": "l_quantity", "age": "CAST(datediff(l_shipdate, DATE'1995-01-01') AS DOUBLE)"}
    lines = with_points(table(configure(spark), sf_dir, "lineitem"), breakpoints, values)
    lines = add(
        lines,
        base="CASE l_returnflag WHEN 'R' THEN 0.14BD WHEN 'A' THEN 0.06BD ELSE 0.025BD END",
        lgd="CASE l_linestatus WHEN 'F' THEN 0.45BD ELSE 0.70BD END",
    )
    factors = ("base", *(f"points_{n}" for n in values))
    lines = add(lines, pd=scorecard_pd(factors, "0D", replace(DEFAULT, pd_jitter=(1.0, 0.0))))
    lines = add(lines, loss=expected_loss("l_extendedprice", "pd", "lgd"))
    return plain(lines.select("l_orderkey", "l_linenumber", *factors[1:], "pd", "loss"))


def expected_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = add(
        scored(spark, sf_dir),
        recomputed_loss=expected_loss("requested_amount", "estimated_pd", "estimated_lgd"),
    )
    columns = ("estimated_pd", "estimated_lgd", "expected_loss_amount", "recomputed_loss")
    return plain(losses.select("application_id", *columns))


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tallybook-{uuid.uuid4().hex}/{name}"


def stored_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build two scenarios in one folder, rebuild one of them, and read both back."""
    keys = order_keys(spark, sf_dir)
    path = workspace(spark, "portfolio")
    n = keys.count()
    base, stress = (replace(s, application_count=n) for s in (BASE, STRESS))
    build_portfolio(keys, (base, stress), path)
    build_portfolio(keys, (stress,), path)
    counts = read_portfolio(spark, path).groupBy("scenario_name", "population_id")
    return plain(
        counts.agg(
            F.count("*").alias("applications"),
            F.sum("expected_loss_amount").alias("expected_loss"),
        )
    )


def streamed_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the orders as a file stream, append them to a portfolio and read it back."""
    orders = table(configure(spark), sf_dir, "orders")
    files = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
    stream = files.parquet(sf_dir)
    keys = stream.selectExpr("o_orderkey AS application_seq")
    path = workspace(spark, "streamed")
    append_portfolio(score_stream(keys, (BASE,)), path, f"{path}_progress").awaitTermination()
    columns = ("application_id", "product_type", "requested_amount", "expected_loss_amount")
    return plain(read_portfolio(spark, path).select(*columns))


def shared_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One portfolio that a batch job builds, a stream of customers extends, and the job builds again."""
    keys = order_keys(spark, sf_dir)
    path = workspace(spark, "shared")
    n = keys.count()
    base, stress = (replace(s, application_count=n) for s in (BASE, STRESS))
    build_portfolio(keys, (base, stress), path)
    customers = table(spark, sf_dir, "customer")
    files = spark.readStream.schema(customers.schema).option("pathGlobFilter", "customer.parquet")
    added = files.parquet(sf_dir).selectExpr("c_custkey + 50000000 AS application_seq")
    for _ in range(2):  # started again, the stream adds nothing more
        append_portfolio(score_stream(added, (BASE,)), path, f"{path}_progress").awaitTermination()
    build_portfolio(keys, (base,), path)
    counts = read_portfolio(spark, path).groupBy("scenario_name", "product_type")
    return plain(counts.agg(F.count("*").alias("applications"), F.sum("expected_loss_amount").alias("expected_loss")))


def attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change from the baseline to the tighter scenario, by product and changed factor."""
    return plain(attribute(order_keys(spark, sf_dir), BASE, TIGHT))


def region_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parameter table with one scenario per region."""
    changed = {
        "scenario_name": "concat('REGION_', r_regionkey)",
        "rate_shift_bps": "CAST(50 * r_regionkey AS INT)",
        "max_income": "CAST(240000 - 30000 * r_regionkey AS DECIMAL(18,2))",
        "lgd_auto": "CAST((45 + 5 * r_regionkey) * 0.01BD AS DECIMAL(12,6))",
        "max_auto_amt": "CAST(80000 - 10000 * (r_regionkey % 2) AS DECIMAL(18,2))",
    }
    every = {n: literal(n, getattr(BASE, n)) for n in FIELD_NAMES} | changed
    return table(configure(spark), sf_dir, "region").selectExpr(*[f"{every[n]} AS {n}" for n in FIELD_NAMES])


def scenario_table_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order under every scenario of a parameter table."""
    rows = score_scenarios(order_keys(spark, sf_dir), region_scenarios(spark, sf_dir), audit=False)
    by = rows.groupBy("scenario_name", "product_type")
    return plain(
        by.agg(
            F.count("*").alias("applications"),
            F.sum("annual_income").alias("income"),
            F.sum("base_apr_for_payment_calc").alias("apr"),
            F.sum("expected_loss_amount").alias("expected_loss"),
        )
    )


def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = with_ids(order_keys(spark, sf_dir))
    salts = ("u1", "u8", "u15")
    hashed = [
        f"{D.draw_hash('application_id', text(BASE.population_id), u)} AS h_{u}" for u in salts
    ]
    return keys.selectExpr("application_id", *hashed)


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sweep(spark, sf_dir)
    return plain(compare_scenarios(rows, BASE.scenario_name, STRESS.scenario_name))


def compared_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sweep(spark, sf_dir)
    return plain(
        compare_scenarios(rows, BASE.scenario_name, TIGHT.scenario_name, ("score_band",))
    )


def sweep_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(R.matrix(sweep(spark, sf_dir), ("scenario_name", "product_type"), R.PRODUCT_METRICS))


def sweep_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_scenarios(order_keys(spark, sf_dir), SWEEP, audit=False)
    columns = (
        "scenario_name",
        "application_id",
        "score_band",
        "requested_amount",
        "base_apr_for_payment_calc",
        "monthly_payment_proxy",
        "estimated_pd",
        "expected_loss_amount",
    )
    return plain(rows.select(*columns))


def customer_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter row per customer; many break a rule."""
    changed = {
        "scenario_name": "c_name",
        "population_id": "c_mktsegment",
        "application_count": "CAST(c_custkey % 7 - 1 AS INT)",
        "portfolio_start_date": "date_add(DATE'2025-01-01', CAST(c_custkey % 40 AS INT))",
        "portfolio_end_date": "DATE'2025-01-31'",
        "anchor_date": "date_add(DATE'2025-01-25', CAST(c_custkey % 13 AS INT))",
        "pct_mortgage": "CAST(0.3 + (c_custkey % 5) * 0.00001 AS DECIMAL(12,6))",
        "pct_prime": "CAST(if(c_custkey % 9 = 0, NULL, 0.28 - (c_custkey % 3) * 0.29) AS DECIMAL(12,6))",
        "pct_near_prime": "CAST(0.24 + (c_custkey % 6) * 0.145 AS DECIMAL(12,6))",
        "min_credit_score": "CAST(500 + (c_custkey % 11) * 40 AS INT)",
        "min_income": "CAST(c_acctbal AS DECIMAL(18,2))",
        "max_income": "CAST(5000 AS DECIMAL(18,2))",
        "min_dti": "CAST(c_nationkey * 0.05 - 0.05 AS DECIMAL(12,4))",
        "max_utilization": "CAST(c_nationkey * 0.05 AS DECIMAL(12,4))",
        "min_auto_amt": "CAST(c_acctbal * 12 AS DECIMAL(18,2))",
        "base_rate_auto": "CAST((c_custkey % 10) * 0.01 AS DECIMAL(12,6))",
        "lgd_heloc": "CAST((c_custkey % 12) * 0.1 AS DECIMAL(12,6))",
    }
    rest = {n: literal(n, getattr(BASE, n)) for n in FIELD_NAMES if n not in changed}
    every = changed | rest
    return table(configure(spark), sf_dir, "customer").selectExpr(
        *[f"{every[n]} AS {n}" for n in FIELD_NAMES]
    )


def param_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = validate_scenarios(customer_scenarios(spark, sf_dir), strict=True)
    return checks.select("scenario_name", "rule", "ok")


def output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portfolio(spark, sf_dir)
    expected = table(spark, sf_dir, "orders").count()
    return row_count_check(rows, expected).unionByName(domain_check(rows))


def document_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = D.hash_uniform("CAST(doc_id AS STRING)", "'SPLIT_V1'", "u1")
    shares = {"train": "0.8BD", "valid": "0.1BD", "test": "0.1BD"}
    docs = add(table(configure(spark), sf_dir, "documents"), split=D.draw_category(u, shares))
    by = docs.groupBy("lang", "split")
    return by.agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


def lineitem_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment and affordability of every line item, taken as an application."""
    lines = table(configure(spark), sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE l_linenumber % 3 WHEN 0 THEN 'AUTO_LOAN' WHEN 1 THEN 'REVOLVING_LINE'"
        " ELSE 'HELOC' END AS product_type",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount",
        "CAST(0.05 + l_tax AS DECIMAL(12,6)) AS apr",
        "CAST(12 * (1 + l_partkey % 5) AS INT) AS term",
        "CAST(l_quantity * 1000 AS DECIMAL(18,2)) AS income",
    )
    paid = add(
        lines,
        payment=S.monthly_payment("product_type", "amount", "apr", "term"),
        amount_ratio=S.amount_to_income("amount", "income"),
    )
    paid = add(paid, payment_ratio=S.payment_to_income("payment", "income"))
    keep = ("l_orderkey", "l_linenumber", "product_type", "payment", "amount_ratio", "payment_ratio")
    return plain(paid.select(*keep))


def lineitem_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    scales = {"l_quantity": 2, "l_extendedprice": 2, "l_discount": 4, "l_tax": 4}
    return plain(R.profile(table(configure(spark), sf_dir, "lineitem"), scales))


def lineitem_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = (
        R.avg("avg_quantity", "l_quantity"),
        R.median("median_price", "l_extendedprice"),
        R.avg("avg_discount", "l_discount", 4),
        R.median("median_discount", "l_discount", 4),
    )
    lines = table(configure(spark), sf_dir, "lineitem")
    return plain(R.segment_profile(lines, ("l_returnflag", "l_linestatus"), metrics))


def orders_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(R.mix(table(configure(spark), sf_dir, "orders"), "o_orderpriority"))


def orders_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(configure(spark), sf_dir, "orders")
    orders = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    where = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 1000)
    return R.spot_check(orders, where, [F.desc_nulls_first("o_totalprice")], 25, "o_orderkey")


def customer_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = (R.avg("avg_balance", "c_acctbal"), R.median("median_balance", "c_acctbal"))
    customers = table(configure(spark), sf_dir, "customer")
    labels = ("negative", "low", "middle", "high", "top")
    edges = ("0D", "2500D", "5000D", "7500D")
    return plain(
        R.bucket_summary(customers, "c_acctbal", edges, labels, metrics, "balance_bucket")
    )


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product mix, written as CSV and read back."""
    mix = R.product_mix(portfolio(spark, sf_dir))
    path = workspace(spark, "product_mix")
    write_report(mix, path)
    return plain(read_report(spark, path, mix.schema))


def bucketed_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scenarios of a catalog table that is bucketed by application."""
    create_database(configure(spark), "tallybook_reports")
    name = f"tallybook_reports.sweep_{uuid.uuid4().hex}"
    keys = order_keys(spark, sf_dir)
    buckets = max(8, tasks_for(spark, keys.count()))
    # keys are dealt as the table's rows will be, so that a task writes one bucket and no scored row is moved
    keys = keys.repartition(buckets, F.lit(BASE.population_id), "application_seq")
    save_portfolio_table(score_scenarios(keys, SWEEP), name, buckets)
    return plain(compare_scenarios(spark.table(name), BASE.scenario_name, STRESS.scenario_name))


def spot_scored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spot check straight on scored keys, without a stored table."""
    return plain(R.large_exposure_low_pti(score_portfolio(order_keys(spark, sf_dir), BASE)))


def key_table_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated keys as there are orders."""
    keys = key_table(spark, table(spark, sf_dir, "orders").count())
    key = F.col("application_seq")
    return keys.agg(
        F.count(key).alias("keys"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.sum(key).alias("key_sum"),
    )


def created_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio(spark, sf_dir).agg(
        F.count("*").alias("applications"), F.count("created_ts").alias("created")
    )


def customer_key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders keyed by customer: present and short enough, but not unique."""
    return key_checks(keyed(table(spark, sf_dir, "orders"), "o_custkey"))


def ranked_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product mix with the place of each row in the report's order."""
    mix = R.product_mix(portfolio(spark, sf_dir)).select("product_type", "applications")
    return mix.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


def segment_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws by market segment for every customer."""
    segment, rest = "c_mktsegment", "*"
    u = {i: D.hash_uniform("CAST(c_custkey AS STRING)", "'SEGMENT_V1'", f"u{i}") for i in range(1, 8)}
    audited = D.draw_flag(u[6], 0.1)
    drawn = add(
        table(configure(spark), sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        visits=D.draw_int_by(segment, u[1], {"BUILDING": (10, 5), rest: (100, 50)}),
        budget=D.draw_amount_by(segment, u[2], {"BUILDING": ("100BD", "1000BD"), rest: ("5BD", "20BD")}),
        months=D.draw_choice_by(segment, u[3], {"BUILDING": (12, 24, 36), "MACHINERY": (6, 48)}),
        claims=D.draw_ladder_by(
            segment, u[4], {"BUILDING": (((0.5, 0), (0.8, 1)), 2), rest: (((0.9, 0),), 3)}
        ),
        sampled=D.draw_flag_by(segment, u[5], {"BUILDING": 0.25, rest: 0.5}),
        audited=audited,
        confirmed=D.draw_flag_given(audited, segment, u[7], {"BUILDING": 0.9, rest: 0.6}, {}),
    )
    return plain(drawn)


def events_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(configure(spark), sf_dir, "events")
    events = events.withColumn("event_date", F.date_format("ts", "yyyy-MM-dd"))
    metrics = (R.avg("avg_value", "value", 4),)
    return plain(R.matrix(events, ("event_type", "event_date"), metrics))


def entry(spark: SparkSession) -> DataFrame:
    """Score every order of the smallest data set and profile the score bands."""
    return plain(R.band_profile(portfolio(spark, "/root/testdata/sf0.001")))


def queries() -> dict[str, Query]:
    """Every registered query reads whole tables."""
    return scoring_queries() | (corpus.queries() if corpus else {})


def scoring_queries() -> dict[str, Query]:
    return {
        "hash_digests": digests,
        "hash_draws": lambda s, d: draws(s, d).drop("application_seq", "applicant_id"),
        "keyed_ids": lambda s, d: with_ids(order_keys(s, d)),
        "draw_category_mix": category_mix,
        "draw_segments": pick(
            segments,
            "application_date",
            "product_type",
            "score_band",
            "credit_score",
            "loan_term_months",
            "base_amount",
        ),
        "draw_ladder": ladder_counts,
        "draw_flags": flag_rates,
        "borrower_profile": pick(
            order_borrowers,
            "annual_income",
            "debt_to_income_ratio",
            "utilization_rate",
            "tradeline_count",
            "months_since_oldest_trade",
            "recent_inquiry_count",
            "delinquency_count_12m",
            "major_derogatory_flag",
            "bankruptcy_flag",
            "prequalified_flag",
            "returning_customer_flag",
        ),
        "requested_amount": pick(structured, "product_type", "base_amount", "requested_amount"),
        "apr_bounds": pick(structured, "product_type", "apr_raw", "base_apr_for_payment_calc"),
        "payments": pick(structured, "loan_term_months", "monthly_payment_proxy"),
        "affordability": pick(structured, "amount_to_income_ratio", "payment_to_income_ratio"),
        "pd_components": pick(scored, "base_pd", *MULTIPLIERS),
        "expected_loss": expected_losses,
        "scored_portfolio": lambda s, d: plain(portfolio(s, d)),
        "stored_portfolio": stored_portfolio,
        "streamed_portfolio": streamed_portfolio,
        "shared_portfolio": shared_portfolio,
        "scenario_attribution": attributed,
        "scenario_table_totals": scenario_table_totals,
        "customer_draws": customer_draws,
        "mix_fits_targets": mix_fits_targets,
        "sketched_profile": sketched_profile,
        "lineitem_scorecard": lineitem_scorecard,
        "scenario_sweep": sweep_rows,
        "scenario_totals": sweep_totals,
        "scenario_compare": compared,
        "scenario_compare_by_band": compared_by_band,
        "param_violations": param_violations,
        "output_checks": output_checks,
        "review_expectations": report(expectations),
        "record_count": report(R.record_count),
        "portfolio_mix_product": report(R.product_mix),
        "portfolio_mix_band": report(R.band_mix),
        "variable_profile": report(R.variable_profile),
        "band_profile": report(R.band_profile),
        "product_profile": report(R.product_profile),
        "pti_buckets": report(R.pti_buckets),
        "product_band_matrix": report(R.product_band_matrix),
        "risk_matrix": report(R.risk_matrix),
        "spot_strong_high_pti": report(R.strong_credit_high_pti),
        "spot_weak_low_pti": report(R.weak_credit_low_pti),
        "spot_large_exposure": report(R.large_exposure_low_pti),
        "head_sample": report(R.sample_head),
        "hash_split_documents": document_split,
        "lineitem_payments": lineitem_payments,
        "lineitem_profile": lineitem_profile,
        "lineitem_segments": lineitem_segments,
        "orders_mix_priority": orders_mix,
        "orders_top_price": orders_top,
        "customer_balance_buckets": customer_buckets,
        "events_matrix": events_matrix,
        "report_files": report_files,
        "bucketed_compare": bucketed_compare,
        "spot_scored_keys": spot_scored_keys,
        "key_table_totals": key_table_totals,
        "created_on_every_row": created_rows,
        "key_checks": customer_key_checks,
        "ranked_products": ranked_products,
        "segment_draws": segment_draws,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the registered queries."""
    return oracle.statements(BASE, STRESS, TIGHT) | (corpus.oracle_sql() if corpus else {})
