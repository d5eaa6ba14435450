"""Review reports for a table of any size: group first, then work on the group rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.calibration import BANDS
from tallybook.functions.numeric import Sql, settle, text
from tallybook.operators.quantiles import aggregate_with_quantiles, without_nan

AGGREGATES = {"sum": "sum", "min": "min", "max": "max", "stddev": "stddev_pop"}


@dataclass(frozen=True)
class Metric:
    """One output column of a segment report."""

    name: str
    kind: str
    column: str
    scale: int

    def aggregate(self) -> Sql:
        if self.kind == "avg":
            return exact_avg(self.column)
        if self.kind == "rate":
            return exact_avg(f"if({self.column}, 1, 0)")
        return f"{AGGREGATES[self.kind]}({self.column})"


def avg(name: str, column: str, scale: int = 2) -> Metric:
    return Metric(name, "avg", column, scale)


def rate(name: str, column: str, scale: int = 4) -> Metric:
    """Share of rows with the flag set; NULL counts as not set."""
    return Metric(name, "rate", column, scale)


def total(name: str, column: str, scale: int = 2) -> Metric:
    return Metric(name, "sum", column, scale)


def median(name: str, column: str, scale: int = 2) -> Metric:
    return Metric(name, "median", column, scale)


def exact_avg(x: Sql) -> Sql:
    """Average from a sum. The sum of integers or decimals is exact, so it does not depend
    on partitioning."""
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def report_value(x: Sql, scale: int) -> Sql:
    """A figure at report scale."""
    return f"CAST({settle(x, scale)} AS DECIMAL(28,{scale}))"


def rank_of(column: str, labels: Sequence[str]) -> Column:
    """Position of a label in business order; unlisted labels come last."""
    known = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(column))
    return F.coalesce(F.nullif(known, F.lit(0)), F.lit(len(labels) + 1))


def with_share(
    counts: DataFrame, whole: Column, n: str = "applications", name: str = "pct_of_total"
) -> DataFrame:
    """Percent of ``whole``, two digits. It is a scalar subquery, so the group rows stay
    distributed however many there are."""
    share = counts.withColumn("_share", F.lit(100.0) * F.col(n) / whole)
    return share.selectExpr("* EXCEPT (_share)", f"{report_value('_share', 2)} AS {name}")


def record_count(df: DataFrame, name: str = "application_count") -> DataFrame:
    """Number of rows."""
    return df.agg(F.count("*").alias(name))


def mix(df: DataFrame, by: str, order: Sequence[str] | None = None) -> DataFrame:
    """Rows and share by label, in business order or largest first."""
    counts = df.groupBy(by).agg(F.count("*").alias("applications"))
    # the total sums the same counts, so that Spark can scan and exchange once
    counts = with_share(counts, counts.agg(F.sum("applications")).scalar())
    if order is None:
        return counts.orderBy(F.desc("applications"), F.col(by))
    return counts.orderBy(rank_of(by, order), F.col(by))


def segment_profile(
    df: DataFrame, by: Sequence[str] | str, metrics: Sequence[Metric], share: bool = True
) -> DataFrame:
    """Rows, share and metrics by segment, unordered.

    All metrics and the total come from one aggregation of one scan; exact medians take two more
    light scans. Values that are not a number count as missing.
    """
    by = [by] if isinstance(by, str) else list(by)
    df = without_nan(df, [m.column for m in metrics if m.column in df.columns and m.column not in by])
    plain = [m for m in metrics if m.kind != "median"]
    figures = {"applications": "count(*)"} | {m.name: m.aggregate() for m in plain}
    medians = {m.name: (m.column, 0.5) for m in metrics if m.kind == "median"}
    if medians:
        out = aggregate_with_quantiles(df, by, figures, medians)
    else:
        out = df.groupBy(*by).agg(*[F.expr(sql).alias(name) for name, sql in figures.items()])
    columns = [*by, "applications"]
    if share:
        # the total sums the group rows, so that Spark can scan and exchange once
        out = with_share(out, out.agg(F.sum("applications")).scalar())
        columns.append("pct_of_total")
    values = [f"{report_value(m.name, m.scale)} AS {m.name}" for m in metrics]
    return out.selectExpr(*columns, *values)


def matrix(df: DataFrame, by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """Segment report over several keys, without shares, unordered."""
    return segment_profile(df, by, metrics, share=False)


def bucket(value: str, edges: Sequence[float | str], labels: Sequence[str]) -> Column:
    """Label of the first edge above the value; the last label takes the rest and NULL."""
    rungs = " ".join(f"WHEN {value} < {e} THEN {text(v)}" for e, v in zip(edges, labels))
    return F.expr(f"CASE {rungs} ELSE {text(labels[-1])} END")


def bucket_summary(
    df: DataFrame,
    value: str,
    edges: Sequence[float | str],
    labels: Sequence[str],
    metrics: Sequence[Metric],
    name: str,
) -> DataFrame:
    """Segment report over buckets of a value, in bucket order."""
    labelled = df.withColumn(name, bucket(value, edges, labels))
    return segment_profile(labelled, name, metrics).orderBy(rank_of(name, labels))


def text_order(column: str) -> Column:
    """Sort key by Unicode collation instead of bytes."""
    return F.collate(F.col(column), "UNICODE")


def profile(df: DataFrame, scales: Mapping[str, int], count_nan: bool = False) -> DataFrame:
    """Distribution of several columns, with the exact quartiles.

    ``scales`` gives the digits of each column's figures, 2 or 4. Counts, limits and means of
    all columns come from one aggregation in the columns' own types, so that integers and
    decimals stay exact. NaN counts as missing; ``count_nan`` adds ``n_nan``, the number of rows with it.
    """
    if count_nan:  # before the columns lose it
        floats = {c: isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) for c in scales}
        df = df.select("*", *[F.expr(f"isnan({c})" if f else "false").alias(f"_nan_{c}") for c, f in floats.items()])

    def figure(x: Sql, scale: int) -> Sql:
        return f"CAST({report_value(x, scale)} AS DECIMAL(28,4))"

    def mean(c: str) -> Sql:
        whole = isinstance(df.schema[c].dataType, T.IntegralType)
        return exact_avg(f"CAST({c} AS DECIMAL(20,0))" if whole else c)

    figures, quartiles, rows = {}, {}, []
    for i, (c, s) in enumerate(scales.items()):
        sums = {"n": f"count({c})", "min": f"min({c})", "max": f"max({c})", "mean": mean(c), "std": f"stddev_pop({c})"}
        if count_nan:
            sums["nan"] = f"count_if(_nan_{c})"
        figures |= {f"_{name}_{i}": sql for name, sql in sums.items()}
        quartiles |= {f"_{name}_{i}": (c, p) for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))}
        values = {"min_val": "min", "p25": "p25", "median": "median", "mean": "mean", "p75": "p75", "max_val": "max", "std_dev": "std"}
        shown = ", ".join(f"{figure(f'_{name}_{i}', s)} AS {out}" for out, name in values.items())
        more = f", _nan_{i} AS n_nan" if count_nan else ""
        rows.append(f"struct({text(c)} AS variable_name, _n_{i} AS n, {shown}{more})")
    whole = aggregate_with_quantiles(without_nan(df, list(scales)), [], figures, quartiles)
    return whole.selectExpr(f"inline(array({', '.join(rows)}))").orderBy("variable_name")


def approx_profile(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Quartiles in a single scan, with a rank error of at most rows / accuracy."""
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    sketches = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in columns]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("variable_name"), F.col(c).alias("q")) for c in columns]
    )
    return sketches.select(F.inline(rows)).select(
        "variable_name",
        *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "median", "p75"))],
    )


def spot_check(
    df: DataFrame,
    where: Column,
    order: Sequence[Column],
    k: int = 25,
    tie_breaker: str = "application_id",
) -> DataFrame:
    """First ``k`` matching rows. Each task keeps only its own first ``k``."""
    return df.where(where).orderBy(*order, F.col(tie_breaker)).limit(k)


def sample_head(df: DataFrame, by: str = "application_id", k: int = 50) -> DataFrame:
    """First ``k`` rows by key."""
    return df.orderBy(by).limit(k)


# Report definitions of the portfolio review.
PROFILE_SCALES = {
    "credit_score": 2,
    "annual_income": 2,
    "debt_to_income_ratio": 4,
    "utilization_rate": 4,
    "tradeline_count": 2,
    "months_since_oldest_trade": 2,
    "recent_inquiry_count": 2,
    "requested_amount": 2,
    "base_apr_for_payment_calc": 4,
    "monthly_payment_proxy": 2,
    "payment_to_income_ratio": 4,
    "amount_to_income_ratio": 4,
    "estimated_pd": 4,
    "estimated_lgd": 4,
    "expected_loss_amount": 2,
}
BAND_METRICS = (
    avg("avg_credit_score", "credit_score"),
    avg("avg_income", "annual_income"),
    median("median_income", "annual_income"),
    avg("avg_dti", "debt_to_income_ratio", 4),
    avg("avg_utilization", "utilization_rate", 4),
    avg("avg_tradeline_count", "tradeline_count"),
    avg("avg_file_age_months", "months_since_oldest_trade"),
    avg("avg_recent_inquiries", "recent_inquiry_count"),
    avg("avg_delinquency_count", "delinquency_count_12m"),
    rate("major_derog_rate", "major_derogatory_flag"),
    rate("bankruptcy_rate", "bankruptcy_flag"),
    avg("avg_pti", "payment_to_income_ratio", 4),
    avg("avg_amount_to_income", "amount_to_income_ratio", 4),
    avg("avg_pd", "estimated_pd", 4),
    avg("avg_expected_loss", "expected_loss_amount"),
)
PRODUCT_METRICS = (
    avg("avg_requested_amount", "requested_amount"),
    median("median_requested_amount", "requested_amount"),
    avg("avg_apr", "base_apr_for_payment_calc", 4),
    median("median_apr", "base_apr_for_payment_calc", 4),
    avg("avg_monthly_payment", "monthly_payment_proxy"),
    median("median_monthly_payment", "monthly_payment_proxy"),
    avg("avg_pti", "payment_to_income_ratio", 4),
    median("median_pti", "payment_to_income_ratio", 4),
    avg("avg_pd", "estimated_pd", 4),
    avg("avg_lgd", "estimated_lgd", 4),
    avg("avg_expected_loss", "expected_loss_amount"),
    total("total_expected_loss", "expected_loss_amount"),
)
PTI_EDGES = ("0.05", "0.10", "0.15", "0.20")
PTI_LABELS = ("<5%", "5%-9%", "10%-14%", "15%-19%", "20%+")
PTI_METRICS = (
    avg("avg_monthly_payment", "monthly_payment_proxy"),
    avg("avg_requested_amount", "requested_amount"),
    avg("avg_apr", "base_apr_for_payment_calc", 4),
    avg("avg_pd", "estimated_pd", 4),
    avg("avg_expected_loss", "expected_loss_amount"),
)
CELL_METRICS = (
    avg("avg_requested_amount", "requested_amount"),
    avg("avg_apr", "base_apr_for_payment_calc", 4),
    avg("avg_monthly_payment", "monthly_payment_proxy"),
    avg("avg_pti", "payment_to_income_ratio", 4),
    avg("avg_pd", "estimated_pd", 4),
    avg("avg_expected_loss", "expected_loss_amount"),
)
RISK_METRICS = (
    avg("avg_pd", "estimated_pd", 4),
    avg("avg_expected_loss", "expected_loss_amount"),
)


def product_mix(df: DataFrame) -> DataFrame:
    """Applications by product, largest first."""
    return mix(df, "product_type")


def band_mix(df: DataFrame) -> DataFrame:
    """Applications by score band, strongest first."""
    return mix(df, "score_band", BANDS)


def variable_profile(df: DataFrame) -> DataFrame:
    """Distribution of the fifteen review variables."""
    return profile(df, PROFILE_SCALES)


def band_profile(df: DataFrame) -> DataFrame:
    """Borrower and risk averages by score band."""
    return segment_profile(df, "score_band", BAND_METRICS).orderBy(rank_of("score_band", BANDS))


def product_profile(df: DataFrame) -> DataFrame:
    """Amount, price, affordability and loss by product."""
    return segment_profile(df, "product_type", PRODUCT_METRICS).orderBy("product_type")


def pti_buckets(df: DataFrame) -> DataFrame:
    """Exposure and risk by payment-to-income bucket, in bucket order."""
    return bucket_summary(
        df, "payment_to_income_ratio", PTI_EDGES, PTI_LABELS, PTI_METRICS, "pti_bucket"
    )


def product_band_matrix(df: DataFrame) -> DataFrame:
    """Exposure, price and risk by product and band."""
    cells = matrix(df, ("product_type", "score_band"), CELL_METRICS)
    return cells.orderBy("product_type", rank_of("score_band", BANDS))


def risk_matrix(df: DataFrame) -> DataFrame:
    """PD and loss by product and band, in text order."""
    cells = matrix(df, ("product_type", "score_band"), RISK_METRICS)
    return cells.orderBy("product_type", "score_band")


def strong_credit_high_pti(df: DataFrame, k: int = 25) -> DataFrame:
    """Strong scores with a stretched payment."""
    where = (F.col("credit_score") >= 700) & (F.col("payment_to_income_ratio") >= F.expr("0.18"))
    return spot_check(df, where, [F.desc_nulls_first("payment_to_income_ratio")], k)


def weak_credit_low_pti(df: DataFrame, k: int = 25) -> DataFrame:
    """Weak scores with a manageable payment."""
    where = (F.col("credit_score") < 640) & (F.col("payment_to_income_ratio") < F.expr("0.10"))
    order = [F.desc_nulls_first("credit_score"), F.asc_nulls_last("payment_to_income_ratio")]
    return spot_check(df, where, order, k)


def large_exposure_low_pti(df: DataFrame, k: int = 25) -> DataFrame:
    """Large amounts with a manageable payment."""
    where = (F.col("requested_amount") >= 250000) & (
        F.col("payment_to_income_ratio") < F.expr("0.15")
    )
    return spot_check(df, where, [F.desc_nulls_first("requested_amount")], k)


REVIEW = {
    "record_count": record_count,
    "product_mix": product_mix,
    "score_band_mix": band_mix,
    "variable_profile": variable_profile,
    "score_band_profile": band_profile,
    "product_profile": product_profile,
    "pti_buckets": pti_buckets,
    "product_band_matrix": product_band_matrix,
    "strong_credit_high_pti": strong_credit_high_pti,
    "weak_credit_low_pti": weak_credit_low_pti,
    "large_exposure_low_pti": large_exposure_low_pti,
    "risk_matrix": risk_matrix,
    "head_sample": sample_head,
}
