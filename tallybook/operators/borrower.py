"""Segments and borrower attributes, as projections over a table of draws."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.calibration import BAND_WEIGHT, DEFAULT, PRODUCT_WEIGHT, Calibration
from tallybook.functions import draws as D
from tallybook.functions.draws import add
from tallybook.params import Params

PRODUCT, BAND = "product_type", "score_band"


def with_segments(df: DataFrame, params: Params) -> DataFrame:
    """Application date, product and score band."""
    window = params("portfolio_start_date"), params("portfolio_end_date")
    return add(
        df,
        application_date=D.draw_date("u1", *window),
        product_type=D.draw_category("u2", {p: params(w) for p, w in PRODUCT_WEIGHT.items()}),
        score_band=D.draw_category("u3", {b: params(w) for b, w in BAND_WEIGHT.items()}),
    )


def with_score_and_term(df: DataFrame, cal: Calibration = DEFAULT) -> DataFrame:
    """Credit score within the band and loan term from the product's menu."""
    return add(
        df,
        credit_score=D.draw_int_by(BAND, "u4", cal.score),
        loan_term_months=D.draw_choice_by(PRODUCT, "u6", cal.terms),
    )


def with_capacity(df: DataFrame, params: Params, cal: Calibration = DEFAULT) -> DataFrame:
    """Income, debt-to-income and utilization."""
    income = params("min_income"), params("max_income")
    dti = params("min_dti"), params("max_dti")
    usage = params("min_utilization"), params("max_utilization")
    return add(
        df,
        annual_income=D.draw_power_by(BAND, "u7", cal.income, *income),
        debt_to_income_ratio=D.draw_with_outliers(
            BAND, "u8", "u9", cal.dti, cal.dti_outliers, *dti
        ),
        utilization_rate=D.draw_with_outliers(
            BAND, "u10", "u11", cal.utilization, cal.utilization_outliers, *usage
        ),
    )


def with_credit_file(df: DataFrame, cal: Calibration = DEFAULT) -> DataFrame:
    """Tradelines, file age, inquiries, delinquencies and the major derogatory flag."""
    return add(
        df,
        tradeline_count=D.draw_count_with_tail(
            BAND, "u12", "u13", cal.tradelines, cal.tradeline_limits
        ),
        months_since_oldest_trade=D.draw_int_by(BAND, "u13", cal.file_age),
        recent_inquiry_count=D.draw_int_by(BAND, "u14", cal.inquiries),
        delinquency_count_12m=D.draw_ladder_by(BAND, "u15", cal.delinquencies),
        major_derogatory_flag=D.draw_flag_by(BAND, "u11", cal.derogatory),
    )


def with_flags(df: DataFrame, cal: Calibration = DEFAULT) -> DataFrame:
    """Bankruptcy, prequalified and returning-customer flags."""
    return add(
        df,
        bankruptcy_flag=D.draw_flag_given(
            "major_derogatory_flag",
            BAND,
            "u10",
            cal.bankruptcy_with_derogatory,
            cal.bankruptcy_clean,
        ),
        prequalified_flag=D.draw_flag("u9", cal.prequalified),
        returning_customer_flag=D.draw_flag("u12", cal.returning),
    )


def with_borrower(df: DataFrame, params: Params, cal: Calibration = DEFAULT) -> DataFrame:
    """All borrower columns, from the draws."""
    return (
        df.transform(with_segments, params)
        .transform(with_score_and_term, cal)
        .transform(with_capacity, params, cal)
        .transform(with_credit_file, cal)
        .transform(with_flags, cal)
    )
