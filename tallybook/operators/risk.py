"""Scorecard: PD components, estimated PD, LGD and expected loss."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.calibration import DEFAULT, PRODUCT_FIELD, Calibration
from tallybook.functions.draws import add
from tallybook.functions.numeric import (
    Sql,
    by_segment,
    clamp,
    dec,
    double,
    num,
    step,
    step_at_most,
    step_between,
    step_equal,
    to_decimal,
)
from tallybook.params import Params
from tallybook.schema import MULTIPLIERS


def flag_multiplier(flag: Sql, value: str) -> Sql:
    """``value`` where the flag is set, else 1."""
    return f"if({flag}, {dec(value)}, {dec(1)})"


def pd_components(cal: Calibration = DEFAULT) -> dict[str, Sql]:
    """Base PD and the eleven multipliers, by output column name."""
    return {
        "base_pd": by_segment("score_band", {k: dec(v, 12, 6) for k, v in cal.base_pd.items()}),
        "mult_delinq": step_equal("delinquency_count_12m", cal.mult_delinq),
        "mult_derog": flag_multiplier("major_derogatory_flag", cal.mult_derog),
        "mult_bankruptcy": flag_multiplier("bankruptcy_flag", cal.mult_bankruptcy),
        "mult_util": step("utilization_rate", cal.mult_util),
        "mult_dti": step("debt_to_income_ratio", cal.mult_dti),
        "mult_inquiry": step_at_most("recent_inquiry_count", cal.mult_inquiry),
        "mult_tradeline": step_between("tradeline_count", cal.mult_tradeline),
        "mult_file_age": step("months_since_oldest_trade", cal.mult_file_age),
        "mult_pti": step("payment_to_income_ratio", cal.mult_pti),
        "mult_amt_income": step("amount_to_income_ratio", cal.mult_amt_income),
        "mult_product": by_segment("product_type", {k: dec(v) for k, v in cal.mult_product.items()}),
    }


def with_pd_components(df: DataFrame, cal: Calibration = DEFAULT) -> DataFrame:
    """Add base PD and the multipliers."""
    return add(df, **pd_components(cal))


def scorecard_pd(components, jitter_draw: Sql, cal: Calibration = DEFAULT) -> Sql:
    """Product of the components and a small jitter, kept inside the PD limits."""
    shift, width = cal.pd_jitter
    low, high = cal.pd_limits
    product = " * ".join(double(c) for c in components)
    jitter = f"({num(shift)} + {jitter_draw} * {num(width)})"
    return to_decimal(clamp(f"{product} * {jitter}", num(low), num(high)), 12, 6)


def lgd(product: Sql, params: Params) -> Sql:
    """Loss given default of the product."""
    return by_segment(product, {p: params(f"lgd_{f}") for p, f in PRODUCT_FIELD.items()})


def expected_loss(amount: Sql, pd: Sql, lgd_: Sql) -> Sql:
    """``amount * pd * lgd`` in exact decimals, rounded to cents.

    PD and LGD are below 10, so narrow decimals keep all 14 fraction digits.
    """
    exact = (
        f"CAST({amount} AS DECIMAL(18,2)) * CAST({pd} AS DECIMAL(7,6))"
        f" * CAST({lgd_} AS DECIMAL(7,6))"
    )
    return f"CAST(round({exact}, 2) AS DECIMAL(18,2))"


def with_pd(df: DataFrame, cal: Calibration = DEFAULT) -> DataFrame:
    """PD components and PD, from the structure columns; no parameter of a scenario has a part in them."""
    return add(with_pd_components(df, cal), estimated_pd=scorecard_pd(("base_pd", *MULTIPLIERS), "u15", cal))


def with_loss(df: DataFrame, params: Params) -> DataFrame:
    """LGD and expected loss, from the PD."""
    return add(
        add(df, estimated_lgd=lgd("product_type", params)),
        expected_loss_amount=expected_loss("requested_amount", "estimated_pd", "estimated_lgd"),
    )


def with_risk(df: DataFrame, params: Params, cal: Calibration = DEFAULT) -> DataFrame:
    """PD components, PD, LGD and expected loss, from the structure columns."""
    return with_loss(with_pd(df, cal), params)
