"""Requested amount, APR, payment and affordability, as projections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.calibration import DEFAULT, PRODUCT_FIELD, Calibration
from tallybook.functions import draws as D
from tallybook.functions.draws import add
from tallybook.functions.numeric import (
    Sql,
    by_segment,
    clamp,
    dec,
    double,
    num,
    quotient,
    settle,
    text,
    to_decimal,
)
from tallybook.params import Params


def _bounds(params: Params) -> dict[str, tuple[Sql, Sql]]:
    return {p: (params(f"min_{f}_amt"), params(f"max_{f}_amt")) for p, f in PRODUCT_FIELD.items()}


def with_base_amount(df: DataFrame, params: Params) -> DataFrame:
    """Amount spread over the product's range, before income is taken into account."""
    return add(df, base_amount=D.draw_amount_by("product_type", "u5", _bounds(params)))


def requested_amount(params: Params, cal: Calibration = DEFAULT) -> Sql:
    """Base amount scaled by income and kept inside the product's range.

    A mortgage is also limited by a multiple of income, and that limit may fall
    below the product minimum.
    """
    base, income, bounds = double("base_amount"), double("annual_income"), _bounds(params)

    def spread(draw: str, shape: tuple[float, float]) -> Sql:
        return f"({num(shape[0])} + {draw} * {num(shape[1])})"

    amounts = {}
    for product, (constant, unit, slope) in cal.amount_scaling.items():
        factor = f"({num(constant)} + {income} / {num(unit)} * {num(slope)})"
        scaled = f"{base} * {factor} * {spread('u6', cal.amount_dispersion)}"
        amounts[product] = clamp(scaled, *bounds[product])

    constant, unit, slope = cal.mortgage_scaling
    factor = f"({num(constant)} + least({income} / {num(unit)}, 1D) * {num(slope)})"
    anchor = f"{base} * {factor} * {spread('u6', cal.mortgage_dispersion)}"
    multiple = by_segment(
        "score_band", {k: num(m) for k, m in cal.mortgage_income_multiple.items()}
    )
    capacity = f"{income} * {multiple} * {spread('u7', cal.mortgage_cap_dispersion)}"
    low, high = bounds["MORTGAGE"]
    amounts["MORTGAGE"] = f"least({double(high)}, {capacity}, greatest({double(low)}, {anchor}))"
    return to_decimal(by_segment("product_type", amounts), 18, 2)


def apr_raw(params: Params, cal: Calibration = DEFAULT) -> Sql:
    """Product base rate plus band premium, noise and the scenario's rate shift."""
    base = by_segment(
        "product_type",
        {p: double(params(f"base_rate_{f}")) for p, f in PRODUCT_FIELD.items()},
    )
    premium = by_segment(
        "score_band", {k: f"{num(a)} + u4 * {num(w)}" for k, (a, w) in cal.apr_premium.items()}
    )
    noise = f"(u5 - 0.5D) * {num(cal.apr_noise)}"
    shift = f"{params('rate_shift_bps')} / 10000D"
    return to_decimal(f"{base} + {premium} + {noise} + {shift}", 12, 6)


def apr_bounded(raw: Sql, cal: Calibration = DEFAULT) -> Sql:
    """APR kept inside the product's limits."""
    limits = {
        p: f"least({dec(high, 12, 6)}, greatest({dec(low, 12, 6)}, {raw}))"
        for p, (low, high) in cal.apr_limits.items()
    }
    return by_segment("product_type", limits)


def with_amount_and_apr(df: DataFrame, params: Params, cal: Calibration = DEFAULT) -> DataFrame:
    """Requested amount and bounded APR."""
    priced = add(df, requested_amount=requested_amount(params, cal), apr_raw=apr_raw(params, cal))
    return add(priced, base_apr_for_payment_calc=apr_bounded("apr_raw", cal))


def amortizing_payment(amount: Sql, apr: Sql, term: Sql) -> Sql:
    """Level monthly payment in cents; NULL without a term, straight-line at a zero rate."""
    rate = f"({double(apr)} / 12D)"
    growth = f"pow(1D + {rate}, {double(term)})"
    level = f"{double(amount)} * ({rate} * {growth}) / ({growth} - 1D)"
    return (
        f"CASE WHEN {term} IS NULL OR {term} = 0 THEN NULL"
        f" WHEN {apr} = 0 THEN {quotient(amount, f'CAST({term} AS DECIMAL(18,0))', 2)}"
        f" ELSE {to_decimal(level, 18, 2)} END"
    )


def monthly_payment(
    product: Sql, amount: Sql, apr: Sql, term: Sql, cal: Calibration = DEFAULT
) -> Sql:
    """Amortizing payment, revolving minimum payment or HELOC interest, by product."""
    money = f"CAST({amount} AS DECIMAL(18,2))"
    amortizing = ", ".join(text(p) for p in cal.amortizing)
    minimum = f"round({money} * {cal.revolving_payment_rate}BD, 2)"
    interest = settle(f"{double(money)} * ({double(apr)} / 12D)", 2)
    return (
        f"CASE WHEN {product} IN ({amortizing})"
        f" THEN {amortizing_payment(amount, apr, term)}"
        f" WHEN {product} = 'REVOLVING_LINE' THEN CAST({minimum} AS DECIMAL(18,2))"
        f" WHEN {product} = 'HELOC' THEN CAST({interest} AS DECIMAL(18,2)) END"
    )


def amount_to_income(amount: Sql, income: Sql) -> Sql:
    """Amount over annual income; NULL at zero income."""
    return quotient(amount, f"CAST({income} AS DECIMAL(18,2))", 6)


def payment_to_income(payment: Sql, income: Sql) -> Sql:
    """Monthly payment over monthly income, as a year's payments over a year's income."""
    return quotient(f"CAST({payment} AS DECIMAL(16,2)) * 12", f"CAST({income} AS DECIMAL(18,2))", 6)


def with_payment(df: DataFrame, cal: Calibration = DEFAULT) -> DataFrame:
    """Monthly payment and the two affordability ratios."""
    paid = add(
        df,
        monthly_payment_proxy=monthly_payment(
            "product_type",
            "requested_amount",
            "base_apr_for_payment_calc",
            "loan_term_months",
            cal,
        ),
        amount_to_income_ratio=amount_to_income("requested_amount", "annual_income"),
    )
    return add(
        paid, payment_to_income_ratio=payment_to_income("monthly_payment_proxy", "annual_income")
    )


def with_structure(df: DataFrame, params: Params, cal: Calibration = DEFAULT) -> DataFrame:
    """All product-structure columns, from the borrower columns and draws."""
    return (
        df.transform(with_base_amount, params)
        .transform(with_amount_and_apr, params, cal)
        .transform(with_payment, cal)
    )
