"""Segment tables behind the draws and the scorecard.

Every table is keyed by segment label. The ``ELSE`` row is used for any label
that is not listed, which is how the weakest score band is reached. Tables keyed
by product have no ``ELSE`` row: an unknown product gives NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

ELSE = "*"

# Segment labels, listed in business order.
PRODUCTS = ("MORTGAGE", "REVOLVING_LINE", "AUTO_LOAN", "UNSECURED_PERSONAL_LOAN", "HELOC")
BANDS = ("SUPER_PRIME", "PRIME", "NEAR_PRIME", "SUBPRIME", "DEEP_SUBPRIME")

# Which scenario fields hold the weight, bounds, rate and LGD of a segment.
PRODUCT_FIELD = {
    "MORTGAGE": "mortgage",
    "REVOLVING_LINE": "revolving",
    "AUTO_LOAN": "auto",
    "UNSECURED_PERSONAL_LOAN": "personal",
    "HELOC": "heloc",
}
PRODUCT_WEIGHT = {
    "MORTGAGE": "pct_mortgage",
    "REVOLVING_LINE": "pct_revolving",
    "AUTO_LOAN": "pct_auto",
    "UNSECURED_PERSONAL_LOAN": "pct_personal_loan",
    "HELOC": "pct_heloc",
}
BAND_WEIGHT = {
    "SUPER_PRIME": "pct_super_prime",
    "PRIME": "pct_prime",
    "NEAR_PRIME": "pct_near_prime",
    "SUBPRIME": "pct_subprime",
    "DEEP_SUBPRIME": "pct_deep_subprime",
}

# Borrower tables by score band.
SCORE = {  # (lowest score, width)
    "SUPER_PRIME": (760, 91),
    "PRIME": (700, 60),
    "NEAR_PRIME": (640, 60),
    "SUBPRIME": (580, 60),
    ELSE: (500, 80),
}
INCOME = {  # (floor, spread, exponent)
    "SUPER_PRIME": (60000.0, 180000.0, 0.65),
    "PRIME": (50000.0, 160000.0, 0.72),
    "NEAR_PRIME": (40000.0, 140000.0, 0.80),
    "SUBPRIME": (30000.0, 110000.0, 0.90),
    ELSE: (20000.0, 90000.0, 1.00),
}
DTI = {  # (floor, width)
    "SUPER_PRIME": (0.18, 0.22),
    "PRIME": (0.22, 0.24),
    "NEAR_PRIME": (0.28, 0.24),
    "SUBPRIME": (0.34, 0.24),
    ELSE: (0.40, 0.25),
}
DTI_OUTLIERS = {"below": (0.08, 0.15), "above": (0.93, 0.10)}  # (threshold, size)
UTILIZATION = {  # (floor, width)
    "SUPER_PRIME": (0.08, 0.25),
    "PRIME": (0.15, 0.30),
    "NEAR_PRIME": (0.25, 0.35),
    "SUBPRIME": (0.35, 0.40),
    ELSE: (0.45, 0.42),
}
UTILIZATION_OUTLIERS = {"below": (0.05, 0.20), "above": (0.94, 0.18)}
TRADELINES = {  # (floor, width, tail threshold, tail bump)
    "SUPER_PRIME": (6, 12, 0.93, 8),
    "PRIME": (5, 11, 0.95, 7),
    "NEAR_PRIME": (3, 10, 0.96, 7),
    "SUBPRIME": (2, 9, 0.97, 7),
    ELSE: (1, 8, 0.98, 7),
}
TRADELINE_LIMITS = (1, 25)
FILE_AGE = {  # (floor, width) in months
    "SUPER_PRIME": (48, 260),
    "PRIME": (36, 220),
    "NEAR_PRIME": (24, 180),
    "SUBPRIME": (12, 140),
    ELSE: (6, 100),
}
INQUIRIES = {  # (floor, width)
    "SUPER_PRIME": (0, 4),
    "PRIME": (0, 5),
    "NEAR_PRIME": (0, 6),
    "SUBPRIME": (0, 7),
    ELSE: (0, 7),
}
DELINQUENCIES = {  # rungs of (draw below, count), then the count above the last rung
    "SUPER_PRIME": (((0.95, 0), (0.985, 1), (0.995, 2)), 3),
    "PRIME": (((0.86, 0), (0.95, 1), (0.985, 2), (0.995, 3)), 4),
    "NEAR_PRIME": (((0.64, 0), (0.82, 1), (0.92, 2), (0.97, 3), (0.99, 4)), 5),
    "SUBPRIME": (((0.32, 0), (0.55, 1), (0.74, 2), (0.87, 3), (0.95, 4)), 5),
    ELSE: (((0.18, 0), (0.35, 1), (0.53, 2), (0.70, 3), (0.84, 4)), 6),
}
DEROGATORY = {
    "SUPER_PRIME": 0.008,
    "PRIME": 0.018,
    "NEAR_PRIME": 0.045,
    "SUBPRIME": 0.100,
    ELSE: 0.180,
}
# Chance of bankruptcy by band, for borrowers with and without a major derogatory.
BANKRUPTCY_WITH_DEROGATORY = {
    "PRIME": 0.06,
    "NEAR_PRIME": 0.18,
    "SUBPRIME": 0.32,
    "DEEP_SUBPRIME": 0.32,
}
BANKRUPTCY_CLEAN = {"NEAR_PRIME": 0.003}
PREQUALIFIED = 0.22
RETURNING = 0.18

# Product structure.
TERMS = {  # months; None means no term
    "UNSECURED_PERSONAL_LOAN": (24, 36, 48, 60),
    "AUTO_LOAN": (36, 48, 60, 72, 84),
    "REVOLVING_LINE": None,
    "HELOC": (120, 180, 240),
    "MORTGAGE": (180, 240, 360),
}
AMOUNT_SCALING = {  # (constant, income unit, slope)
    "UNSECURED_PERSONAL_LOAN": (0.70, 100000.0, 0.35),
    "AUTO_LOAN": (0.80, 120000.0, 0.25),
    "REVOLVING_LINE": (0.75, 90000.0, 0.30),
    "HELOC": (0.80, 140000.0, 0.35),
}
AMOUNT_DISPERSION = (0.90, 0.20)
MORTGAGE_INCOME_MULTIPLE = {
    "SUPER_PRIME": 5.75,
    "PRIME": 5.00,
    "NEAR_PRIME": 4.25,
    "SUBPRIME": 3.50,
    ELSE: 2.75,
}
MORTGAGE_CAP_DISPERSION = (0.70, 0.30)
MORTGAGE_SCALING = (0.45, 250000.0, 0.30)
MORTGAGE_DISPERSION = (0.94, 0.12)
APR_PREMIUM = {  # (floor, width)
    "SUPER_PRIME": (0.000, 0.010),
    "PRIME": (0.010, 0.020),
    "NEAR_PRIME": (0.030, 0.030),
    "SUBPRIME": (0.060, 0.040),
    ELSE: (0.100, 0.050),
}
APR_NOISE = 0.020
APR_LIMITS = {
    "MORTGAGE": (0.04, 0.10),
    "AUTO_LOAN": (0.05, 0.22),
    "UNSECURED_PERSONAL_LOAN": (0.08, 0.35),
    "REVOLVING_LINE": (0.15, 0.35),
    "HELOC": (0.05, 0.15),
}
AMORTIZING = ("UNSECURED_PERSONAL_LOAN", "AUTO_LOAN", "MORTGAGE")
REVOLVING_PAYMENT_RATE = "0.03"

# Scorecard. Ladders are (upper edge, multiplier) rungs and the value above them.
BASE_PD = {
    "SUPER_PRIME": "0.010000",
    "PRIME": "0.025000",
    "NEAR_PRIME": "0.060000",
    "SUBPRIME": "0.140000",
    ELSE: "0.260000",
}
MULT_DELINQ = (((0, "1.00"), (1, "1.20"), (2, "1.45"), (3, "1.75")), "2.10")  # equal to
MULT_DEROG = "1.60"
MULT_BANKRUPTCY = "1.85"
MULT_UTIL = ((("0.10", "0.95"), ("0.30", "1.00"), ("0.50", "1.10"), ("0.75", "1.25")), "1.45")
MULT_DTI = ((("0.20", "0.95"), ("0.35", "1.00"), ("0.45", "1.10"), ("0.55", "1.25")), "1.45")
MULT_INQUIRY = (((1, "1.00"), (3, "1.05"), (5, "1.12")), "1.20")  # at most
MULT_TRADELINE = (  # from, to, multiplier
    ((1, 2, "1.12"), (3, 5, "1.05"), (6, 12, "1.00"), (13, 18, "1.03")),
    "1.08",
)
MULT_FILE_AGE = (((12, "1.18"), (24, "1.10"), (60, "1.05")), "1.00")
MULT_PTI = ((("0.05", "0.95"), ("0.10", "1.00"), ("0.15", "1.10"), ("0.20", "1.25")), "1.45")
MULT_AMT_INCOME = ((("0.10", "1.00"), ("0.30", "1.03"), ("0.60", "1.08"), ("1.00", "1.15")), "1.25")
MULT_PRODUCT = {
    "MORTGAGE": "0.90",
    "AUTO_LOAN": "1.00",
    "UNSECURED_PERSONAL_LOAN": "1.10",
    "REVOLVING_LINE": "1.12",
    "HELOC": "0.95",
}
PD_JITTER = (0.95, 0.10)
PD_LIMITS = (0.005, 0.45)


def _table(value: Any) -> Any:
    return field(default_factory=lambda: value)


@dataclass(frozen=True)
class Calibration:
    """The tables used by one run. Replace any of them with ``dataclasses.replace``."""

    score: dict = _table(SCORE)
    income: dict = _table(INCOME)
    dti: dict = _table(DTI)
    dti_outliers: dict = _table(DTI_OUTLIERS)
    utilization: dict = _table(UTILIZATION)
    utilization_outliers: dict = _table(UTILIZATION_OUTLIERS)
    tradelines: dict = _table(TRADELINES)
    tradeline_limits: tuple = TRADELINE_LIMITS
    file_age: dict = _table(FILE_AGE)
    inquiries: dict = _table(INQUIRIES)
    delinquencies: dict = _table(DELINQUENCIES)
    derogatory: dict = _table(DEROGATORY)
    bankruptcy_with_derogatory: dict = _table(BANKRUPTCY_WITH_DEROGATORY)
    bankruptcy_clean: dict = _table(BANKRUPTCY_CLEAN)
    prequalified: float = PREQUALIFIED
    returning: float = RETURNING
    terms: dict = _table(TERMS)
    amount_scaling: dict = _table(AMOUNT_SCALING)
    amount_dispersion: tuple = AMOUNT_DISPERSION
    mortgage_income_multiple: dict = _table(MORTGAGE_INCOME_MULTIPLE)
    mortgage_cap_dispersion: tuple = MORTGAGE_CAP_DISPERSION
    mortgage_scaling: tuple = MORTGAGE_SCALING
    mortgage_dispersion: tuple = MORTGAGE_DISPERSION
    apr_premium: dict = _table(APR_PREMIUM)
    apr_noise: float = APR_NOISE
    apr_limits: dict = _table(APR_LIMITS)
    amortizing: tuple = AMORTIZING
    revolving_payment_rate: str = REVOLVING_PAYMENT_RATE
    base_pd: dict = _table(BASE_PD)
    mult_delinq: tuple = MULT_DELINQ
    mult_derog: str = MULT_DEROG
    mult_bankruptcy: str = MULT_BANKRUPTCY
    mult_util: tuple = MULT_UTIL
    mult_dti: tuple = MULT_DTI
    mult_inquiry: tuple = MULT_INQUIRY
    mult_tradeline: tuple = MULT_TRADELINE
    mult_file_age: tuple = MULT_FILE_AGE
    mult_pti: tuple = MULT_PTI
    mult_amt_income: tuple = MULT_AMT_INCOME
    mult_product: dict = _table(MULT_PRODUCT)
    pd_jitter: tuple = PD_JITTER
    pd_limits: tuple = PD_LIMITS


DEFAULT = Calibration()
