"""Schema of the application table."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _STR = T.IntegerType(), T.LongType(), T.StringType()
_DATE, _BOOL, _TS = T.DateType(), T.BooleanType(), T.TimestampType()
_MONEY, _RATIO4 = T.DecimalType(18, 2), T.DecimalType(12, 4)
_RATIO6, _RATE, _MULT = T.DecimalType(18, 6), T.DecimalType(12, 6), T.DecimalType(6, 2)

# Output columns in order.
APPLICATION_COLUMNS = (
    ("scenario_name", _STR),
    ("population_id", _STR),
    ("anchor_date", _DATE),
    ("application_seq", _LONG),
    ("application_id", _STR),
    ("applicant_id", _STR),
    ("application_date", _DATE),
    ("product_type", _STR),
    ("score_band", _STR),
    ("credit_score", _INT),
    ("annual_income", _MONEY),
    ("debt_to_income_ratio", _RATIO4),
    ("utilization_rate", _RATIO4),
    ("tradeline_count", _INT),
    ("months_since_oldest_trade", _INT),
    ("recent_inquiry_count", _INT),
    ("delinquency_count_12m", _INT),
    ("major_derogatory_flag", _BOOL),
    ("bankruptcy_flag", _BOOL),
    ("prequalified_flag", _BOOL),
    ("returning_customer_flag", _BOOL),
    ("requested_amount", _MONEY),
    ("loan_term_months", _INT),
    ("base_apr_for_payment_calc", _RATE),
    ("monthly_payment_proxy", _MONEY),
    ("payment_to_income_ratio", _RATIO6),
    ("amount_to_income_ratio", _RATIO6),
    ("base_pd", _RATE),
    ("mult_delinq", _MULT),
    ("mult_derog", _MULT),
    ("mult_bankruptcy", _MULT),
    ("mult_util", _MULT),
    ("mult_dti", _MULT),
    ("mult_inquiry", _MULT),
    ("mult_tradeline", _MULT),
    ("mult_file_age", _MULT),
    ("mult_pti", _MULT),
    ("mult_amt_income", _MULT),
    ("mult_product", _MULT),
    ("estimated_pd", _RATE),
    ("estimated_lgd", _RATE),
    ("expected_loss_amount", _MONEY),
    ("created_ts", _TS),
)
APPLICATION_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in APPLICATION_COLUMNS])
AUDIT_COLUMNS = ("created_ts",)
MULTIPLIERS = tuple(n for n, _ in APPLICATION_COLUMNS if n.startswith("mult_"))
