"""Scenario parameters: one frozen record per run, or a DataFrame with one row per run."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, fields
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallybook.functions.numeric import dec, text

RATE = T.DecimalType(12, 6)
RATIO = T.DecimalType(12, 4)
MONEY = T.DecimalType(18, 2)


def _d(text: str) -> Decimal:
    return Decimal(text)


@dataclass(frozen=True)
class Scenario:
    """Parameters of one run. The defaults are the baseline scenario."""

    # The baseline parameter set.
    scenario_name: str = "BASELINE"
    population_id: str = "BASE_POPULATION_V1"
    application_count: int = 50000
    portfolio_start_date: date = date(2025, 1, 1)
    portfolio_end_date: date = date(2025, 12, 31)
    anchor_date: date = date(2025, 12, 31)
    pct_mortgage: Decimal = _d("0.30")
    pct_revolving: Decimal = _d("0.25")
    pct_auto: Decimal = _d("0.20")
    pct_personal_loan: Decimal = _d("0.15")
    pct_heloc: Decimal = _d("0.10")
    pct_super_prime: Decimal = _d("0.18")
    pct_prime: Decimal = _d("0.28")
    pct_near_prime: Decimal = _d("0.24")
    pct_subprime: Decimal = _d("0.18")
    pct_deep_subprime: Decimal = _d("0.12")
    rate_shift_bps: int = 0
    min_credit_score: int = 500
    max_credit_score: int = 850
    min_income: Decimal = _d("20000")
    max_income: Decimal = _d("300000")
    min_dti: Decimal = _d("0.05")
    max_dti: Decimal = _d("0.70")
    min_utilization: Decimal = _d("0")
    max_utilization: Decimal = _d("0.95")
    min_personal_amt: Decimal = _d("1000")
    max_personal_amt: Decimal = _d("50000")
    min_auto_amt: Decimal = _d("5000")
    max_auto_amt: Decimal = _d("80000")
    min_revolving_amt: Decimal = _d("1000")
    max_revolving_amt: Decimal = _d("30000")
    min_heloc_amt: Decimal = _d("10000")
    max_heloc_amt: Decimal = _d("250000")
    min_mortgage_amt: Decimal = _d("75000")
    max_mortgage_amt: Decimal = _d("1500000")
    base_rate_mortgage: Decimal = _d("0.06")
    base_rate_auto: Decimal = _d("0.065")
    base_rate_personal: Decimal = _d("0.11")
    base_rate_revolving: Decimal = _d("0.20")
    base_rate_heloc: Decimal = _d("0.08")
    lgd_mortgage: Decimal = _d("0.20")
    lgd_auto: Decimal = _d("0.45")
    lgd_personal: Decimal = _d("0.70")
    lgd_revolving: Decimal = _d("0.85")
    lgd_heloc: Decimal = _d("0.25")


def _field_type(name: str) -> T.DataType:
    if name in ("scenario_name", "population_id"):
        return T.StringType()
    if name in ("application_count", "rate_shift_bps", "min_credit_score", "max_credit_score"):
        return T.IntegerType()
    if name.endswith("_date"):
        return T.DateType()
    if name.startswith(("pct_", "base_rate_", "lgd_")):
        return RATE
    if name.endswith(("_dti", "_utilization")):
        return RATIO
    return MONEY


SCENARIO_SCHEMA = T.StructType(
    [T.StructField(f.name, _field_type(f.name), True) for f in fields(Scenario)]
)
FIELD_NAMES = tuple(f.name for f in fields(Scenario))

# Parameters that shape the borrower. All others act after the borrower columns exist.
BORROWER_FIELDS = tuple(
    n
    for n in FIELD_NAMES
    if n in ("population_id", "portfolio_start_date", "portfolio_end_date")
    or n.startswith("pct_")
    or n.endswith(("_income", "_dti", "_utilization"))
)

# Parameters that shape the amount, the payment and the PD. The others only name a scenario or set its LGD.
STRUCTURE_FIELDS = BORROWER_FIELDS + tuple(
    n for n in FIELD_NAMES if n == "rate_shift_bps" or n.startswith("base_rate_") or n.endswith("_amt")
)


def scenarios_df(spark: SparkSession, scenarios: Iterable[Scenario]) -> DataFrame:
    """Parameter table: one typed row per scenario."""
    rows = [
        f"struct({', '.join(f'{literal(n, getattr(s, n))} AS {n}' for n in FIELD_NAMES)})"
        for s in scenarios
    ]
    return spark.range(1).selectExpr(f"inline(array({', '.join(rows)}))")


def load_scenarios(df: DataFrame) -> list[Scenario]:
    """Read a parameter table, which is configuration, back into scenario records."""
    return [Scenario(**r.asDict()) for r in df.select(*FIELD_NAMES).collect()]


Params = Callable[[str], str]


def literal(name: str, value) -> str:
    """A parameter value as a typed SQL literal."""
    kind = _field_type(name)
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    if isinstance(kind, T.StringType):
        return text(value)
    if isinstance(kind, T.DateType):
        return f"DATE'{value.isoformat()}'"
    if isinstance(kind, T.DecimalType):
        return dec(value, kind.precision, kind.scale)
    return str(int(value))


def bind(scenarios: Sequence[Scenario], index: str | None = None) -> Params:
    """Give access to parameters as SQL expressions.

    A parameter that is equal in all the scenarios is a literal, so Catalyst folds
    it. One that differs is picked from a literal array by the row's ``index``
    (1-based).
    """

    def param(name: str) -> str:
        values = [getattr(s, name) for s in scenarios]
        if len(set(values)) == 1:
            return literal(name, values[0])
        if index is None:
            raise ValueError(f"scenarios differ in {name} and no index was given")
        return f"element_at(array({', '.join(literal(name, v) for v in values)}), {index})"

    return param
