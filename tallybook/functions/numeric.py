"""Numeric expressions: rounding, clamping and step tables.

The functions here and in ``draws`` take and return Spark SQL expressions as text, for
``selectExpr`` or ``F.expr``. One parsed text per column builds a wide plan many
times faster than thousands of single Column calls from Python.

Rounding is half away from zero everywhere. Continuous values are rounded once, on
their way from double to decimal. Averages, medians and shares can land exactly on a
tie that binary fractions cannot hold, so ``settle`` first removes the noise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from decimal import Decimal

from tallybook.calibration import ELSE

Sql = str


def text(value: str) -> Sql:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def num(value: float) -> Sql:
    """Double literal."""
    return f"{float(value)!r}D"


def dec(value: str | int | Decimal, precision: int = 6, scale: int = 2) -> Sql:
    """Decimal literal."""
    return f"CAST({Decimal(str(value)):f}BD AS DECIMAL({precision},{scale}))"


def double(x: Sql) -> Sql:
    return f"CAST({x} AS DOUBLE)"


def to_decimal(x: Sql, precision: int, scale: int) -> Sql:
    """Round a double that is no negative tie to ``scale`` digits, half up.

    The value becomes an integer count of its last digit and then a decimal. A direct
    cast from double would print and parse every number, at several times the cost.
    """
    units = f"CAST(floor(({x}) * {num(10**scale)} + 0.5D) AS DECIMAL(18,0))"
    unit = f"{Decimal(1).scaleb(-scale):f}BD"
    return f"CAST({units} * {unit} AS DECIMAL({precision},{scale}))"


def quotient(money: Sql, divisor: Sql, scale: int) -> Sql:
    """Money over an exact number, rounded half up from the exact quotient; NULL at zero."""
    exact = f"CAST({money} AS DECIMAL(18,2)) / nullif({divisor}, 0BD)"
    return f"CAST(round({exact}, {scale}) AS DECIMAL(18,{scale}))"


def settle(x: Sql, scale: int) -> Sql:
    """Round a computed double at report scale after removing binary noise."""
    guard = 8 if scale <= 2 else 12
    return f"round(CAST({x} AS DECIMAL(38,{guard})), {scale})"


def clamp(x: Sql, low: Sql, high: Sql) -> Sql:
    """Keep a double inside [low, high]; NULL bounds are ignored."""
    return f"least({double(high)}, greatest({double(low)}, {x}))"


def by_segment(segment: Sql, table: Mapping[str, Sql]) -> Sql:
    """Value of the row's segment; the ``ELSE`` entry, or NULL, for unlisted labels."""
    rows = [f"WHEN {text(k)} THEN {v}" for k, v in table.items() if k != ELSE]
    other = f" ELSE {table[ELSE]}" if ELSE in table else ""
    return f"CASE {segment} {' '.join(rows)}{other} END"


def ladder(rungs: Iterable[tuple[Sql, Sql]], above: Sql) -> Sql:
    """Value of the first rung whose condition holds; ``above`` when none does."""
    rows = " ".join(f"WHEN {condition} THEN {value}" for condition, value in rungs)
    return f"CASE {rows} ELSE {above} END"


def _steps(table, condition: Callable[[object], Sql]) -> Sql:
    rungs, above = table
    return ladder([(condition(edge), dec(value)) for edge, value in rungs], dec(above))


def step(x: Sql, table) -> Sql:
    """Multiplier ladder with exclusive upper edges."""
    return _steps(table, lambda edge: f"{x} < {edge}")


def step_at_most(x: Sql, table) -> Sql:
    """Multiplier ladder with inclusive upper edges."""
    return _steps(table, lambda edge: f"{x} <= {edge}")


def step_equal(x: Sql, table) -> Sql:
    """Multiplier by exact value."""
    return _steps(table, lambda edge: f"{x} = {edge}")


def step_between(x: Sql, table) -> Sql:
    """Multiplier by inclusive range."""
    rungs, above = table
    ranges = (tuple(((low, high), value) for low, high, value in rungs), above)
    return _steps(ranges, lambda r: f"{x} BETWEEN {r[0]} AND {r[1]}")
