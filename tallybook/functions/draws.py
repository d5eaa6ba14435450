"""Reproducible draws for any keyed DataFrame, as Spark SQL expressions.

A draw depends only on the row's id, the population name and a salt, never on
partitioning, row order or a session seed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallybook.functions.numeric import Sql, by_segment, clamp, double, ladder, num, text, to_decimal

DRAWS = 15


def add(df: DataFrame, **columns: Sql) -> DataFrame:
    """Add columns given as SQL expressions, in one projection."""
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


def draw_hash(key: Sql, population: Sql, salt: str) -> Sql:
    """Hex digest of ``key|population|salt``; NULL if the key or population is NULL."""
    return f"md5(concat({key}, '|', {population}, {text('|' + salt)}))"


def hash_uniform(key: Sql, population: Sql, salt: str) -> Sql:
    """Uniform double in [0, 1): the digest read as a binary fraction.

    14 hex digits are 56 bits; the 53 a double can hold are kept, so that the result
    can never round up to 1.
    """
    head = f"CAST(conv(substring({draw_hash(key, population, salt)}, 1, 14), 16, 10) AS BIGINT)"
    return f"(CAST(shiftright({head}, 3) AS DOUBLE) * {num(2.0**-53)})"


def with_draws(
    df: DataFrame, key: Sql, population: Sql, n: int = DRAWS, prefix: str = "u"
) -> DataFrame:
    """Add ``n`` independent draws ``u1 .. un``. Map-only."""
    return add(
        df, **{f"{prefix}{i}": hash_uniform(key, population, f"u{i}") for i in range(1, n + 1)}
    )


def draw_date(u: Sql, start: Sql, end: Sql) -> Sql:
    """Date in the closed window [start, end]."""
    return f"date_add({start}, CAST(floor({u} * (datediff({end}, {start}) + 1)) AS INT))"


def draw_category(u: Sql, weights: Mapping[str, Sql]) -> Sql:
    """Label by cumulative weight; the last label takes the rest."""
    *labels, last = weights
    if not labels:
        return text(last)
    edges = [" + ".join(weights[label] for label in labels[: i + 1]) for i in range(len(labels))]
    return ladder([(f"{u} < {double(e)}", text(v)) for e, v in zip(edges, labels)], text(last))


def draw_int_by(segment: Sql, u: Sql, table: Mapping[str, tuple]) -> Sql:
    """Integer ``floor(low + u * width)`` of the row's segment."""
    values = {k: f"floor({low} + {u} * {width})" for k, (low, width) in table.items()}
    return f"CAST({by_segment(segment, values)} AS INT)"


def draw_amount_by(segment: Sql, u: Sql, bounds: Mapping[str, tuple[Sql, Sql]]) -> Sql:
    """Amount spread evenly over the segment's [low, high], in cents."""
    amounts = {
        k: f"{double(low)} + {u} * {double(f'{high} - {low}')}" for k, (low, high) in bounds.items()
    }
    return to_decimal(by_segment(segment, amounts), 18, 2)


def draw_choice_by(segment: Sql, u: Sql, menus: Mapping[str, Sequence[int] | None]) -> Sql:
    """One entry of the segment's menu; NULL for a segment without a menu."""
    choices = {
        k: "NULL"
        if menu is None
        else f"element_at(array({', '.join(map(str, menu))}), 1 + CAST(floor({u} * {len(menu)}) AS INT))"
        for k, menu in menus.items()
    }
    return f"CAST({by_segment(segment, choices)} AS INT)"


def draw_power_by(segment: Sql, u: Sql, table: Mapping[str, tuple], low: Sql, high: Sql) -> Sql:
    """``floor + u^k * spread`` by segment, kept inside [low, high], in cents."""
    shaped = {k: f"{num(a)} + pow({u}, {num(e)}) * {num(s)}" for k, (a, s, e) in table.items()}
    return to_decimal(clamp(by_segment(segment, shaped), low, high), 18, 2)


def draw_with_outliers(
    segment: Sql,
    u: Sql,
    u_outlier: Sql,
    table: Mapping[str, tuple],
    outliers: Mapping[str, tuple],
    low: Sql,
    high: Sql,
) -> Sql:
    """Ranged draw, raised or lowered for outlier rows, kept inside [low, high], 4 digits."""
    base = by_segment(segment, {k: f"{num(a)} + {u} * {num(w)}" for k, (a, w) in table.items()})
    below, raised = outliers["below"]
    above, lowered = outliers["above"]
    bumped = (
        f"{base} + if({u_outlier} < {num(below)}, {num(raised)}, 0D)"
        f" - if({u_outlier} > {num(above)}, {num(lowered)}, 0D)"
    )
    return to_decimal(clamp(bumped, low, high), 12, 4)


def draw_count_with_tail(
    segment: Sql, u: Sql, u_tail: Sql, table: Mapping[str, tuple], limits: tuple[int, int]
) -> Sql:
    """Count by segment with a bump in the tail, kept inside ``limits``."""
    counts = {
        k: f"CAST(floor({low} + {u} * {width}) AS INT) + if({u_tail} > {num(tail)}, {bump}, 0)"
        for k, (low, width, tail, bump) in table.items()
    }
    return f"least({limits[1]}, greatest({limits[0]}, {by_segment(segment, counts)}))"


def draw_ladder_by(segment: Sql, u: Sql, table: Mapping[str, tuple]) -> Sql:
    """Discrete distribution by segment: first rung the draw falls below."""
    climbs = {
        k: ladder([(f"{u} < {num(edge)}", str(v)) for edge, v in rungs], str(above))
        for k, (rungs, above) in table.items()
    }
    return by_segment(segment, climbs)


def draw_flag(u: Sql, chance: float) -> Sql:
    """True with the given chance."""
    return f"({u} < {num(chance)})"


def draw_flag_by(segment: Sql, u: Sql, chances: Mapping[str, float]) -> Sql:
    """True with the chance of the row's segment."""
    return f"({u} < {by_segment(segment, {k: num(p) for k, p in chances.items()})})"


def draw_flag_given(
    condition: Sql,
    segment: Sql,
    u: Sql,
    when_true: Mapping[str, float],
    when_false: Mapping[str, float],
) -> Sql:
    """True with a chance that depends on a flag and the segment; false where none is listed."""
    yes, no = (
        draw_flag_by(segment, u, chances) if chances else "false"
        for chances in (when_true, when_false)
    )
    return f"coalesce(if({condition}, {yes}, {no}), false)"
