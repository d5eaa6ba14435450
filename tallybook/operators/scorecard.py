"""Scorecards from a table of breakpoints, for any table.

A breakpoint row says which ``points`` a value from ``low`` (included) up to ``high`` (excluded) of a ``characteristic`` gets;
an open end is NULL. The intervals of a characteristic must meet: a gap or an overlap is refused before any row is scored. The table,
whose rows are counted, becomes one row of sorted arrays that every task gets; a value finds its interval by binary search.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.numeric import Sql, text

#: Rows of a breakpoint table: 32 bytes each, so a broadcast of 3 MB at most.
MOST_ROWS = 100_000
STEPS = 17  # 2^17 > MOST_ROWS


def breakpoint_checks(table: DataFrame) -> DataFrame:
    """One row per rule: rule, ok, observed."""
    order = Window.partitionBy("characteristic").orderBy(F.asc_nulls_first("low"))
    placed = table.select(
        "characteristic",
        "low",
        "high",
        "points",
        F.lag("high").over(order).alias("before"),
        F.row_number().over(order).alias("nth"),
        F.count("*").over(Window.partitionBy("characteristic")).alias("many"),
    )
    rules = {
        "characteristic_present": "characteristic IS NULL",
        "points_present": "points IS NULL",
        "interval_not_empty": "low >= high",
        "first_is_open_below": "nth = 1 AND low IS NOT NULL",
        "last_is_open_above": "nth = many AND high IS NOT NULL",
        "no_gap": "nth > 1 AND low > before",
        "no_overlap": "nth > 1 AND (low IS NULL OR before IS NULL OR low < before)",
    }
    counts = placed.agg(*[F.count_if(F.expr(test)).alias(rule) for rule, test in rules.items()], F.count("*").alias("rows"))
    rows = [f"struct({text(r)} AS rule, {r} = 0 AS ok, CAST({r} AS STRING) AS observed)" for r in rules]
    rows.append(f"struct('few_enough_rows' AS rule, rows <= {MOST_ROWS} AS ok, CAST(rows AS STRING) AS observed)")
    return counts.selectExpr(f"inline(array({', '.join(rows)}))")


def checked(table: DataFrame) -> DataFrame:
    """The table, or a ``ValueError`` with the rules that it breaks."""
    wrong = [f"{r.rule} ({r.observed})" for r in breakpoint_checks(table).where("NOT ok").collect()]
    if wrong:
        raise ValueError("; ".join(wrong))
    return table


def found_at(sorted_: Sql, x: Sql) -> Sql:
    """How many entries of a sorted array are at most ``x``, by binary search."""
    middle = "CAST((s.a + s.b) DIV 2 AS INT)"
    step = (
        f"CASE WHEN s.a >= s.b THEN s WHEN get({sorted_}, {middle}) <= {x}"
        f" THEN named_struct('a', {middle} + 1, 'b', s.b) ELSE named_struct('a', s.a, 'b', {middle}) END"
    )
    start = f"named_struct('a', 0, 'b', size({sorted_}))"
    return f"aggregate(sequence(1, {STEPS}), {start}, (s, i) -> {step}, s -> s.a)"


def with_points(
    df: DataFrame, table: DataFrame, values: Mapping[str, Sql], missing: Sql = "NULL", prefix: str = "points_"
) -> DataFrame:
    """Add ``points_<characteristic>`` for each value expression; a NULL or NaN value gets ``missing``.

    A characteristic that the table lacks is an error.
    """
    table = checked(table)
    known = {r[0] for r in table.select("characteristic").distinct().collect()}
    if set(values) - known:
        raise ValueError(f"no breakpoints for {sorted(set(values) - known)}")
    row = F.struct(F.col("low").isNotNull().alias("closed"), "low", "points")
    own = [F.array_sort(F.collect_list(F.when(F.col("characteristic") == c, row))) for c in values]
    one = table.agg(F.lit(1).alias("_one"), *[rows.alias(f"_t{i}") for i, rows in enumerate(own)])
    # the first interval is open below, so a value's place among the other lows is its interval
    arrays = [f"slice(_t{i}.low, 2, size(_t{i})) AS _low{i}" for i in range(len(values))]
    arrays += [f"_t{i}.points AS _points{i}" for i in range(len(values))]
    joined = df.crossJoin(F.broadcast(one.selectExpr(*arrays)))
    columns = []
    for i, (name, x) in enumerate(values.items()):
        place = found_at(f"_low{i}", f"({x})")
        columns.append(f"if(({x}) IS NULL OR isnan(({x})), {missing}, get(_points{i}, {place})) AS {prefix}{name}")
    kept = [f"`{c}`" for c in df.columns]
    return joined.selectExpr(*kept, *columns)
