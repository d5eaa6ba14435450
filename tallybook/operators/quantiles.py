"""Exact continuous quantiles without holding a column in one task.

The built-in ``percentile`` keeps every distinct value of a group in one buffer.

``aggregate_with_quantiles`` never multiplies rows. Beside a report's other figures the first scan makes approximate quantiles
a little below and above each wanted one. The second counts the rows below and at both ends of these narrow windows; a third,
light one gathers the values strictly inside, whose number is bounded by the sketch's error, however often values repeat. Values
keep their own type, so quantiles of integers and decimals are exact. The counts prove each result; where a window
missed, or windows would hold more than ``WINDOW_VALUES`` values, ``exact_quantiles`` takes over.

``exact_quantiles`` works at any size. A first scan counts rows per cell of an order-preserving histogram, which is
small whatever the row count. The cells that hold the wanted ranks are then the only
ones whose values a second scan looks at. Where such a cell may still hold very many
distinct values, it is split by a finer histogram first.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Context, Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.numeric import Sql
from tallybook.sources.store import stage

CELLS_PER_OCTAVE = 256
FINE_CELLS = 4096
_OFFSET = 1100 * CELLS_PER_OCTAVE  # above the smallest exponent of a double
_NAN_CELL = 2**31 - 1
BROADCAST_ROWS = 100_000
#: Rows over rank error of the first scan's sketches, and values that all windows may hold together.
ACCURACY = 10_000
MOST_GROUPS = 10_000
EXACT = Context(prec=80)
WINDOW_VALUES = 2_000_000
CELL_VALUES = 1_000_000
MAX_SPLITS = 4


def log_cell(x: Column) -> Column:
    """Histogram cell of a double. Cells are ordered as the values are."""
    size = F.least(F.abs(x), F.lit(1.7976931348623157e308))
    rank = F.floor(F.log2(F.nullif(size, F.lit(0.0))) * F.lit(CELLS_PER_OCTAVE)).cast("int")
    signed = F.when(x > 0.0, rank + F.lit(_OFFSET)).otherwise(-(rank + F.lit(_OFFSET)))
    return F.when(F.isnan(x), F.lit(_NAN_CELL)).when(x == 0.0, F.lit(0)).otherwise(signed)


def fine_cell(x: Column, low: Column, high: Column) -> Column:
    """Even split of a cell between its lowest and highest value."""
    share = (x - low) / F.nullif(high - low, F.lit(0.0))
    return F.coalesce(F.floor(share * F.lit(FINE_CELLS)).cast("int"), F.lit(0))


def without_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns with NULL for NaN: what is not a number is missing."""
    floats = [c for c in dict.fromkeys(columns) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def aggregate_with_quantiles(
    df: DataFrame,
    by: Sequence[str],
    figures: Mapping[str, Sql],
    quantiles: Mapping[str, tuple[str, float]],
) -> DataFrame:
    """One row per group with the ``figures``, which are aggregates, and exact ``quantiles`` as (column, prob).

    NaN and NULL take no part in a quantile. The scans run when this is called. Up to ``MOST_GROUPS`` group rows and
    ``WINDOW_VALUES`` values come to the driver, which picks the ranks; beyond either, nothing does.
    """
    wanted: dict[str, list[float]] = {}
    for column, prob in quantiles.values():
        wanted.setdefault(column, []).append(prob)
    wanted = {c: sorted(set(p)) for c, p in wanted.items()}
    df = without_nan(df, list(wanted))
    margin = 2 / ACCURACY
    sums = [F.expr(sql).alias(name) for name, sql in figures.items()]
    for j, (c, probs) in enumerate(wanted.items()):
        edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
        sums.append(F.count(c).alias(f"_n{j}"))
        sums.append(F.percentile_approx(c, F.array(*[F.lit(e) for e in edges]), F.lit(ACCURACY)).alias(f"_w{j}"))
    first = df.groupBy(*by).agg(*sums)
    groups = first.limit(MOST_GROUPS + 1).collect()
    values = sum(g[f"_n{j}"] * len(p) * 6 / ACCURACY for g in groups for j, p in enumerate(wanted.values()))
    found = None
    if len(groups) <= MOST_GROUPS and values <= WINDOW_VALUES:
        found = _from_windows(df, by, groups, wanted)
    if found is None:
        middle = grouped_quantiles(df, quantiles, by)
        plain = df.groupBy(*by).agg(*sums[: len(figures)])
        if not by:
            return plain.crossJoin(middle.select(*quantiles))
        renamed = middle.select(*[F.col(c).alias(f"_{c}") for c in by], *quantiles)
        return plain.join(renamed, _same(by), "left").select(*by, *figures, *quantiles)
    columns = [f for f in first.schema.fields if not f.name.startswith(("_n", "_w")) or f.name in figures]
    schema = T.StructType([*columns, *[T.StructField(n, _result_type(df.schema[c].dataType)) for n, (c, _) in quantiles.items()]])
    names = list(wanted)
    rows = [
        [*[g[f.name] for f in columns], *[found[_key(g, by), names.index(c), p] for c, p in quantiles.values()]] for g in groups
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def _same(by: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])


def _key(row: T.Row, by: Sequence[str]) -> tuple:
    """The group of a row; NaN equals itself."""
    return tuple("NaN" if row[c] != row[c] else row[c] for c in by)


def _exact(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.precision <= 28


def _result_type(kind: T.DataType) -> T.DataType:
    return T.DecimalType(38, getattr(kind, "scale", 0) + 6) if _exact(kind) else T.DoubleType()


def _from_windows(df: DataFrame, by: Sequence[str], groups: Sequence[T.Row], wanted: Mapping[str, list[float]]) -> dict | None:
    """(group, column, prob) -> value, from the counts and contents of the groups' windows; None if a window missed.

    Rows are counted in compiled code; only the few that lie strictly inside a window reach the arrays.
    """
    places = [(j, c, k) for j, (c, probs) in enumerate(wanted.items()) for k in range(len(probs))]
    fields = [T.StructField(f"_{c}", df.schema[c].dataType) for c in by]
    fields += [T.StructField(f"_{e}{j}_{k}", df.schema[c].dataType) for j, c, k in places for e in ("low", "high")]
    ends = [
        [*[g[c] for c in by], *[_outward(g[f"_w{j}"], 2 * k + side, df.schema[c].dataType, side) for j, c, k in places for side in (0, 1)]]
        for g in groups
    ]
    windows = df.sparkSession.createDataFrame(ends, T.StructType(fields))
    rows = df.select(*by, *[F.col(c).alias(f"_x{j}") for j, c in enumerate(wanted)])
    rows = rows.join(F.broadcast(windows), _same(by)) if by else rows.crossJoin(F.broadcast(windows))
    counts, inside, arrays = [], [], []
    for j, _, k in places:
        x, low, high, at = f"_x{j}", f"_low{j}_{k}", f"_high{j}_{k}", f"{j}_{k}"
        counts += [
            f"count_if({x} < {low}) AS _below{at}",
            f"count_if({x} = {low}) AS _first{at}",
            f"count_if({x} = {high} AND {high} > {low}) AS _last{at}",
        ]
        inside.append(f"({x} > {low} AND {x} < {high})")
        arrays.append(f"collect_list(if({inside[-1]}, {x}, NULL)) AS _inside{at}")
    counted = rows.groupBy(*by).agg(*[F.expr(c) for c in counts])
    gathered = rows.where(" OR ".join(inside)).groupBy(*by).agg(*[F.expr(a) for a in arrays])
    counted, gathered = ({_key(r, by): r for r in table.collect()} for table in (counted, gathered))
    out = {}
    for g, edge in zip(groups, ends):
        key = _key(g, by)
        for i, (j, c, k) in enumerate(places):
            low, high = edge[len(by) + 2 * i : len(by) + 2 * i + 2]
            prob, n, at = wanted[c][k], g[f"_n{j}"], f"{j}_{k}"
            if not n:
                out[key, j, prob] = None
                continue
            r, held = counted[key], gathered.get(key)
            values = sorted(held[f"_inside{at}"]) if held else []
            value = _interpolated(df.schema[c].dataType, n, prob, r[f"_below{at}"], (low, r[f"_first{at}"]), values, (high, r[f"_last{at}"]))
            if value is None:
                return None
            out[key, j, prob] = value
    return out


def _outward(edges, at: int, kind: T.DataType, side: int):
    """The end of a window in its own type. A sketch holds doubles; where these skip whole units, the window is widened."""
    edge = edges[at] if edges else None
    if edge is None or not isinstance(kind, (T.IntegralType, T.DecimalType)):
        return edge
    scale = getattr(kind, "scale", 0)
    units = int(Decimal(edge).scaleb(scale, EXACT))
    if abs(units) > 2**52:
        units += (abs(units) >> 51) * (1 if side else -1)
        bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}.get(type(kind))
        top = 2**bits - 1 if bits else 10**kind.precision - 1
        units = max(-top, min(top, units))
    return Decimal(units).scaleb(-scale, EXACT) if isinstance(kind, T.DecimalType) else units


def _interpolated(kind: T.DataType, n: int, prob: float, below: int, first: tuple, inside: Sequence, last: tuple):
    """The quantile of n values, from how many lie below a window, at its ends, and those inside; None outside of it."""
    place = (n - 1) * Fraction(str(prob))

    def value(rank: int):
        rank -= below
        if 0 <= rank < first[1]:
            return first[0]
        rank -= first[1]
        if 0 <= rank < len(inside):
            return inside[rank]
        return last[0] if 0 <= rank - len(inside) < last[1] else None

    low, high = value(math.floor(place)), value(math.ceil(place))
    if low is None or high is None:
        return None
    share = place - math.floor(place)
    if not _exact(kind):
        return float(low) if low == high else float(low) + float(share) * (float(high) - float(low))
    exact = Fraction(low) + share * (Fraction(high) - Fraction(low))
    digits = getattr(kind, "scale", 0) + 6
    return Decimal(math.floor(exact * 10**digits + Fraction(1, 2))).scaleb(-digits, EXACT)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles by group, interpolated between neighbours; NULL values are ignored.

    One row per group, ``variable`` and ``prob`` with ``value``. The histograms are
    computed when this is called and staged in the shared folder, so each scan of
    ``df`` runs once and the number of wanted cells is known. While it is small the
    cells are broadcast and all other rows are dropped at the scan. With very many
    groups, rows are first counted by distinct value, so that equal values do not
    meet in one task, and Spark picks the join.
    """
    key = [*by, "variable"]
    cell_key = [*key, "cell"]
    rows = long_form(df, columns, by).where(F.col("x").isNotNull())
    rows = rows.withColumn("cell", log_cell(F.col("x")))
    cells = _histogram(rows, cell_key)
    wanted = stage(_cells_with_ranks(cells, key, probs), "cells")
    most_values = _most_values([df.schema[c].dataType for c in columns])
    count, values = wanted.agg(F.count("*"), most_values).first()
    small = count <= BROADCAST_ROWS
    if not small:
        rows = rows.groupBy(*cell_key, "x").agg(F.count("*").alias("n"))
    for split in range(MAX_SPLITS):
        if (values or 0) <= CELL_VALUES:
            break
        fine = f"fine_{split}"
        rows = _keep(rows, wanted, cell_key, ["low", "high"], small)
        rows = rows.withColumn(fine, fine_cell(F.col("x"), F.col("low"), F.col("high")))
        rows = rows.drop("low", "high")
        cells = _histogram(rows, [*cell_key, fine])
        wanted = stage(_fine_cells_with_ranks(cells, cell_key, fine, wanted, small), fine)
        cell_key = [*cell_key, fine]
        values = wanted.agg(most_values).first()[0]
    rows = _keep(rows, wanted, cell_key, [], small)
    if small:
        rows = rows.groupBy(*cell_key, "x").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return _interpolate(rows, wanted, key, cell_key, small).withColumn(
        "variable", F.get(names, F.col("variable"))
    )


def grouped_quantiles(
    df: DataFrame,
    outputs: Mapping[str, tuple[str, float]],
    by: Sequence[str],
) -> DataFrame:
    """Quantiles as columns: ``outputs`` maps a name to (column, prob)."""
    columns = list(dict.fromkeys(c for c, _ in outputs.values()))
    probs = sorted({p for _, p in outputs.values()})
    long = exact_quantiles(df, columns, probs, by)
    picked = [
        F.max(F.when((F.col("variable") == c) & (F.col("prob") == p), F.col("value"))).alias(name)
        for name, (c, p) in outputs.items()
    ]
    return long.groupBy(*by).agg(*picked)


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per value: group columns, position of the ``variable`` and ``x`` as double."""
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*by, F.posexplode(values).alias("variable", "x"))


def _most_values(types: Sequence[T.DataType]) -> Column:
    """Upper bound of the distinct values in the fullest cell."""
    units = [
        10.0 ** getattr(t, "scale", 0)
        if isinstance(t, (T.IntegralType, T.DecimalType))
        else float("inf")
        for t in types
    ]
    unit = F.get(F.array(*[F.lit(u) for u in units]), F.col("variable"))
    steps = F.when(F.col("low") == F.col("high"), F.lit(1.0)).otherwise(
        (F.col("high") - F.col("low")) * unit + F.lit(1.0)
    )
    return F.max(F.least(F.col("n").cast("double"), steps))


def _histogram(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows and limits per cell. Partial counts are made before the shuffle."""
    n = F.sum("n") if "n" in rows.columns else F.count("*")
    return rows.groupBy(*key).agg(
        n.alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )


def _cells_with_ranks(cells: DataFrame, key: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Cells that hold a wanted rank, with the number of rows ``before`` them.

    Windows run over the cells of one group and variable, never over its rows.
    """
    group = Window.partitionBy(*key)
    position = F.col("prob") * (F.col("total") - F.lit(1))
    counted = cells.withColumns(
        {
            "total": F.sum("n").over(group),
            "before": F.sum("n").over(group.orderBy("cell")) - F.col("n"),
        }
    )
    ranked = counted.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    ranked = ranked.withColumns(
        {
            "at": F.floor(position),
            "next": F.ceil(position),
            "share": position - F.floor(position),
        }
    )
    return _holding(ranked).select(
        *key, "cell", "prob", "at", "next", "share", "before", "n", "low", "high"
    )


def _fine_cells_with_ranks(
    cells: DataFrame, cell_key: Sequence[str], fine: str, wanted: DataFrame, small: bool
) -> DataFrame:
    """Same for the fine cells: counts continue from the coarse cell they split."""
    ranks = wanted.select(*cell_key, "prob", "at", "next", "share", "before")
    within = Window.partitionBy(*cell_key, "prob").orderBy(fine)
    counted = _join(cells, F.broadcast(ranks) if small else ranks, cell_key).withColumn(
        "before", F.col("before") + F.sum("n").over(within) - F.col("n")
    )
    return _holding(counted).select(
        *cell_key, fine, "prob", "at", "next", "share", "before", "n", "low", "high"
    )


def _holding(cells: DataFrame) -> DataFrame:
    first, last = F.col("before"), F.col("before") + F.col("n") - F.lit(1)
    return cells.where((first <= F.col("next")) & (last >= F.col("at")))


def _keep(
    rows: DataFrame, wanted: DataFrame, key: Sequence[str], carry: Sequence[str], small: bool
) -> DataFrame:
    """Rows in wanted cells, with the ``carry`` columns of the cell."""
    cells = wanted.select(*key, *carry).distinct()
    return _join(rows, F.broadcast(cells) if small else cells, key)


def _join(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join in which NULL group keys match. Variables and cells are never NULL."""
    carried = [c for c in right.columns if c not in key]
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in key], *carried)
    first = list(key).index("variable")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key[:first]]
    same += [F.col(c) == F.col(f"_{c}") for c in key[first:]]
    same = reduce(lambda a, b: a & b, same)
    return left.join(renamed, same).select(*left.columns, *carried)


def _interpolate(
    values: DataFrame, wanted: DataFrame, key: Sequence[str], cell_key: Sequence[str], small: bool
) -> DataFrame:
    """Value at the wanted ranks. Windows run over the distinct values of one cell."""
    ranks = wanted.select(*cell_key, "prob", "at", "next", "share", "before")
    within = Window.partitionBy(*cell_key, "prob").orderBy("x")
    placed = _join(values, F.broadcast(ranks) if small else ranks, cell_key).withColumn(
        "start", F.col("before") + F.sum("n").over(within) - F.col("n")
    )

    def value_at(rank: str) -> Column:
        inside = (F.col("start") <= F.col(rank)) & (F.col("start") + F.col("n") > F.col(rank))
        return F.max(F.when(inside, F.col("x")))

    low, high = F.col("_low"), F.col("_high")
    exact = F.when(low == high, low).otherwise(low + F.col("_share") * (high - low))
    return (
        placed.groupBy(*key, "prob")
        .agg(
            value_at("at").alias("_low"),
            value_at("next").alias("_high"),
            F.max("share").alias("_share"),
        )
        .select(*key, "prob", exact.alias("value"))
    )
