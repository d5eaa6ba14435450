"""From keys to a scored application table, for one scenario or many."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.calibration import DEFAULT, Calibration
from tallybook.functions.draws import add, with_draws
from tallybook.operators.borrower import with_borrower, with_segments
from tallybook.operators.risk import with_loss, with_pd
from tallybook.operators.structure import with_structure
from tallybook.params import BORROWER_FIELDS, STRUCTURE_FIELDS, Scenario, bind, load_scenarios
from tallybook.schema import APPLICATION_SCHEMA, AUDIT_COLUMNS
from tallybook.sources.keys import with_ids

#: Scenarios scored in one pass.
SLICE = 200
SEGMENTS = ("product_type", "score_band")


def with_created_ts(df: DataFrame) -> DataFrame:
    """Audit column. It differs between runs, so leave it out of comparisons."""
    return add(df, created_ts="current_timestamp()")


def finalize(df: DataFrame, audit: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """Project to the application schema, in order, and the extra columns."""
    if audit:
        df = with_created_ts(df)
    return df.selectExpr(
        *[
            f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in APPLICATION_SCHEMA
            if audit or f.name not in AUDIT_COLUMNS
        ],
        *extra,
    )


def score_portfolio(
    keys: DataFrame,
    scenario: Scenario = Scenario(),
    cal: Calibration = DEFAULT,
    pad: int = 8,
    audit: bool = True,
) -> DataFrame:
    """Score every key under one scenario. Map-only; also accepts a stream."""
    return score_scenarios(keys, [scenario], cal, pad, audit)


def score_scenarios(
    keys: DataFrame,
    scenarios: Sequence[Scenario] | DataFrame,
    cal: Calibration = DEFAULT,
    pad: int = 8,
    audit: bool = True,
    reference: Scenario | None = None,
) -> DataFrame:
    """Score every key under every scenario, in one map-only pass.

    Rows multiply as late as possible: draws are made once per population, borrower
    columns once per distinct set of borrower parameters, structure and PD once per distinct set of
    amounts and rates, and only the loss once per scenario. Rows are multiplied with a literal array, so
    there is no join; parameters that all scenarios share stay literals. Scenarios may
    also come as a parameter table, see ``scenario_table``. More than ``SLICE`` scenarios are
    scored slice by slice, each map-only, so that no expression grows with their number.

    With a ``reference`` scenario of the same population, every row also gets the segments that its
    borrower has under it, as ``base_product_type`` and ``base_score_band``.
    """
    if isinstance(scenarios, DataFrame) and keys.isStreaming:
        scenarios = load_scenarios(scenarios)  # nothing can be staged
    if isinstance(scenarios, DataFrame):
        from tallybook.plans.scenario_table import score_table

        return score_table(keys, scenarios, cal, pad, audit)
    scenarios = list(scenarios)
    names = [(s.scenario_name, s.population_id) for s in scenarios]
    if not scenarios or len(set(names)) != len(names):
        raise ValueError("scenarios need distinct scenario_name and population_id pairs")
    slices = [scenarios[i : i + SLICE] for i in range(0, len(scenarios), SLICE)]
    return reduce(DataFrame.unionAll, [_score(keys, s, cal, pad, audit, reference) for s in slices])


def _score(
    keys: DataFrame,
    scenarios: Sequence[Scenario],
    cal: Calibration,
    pad: int,
    audit: bool,
    reference: Scenario | None = None,
) -> DataFrame:
    populations = _distinct(s.population_id for s in scenarios)
    borrowers = _distinct(_borrower(s) for s in scenarios)
    examples = [next(s for s in scenarios if _borrower(s) == b) for b in borrowers]

    df = _multiply(with_ids(keys, pad=pad), "_population", None, [range(1, len(populations) + 1)])
    first = [next(s for s in scenarios if s.population_id == p) for p in populations]
    df = add(df, population_id=bind(first, "_population")("population_id"))
    df = fenced(with_draws(df, "application_id", "population_id"))
    if reference:
        df = with_segments(df, bind([reference])).selectExpr(
            "* EXCEPT (application_date, product_type, score_band)",
            *[f"{c} AS base_{c}" for c in SEGMENTS],
        )

    df = _multiply(
        df,
        "_borrower",
        "_population",
        [[i for i, b in enumerate(borrowers, 1) if b[0] == p] for p in populations],
    )
    df = fenced(with_borrower(df, bind(examples, "_borrower"), cal))

    structures = _distinct(_structure(s) for s in scenarios)
    examples = [next(s for s in scenarios if _structure(s) == t) for t in structures]
    df = _multiply(
        df,
        "_structure",
        "_borrower",
        [[i for i, s in enumerate(examples, 1) if _borrower(s) == b] for b in borrowers],
    )
    df = with_pd(fenced(with_structure(df, bind(examples, "_structure"), cal)), cal)
    df = _multiply(
        df if len(structures) == len(scenarios) else fenced(df),
        "_scenario",
        "_structure",
        [[i for i, s in enumerate(scenarios, 1) if _structure(s) == t] for t in structures],
    )
    params = bind(scenarios, "_scenario")
    df = add(df, scenario_name=params("scenario_name"), anchor_date=params("anchor_date"))
    extra = [f"base_{c}" for c in SEGMENTS] if reference else []
    return finalize(with_loss(df, params), audit, extra)


def fenced(df: DataFrame) -> DataFrame:
    """The same rows behind a generator that predicates do not cross.

    A filter on a computed column would otherwise be pushed down through every projection
    and be computed, with all that it depends on, once more for each use.
    """
    return df.selectExpr("inline(array(struct(*)))")


def _borrower(scenario: Scenario) -> tuple:
    return tuple(getattr(scenario, n) for n in BORROWER_FIELDS)


def _structure(scenario: Scenario) -> tuple:
    return tuple(getattr(scenario, n) for n in STRUCTURE_FIELDS)


def _distinct(values: Iterable) -> list:
    return list(dict.fromkeys(values))


def _multiply(df: DataFrame, column: str, parent: str | None, members: Sequence) -> DataFrame:
    """One row per member of the row's parent. A single member needs no new rows."""
    groups = [f"array({', '.join(map(str, m))})" for m in members]
    if len(members) == 1 and len(members[0]) == 1:
        return add(df, **{column: str(members[0][0])})
    if len(members) == 1:
        return add(df, **{column: f"explode({groups[0]})"})
    if all(len(m) == 1 for m in members):
        return add(df, **{column: f"element_at(array({', '.join(str(m[0]) for m in members)}), {parent})"})
    return add(df, **{column: f"explode(element_at(array({', '.join(groups)}), {parent}))"})


def compare_scenarios(
    df: DataFrame,
    base: str,
    alt: str,
    by: Sequence[str] = ("product_type",),
    measures: Sequence[str] = (
        "requested_amount",
        "monthly_payment_proxy",
        "estimated_pd",
        "expected_loss_amount",
    ),
) -> DataFrame:
    """Compare two scenarios of one table key by key, then by segment.

    Rows are matched on population and application. Segments are those of the base
    scenario; rows that only one scenario has are counted, not dropped. A key that a
    scenario has twice is an error.
    """
    matched = match_scenarios(df, base, alt, by, measures)
    both = F.col("in_base") & F.col("in_alt")
    aggs = [
        F.count_if(both).alias("matched"),
        F.count_if(~F.coalesce(F.col("in_alt"), F.lit(False))).alias("only_base"),
        F.count_if(~F.coalesce(F.col("in_base"), F.lit(False))).alias("only_alt"),
    ]
    for m in measures:
        delta = F.when(both, F.col(f"alt_{m}") - F.col(f"base_{m}"))
        aggs += [
            F.sum(F.when(both, F.col(f"base_{m}"))).alias(f"base_{m}"),
            F.sum(F.when(both, F.col(f"alt_{m}"))).alias(f"alt_{m}"),
            F.sum(delta).alias(f"delta_{m}"),
        ]
    return matched.groupBy(*by).agg(*aggs).orderBy(*by)


def match_scenarios(
    df: DataFrame, base: str, alt: str, by: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Base and alternative values side by side, one row per application.

    One scan and one grouping by application. On a table saved with
    ``save_portfolio_table`` the rows are already bucketed that way, so that no exchange is needed.
    """
    keys = ("population_id", "application_seq")
    by = [c for c in by if c not in keys]
    of = {"base": F.col("scenario_name") == base, "alt": F.col("scenario_name") == alt}
    values = [
        F.max(F.when(own, F.col(c))).alias(f"{side}_{c}") for c in (*by, *measures) for side, own in of.items()
    ]
    counts = [F.count_if(own).alias(f"n_{side}") for side, own in of.items()]
    grouped = df.where(of["base"] | of["alt"]).groupBy(*keys).agg(*values, *counts)
    once = F.when(
        (F.col("n_base") > 1) | (F.col("n_alt") > 1),
        F.raise_error(F.concat(F.lit("application repeated in a scenario: "), F.col("application_seq").cast("string"))).cast("boolean"),
    )
    segments = [F.coalesce(F.col(f"base_{c}"), F.col(f"alt_{c}")).alias(c) for c in by]
    sides = [F.col(f"{side}_{m}") for m in measures for side in ("base", "alt")]
    return grouped.select(
        *keys,
        *segments,
        *sides,
        F.coalesce(once, F.col("n_base") > 0).alias("in_base"),
        (F.col("n_alt") > 0).alias("in_alt"),
    )
