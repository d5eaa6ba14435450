"""Exact quantiles against brute force."""

import math
import random
from decimal import Decimal

import pytest

from tallybook.operators import quantiles as Q

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def brute(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (at - math.floor(at)) * (high - low)


def rows(n, seed):
    rng = random.Random(seed)
    groups = ["a", "a", "a", "b", None]
    out = []
    for _ in range(n):
        skewed = 0.0 if rng.random() < 0.35 else rng.lognormvariate(3, 4) * rng.choice((-1, 1))
        money = Decimal(rng.randrange(0, 5_000_000)) / 100
        out.append((rng.choice(groups), skewed, money, rng.choice((None, 1, 2, 3))))
    out.append(("single", 2.5, Decimal("1.00"), 7))
    out.append(("empty", None, None, None))
    return out


@pytest.mark.parametrize("broadcast", [100_000, 0])
@pytest.mark.parametrize("cell_values", [1_000_000, 3])
@pytest.mark.parametrize("by", [(), ("g",)])
@pytest.mark.parametrize("columns", [("x", "m", "k"), ("m", "k")])
def test_matches_brute_force(spark, monkeypatch, broadcast, cell_values, by, columns):
    monkeypatch.setattr(Q, "CELL_VALUES", cell_values)
    monkeypatch.setattr(Q, "BROADCAST_ROWS", broadcast)
    data = rows(1500, 7)
    df = spark.createDataFrame(data, "g string, x double, m decimal(18,2), k int").repartition(5)
    got = {
        ((r.g if by else "all"), r.variable, r.prob): r.value
        for r in Q.exact_quantiles(df, columns, PROBS, by).collect()
    }
    position = {"x": 1, "m": 2, "k": 3}
    want = {}
    for group in {r[0] for r in data} if by else {"all"}:
        for c in columns:
            values = [
                float(r[position[c]])
                for r in data
                if (not by or r[0] == group) and r[position[c]] is not None
            ]
            for p in PROBS if values else ():
                want[group, c, p] = brute(values, p)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)


def test_cells_keep_order(spark):
    values = [-1e308, -5.0, -1e-300, 0.0, 1e-300, 0.5, 1.0, 2.0, 1e308, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    cells = [r.c for r in df.select(Q.log_cell(df.x).alias("c")).collect()]
    assert cells == sorted(cells)


def test_grouped_quantiles(spark):
    df = spark.range(101).selectExpr("id % 2 AS g", "CAST(id AS INT) AS v")
    out = Q.grouped_quantiles(df, {"mid": ("v", 0.5), "top": ("v", 1.0)}, ["g"])
    assert {r.g: (r.mid, r.top) for r in out.collect()} == {0: (50.0, 100.0), 1: (50.0, 99.0)}
