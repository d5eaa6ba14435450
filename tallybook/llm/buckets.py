"""Buckets of rows that are compared with each other, each dealt to a task whole or in slices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliced(rows: DataFrame, key: Sequence[str], node: str, most: int) -> DataFrame:
    """The rows with columns own, a and b: a bucket of more than `most` rows is cut into slices by hash.

    Each pair of slices (a <= b) is a unit of work of its own, so a row of a bucket in s slices comes s
    times, with its `own` slice; any two rows of a bucket meet in one unit, or, if of the same slice,
    in every unit of that slice, of which a = b counts.
    """
    hot = rows.groupBy(*key).count().where(F.col("count") > most)
    hot = hot.select(*key, F.ceil(F.col("count") / most).cast("int").alias("_s"))
    dealt = rows.join(hot, list(key), "left").selectExpr(
        "* EXCEPT (_s)", "coalesce(_s, 1) AS _s", f"CAST(pmod(xxhash64({node}), coalesce(_s, 1)) AS INT) AS own"
    )
    return dealt.selectExpr("* EXCEPT (_s)", "explode(sequence(0, _s - 1)) AS _q").selectExpr(
        "* EXCEPT (_q)", "least(own, _q) AS a", "greatest(own, _q) AS b"
    )


def by_bucket(rows: DataFrame, key: Sequence[str], work: Callable, schema: str) -> DataFrame:
    """`work(frame, starts, ends)` on frames of whole buckets, rows of one key being dealt to one task.

    A task holds one batch and the bucket that goes on beyond it.
    """
    import pandas as pd

    key = list(key)

    def edges(frame):
        new = np.ones(len(frame), bool)
        for k in key:
            values = frame[k].to_numpy()
            new[1:] &= values[1:] == values[:-1]
        new[1:] = ~new[1:]
        starts = np.flatnonzero(new)
        return starts, np.append(starts[1:], len(frame))

    def run(batches):
        held = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(frame):
                continue
            starts, ends = edges(frame)
            last = starts[-1]  # the last bucket may go on
            held = frame.iloc[last:]
            if last:
                yield work(frame.iloc[:last], starts[:-1], ends[:-1])
        if held is not None and len(held):
            held = held.reset_index(drop=True)
            yield work(held, *edges(held))

    return rows.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, schema)


def pairs_by_offset(starts: np.ndarray, ends: np.ndarray):
    """All pairs (i, j), i < j, of each range of positions, as arrays of one distance at a time."""
    sizes = ends - starts
    at = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)]) if len(starts) else np.empty(0, np.int64)
    stop = np.repeat(ends, sizes)
    apart = 1
    while len(at):
        inside = at + apart < stop
        at, stop = at[inside], stop[inside]
        if len(at):
            yield at, at + apart
        apart += 1


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches over the pairs."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            break
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (u, v) of what pairs of positions connect, positions of an equal node being one."""
    names, place = np.unique(nodes, return_inverse=True)
    low = least_reached(len(names), place[a], place[b])
    tied = np.flatnonzero(low != np.arange(len(names)))
    return names[tied], names[low[tied]]
