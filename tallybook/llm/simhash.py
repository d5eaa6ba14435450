"""Operator 5: SimHash near-duplicates by a self-join of a binary trie.

A text's fingerprint has 64 bits: a bit is 1 if it is set in more than half of the XXH64 hashes of
the text's shingles. Distinct fingerprints within `budget` differing bits are linked, and documents
of one component of links are copies of each other.

The trie of all fingerprints is joined with itself in parts. If the bits are cut into m blocks, two
fingerprints within the budget agree in m - budget blocks at least, so for each choice of blocks
the fingerprints with the same bits there form a part, and every link is in some part. m follows from
the number of fingerprints, so that parts stay small as it grows. In a part, the join starts at
the pair (root, root) and goes down bit by bit: a pair of nodes gives the pairs of their children,
with one error more where the bits differ, and goes as soon as its errors exceed the budget. The
nodes are ranges of the sorted fingerprints, and a whole level of many parts is one numpy step.

A part with more than `PART` fingerprints is dealt into several, and every two of them are joined
in a task of their own. A task returns the links of a spanning forest of its pairs, at most one for
each fingerprint, so that large groups of copies do not give all their pairs; components over all
tasks follow by `components.roots`.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other;
a text with fewer words than a shingle is one shingle; repeated rows are copies; a null id never
names a component unless the component has no other; of rows that tie the first by all their columns stays; a text
of any length is shingled at once, with some 40 bytes a word; an empty table gives an empty one; extra columns are left out
of fingerprints and pass through `drop_copies`, whatever their names.

The pipeline's stage, `drop_copies`, makes its fingerprints from five words and joins their trie in the same way; what
the trie links is a candidate, and an exact check of the Jaccard similarity, 0.8 or more, follows in `likeness`. Pairs
of that similarity may lie further apart than a trie can afford to join, so `likeness` adds the candidates that a prefix join finds.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import likeness
from tallybook.llm.common import checkpointed, files_for, fresh, map_rows, pick, table
from tallybook.llm.components import roots

SHINGLE = 4
BUDGET = 4
PART = 1000
ROWS = 150_000
BYTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    h = likeness.shingle_hashes(text, shingle)
    n = len(h)
    if not n:
        return 0
    columns = h.astype(">u8").view(np.uint8).reshape(n, 8).astype(np.int64) + np.arange(8) * 256
    seen = np.bincount(columns.ravel(), minlength=2048).reshape(8, 256)
    bits = (seen @ BYTES).ravel() * 2 > n
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp."""

    def make():
        return lambda _, texts: [[fingerprint(t, shingle) for t in texts]]

    return map_rows(docs, ["doc_id", "text"], make, "fp bigint")


def block_masks(count: int, budget: int) -> list[int]:
    """Masks of the bits that a part shares, as signed numbers, for so many fingerprints."""
    m = budget + 1
    while m < 64 and 2 ** (64 * (m - budget) // m) < count:
        m += 1
    edges = [64 * i // m for i in range(m + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    masks = [sum(c) for c in itertools.combinations(blocks, m - budget)]
    return [x - 2**64 if x >= 2**63 else x for x in masks]


def near_pairs(fp: np.ndarray, first: np.ndarray, last: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within the budget in each range of sorted, distinct fingerprints."""
    a0, a1, b0, b1 = first, last, first, last
    errors = np.zeros(len(first), np.int8)
    for bit in range(63, -1, -1):
        ones = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        apart = ~same
        parts = (
            (a0, am, b0, bm, errors, None),
            (am, a1, bm, b1, errors, None),
            (a0, am, bm, b1, errors + np.int8(1), None),
            (am, a1, b0, bm, errors + np.int8(1), apart),
        )
        kept = []
        for x0, x1, y0, y1, e, where in parts:
            ok = (x1 > x0) & (y1 > y0) & (e <= budget) & ((x0 != y0) | (x1 - x0 > 1))
            if where is not None:
                ok &= where
            kept.append([x[ok] for x in (x0, x1, y0, y1, e)])
        a0, a1, b0, b1, errors = (np.concatenate(c) for c in zip(*kept))
    return a0, b0


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
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
    return label


def part_links(group: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (u, v) of whole groups of fingerprints."""
    order = np.lexsort((fp, group))
    group, fp = group[order], fp[order]
    fresh_ = np.concatenate([[True], (group[1:] != group[:-1]) | (fp[1:] != fp[:-1])])
    group, fp = group[fresh_], fp[fresh_]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.append(starts[1:], len(group))
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    work = np.cumsum((ends - starts) ** 2)
    u, v = [], []
    at = 0
    while at < len(starts):  # so many parts at once as their pairs fit in memory
        done = work[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(work, done + 4 * PART * PART)))
        a, b = near_pairs(fp, starts[at:to], ends[at:to], budget)
        lo, hi = starts[at], ends[to - 1]
        label = forest(hi - lo, a - lo, b - lo)
        tied = np.flatnonzero(label != np.arange(hi - lo))
        u.append(fp[tied + lo])
        v.append(fp[label[tied] + lo])
        at = to
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *u]), np.concatenate([empty, *v])


def links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """u, v: links that connect what is within the budget, from a table of distinct `fp`."""
    import pandas as pd

    masks = block_masks(distinct.count(), budget)
    each = ", ".join(f"named_struct('c', {i}, 'k', fp & {m}L)" for i, m in enumerate(masks))
    keyed = distinct.selectExpr("fp", f"inline(array({each}))")
    hot = keyed.groupBy("c", "k").count().where(F.col("count") > PART)
    hot = hot.select("c", "k", F.ceil(F.col("count") / PART).cast("int").alias("s"))
    dealt = keyed.join(hot, ["c", "k"], "left").selectExpr(
        "c", "k", "fp", "coalesce(s, 1) AS s", "CAST(pmod(xxhash64(fp), coalesce(s, 1)) AS INT) AS p"
    )
    tasks = dealt.selectExpr("c", "k", "fp", "p", "explode(sequence(0, s - 1)) AS q").selectExpr(
        "c", "k", "least(p, q) AS a", "greatest(p, q) AS b", "fp"
    )
    key = ["c", "k", "a", "b"]
    sorted_ = tasks.repartition(*key).sortWithinPartitions(*key)

    def run(batches):
        held, size = [], 0

        def flush(rows):
            same = np.ones(len(rows), bool)
            same[1:] = (rows[key].values[1:] == rows[key].values[:-1]).all(axis=1)
            u, v = part_links(np.cumsum(~same), rows["fp"].values.view(np.uint64), budget)
            return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)}).drop_duplicates()

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= ROWS:
                rows = pd.concat(held, ignore_index=True)
                values = rows[key].values
                tail = (values == values[-1]).all(axis=1)
                whole = len(rows) - int(tail.sum())  # the last part may go on
                if whole:
                    yield flush(rows[:whole])
                held, size = [rows[whole:].reset_index(drop=True)], len(rows) - whole
        if size:
            yield flush(pd.concat(held, ignore_index=True))

    return sorted_.mapInPandas(run, "u bigint, v bigint")


def components(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """doc_id, fp and component_id, the smallest id among the copies of each row."""
    prints = checkpointed(fingerprints(docs, shingle))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tied = roots(links(distinct.select("fp"), budget))
    named = distinct.join(tied, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    met = named.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(met, "fp").select("doc_id", "fp", "component_id")


def near_nodes(docs: DataFrame, shingle: int = likeness.SHINGLE, budget: int = BUDGET) -> DataFrame:
    """u, v: links that connect the nodes of `likeness`, by their short names, whose fingerprints the trie's join links."""

    def make():
        return lambda _, texts: [[fingerprint(t, shingle) for t in texts]]

    named = pick(docs, "doc_id", "text").selectExpr(f"{likeness.NODE} AS node", "text")
    named = named.selectExpr(f"{likeness.SHORT} AS short", "text")
    n = docs.count()
    prints = map_rows(named, ["short", "text"], make, "fp bigint").select("short", "fp").distinct()
    prints = checkpointed(prints, files_for(n))
    tied = roots(links(prints.select("fp").distinct(), budget), n * len(block_masks(n, budget)))
    own = prints.join(tied, F.col("fp") == F.col("node"), "left").select("short", F.coalesce("root", "fp").alias("part"))
    first = own.groupBy("part").agg(F.min("short").alias("v"))
    return own.join(first, "part").where("short <> v").select(F.col("short").alias("u"), "v")


def drop_copies(docs: DataFrame, shingle: int = likeness.SHINGLE, least: tuple[int, int] = likeness.LEAST) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id; a null id comes last.

    A row is known by its id and its text, so that different texts without an id, or with one that repeats,
    are each judged by their own group. Copies are found by the self-join of their fingerprints' trie and by the prefix
    join of `likeness`, and linked by the exact Jaccard similarity of their shingles, `least` as a fraction.
    """
    ids, tied = likeness.copies(docs, shingle, least, near_nodes(docs, shingle))
    named = ids.join(tied, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    kept = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("kept"))
    key, node, same, row = (fresh(docs.columns, n) for n in ("kept_id", "node", "kept_node", "row"))
    kept = kept.select(F.col("kept.doc_id").alias(key), F.col("kept.node").alias(same))
    keyed = docs.withColumn(node, F.expr(likeness.NODE))
    own = keyed.join(kept, (F.col(node) == F.col(same)) & F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")
    if not ids.groupBy("doc_id", "node").count().where(F.col("count") > 1).head(1):
        return own.select(*[F.col(f"`{c}`") for c in docs.columns])  # no row repeats
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = own.groupBy(node).agg(F.min_by(whole, F.to_json(whole)).alias(row))  # the same one in every run
    return one.select(*[F.col(f"`{row}`.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = components(table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", text, "component_id")
