"""Operator 10: mixing sources to target weights by a hypergeometric splitting tree.

1. One aggregation gives the words of each source; targets follow from the weights, no target
   above `cap` times its source, the excess reshared by weight (a water level over the sources).
2. A source is a fixed number of blocks, dealt by a hash of the document's id, and the blocks have
   a random order. A source gives each block floor(target / words) times, and the first blocks of
   its order once more, until the target is met. The block that the target cuts is cut
   the same way into smaller blocks, and the last of these by document, so that a source ends
   within half a document of its target and no step ranks all documents of a source.
3. Each source's quota of block draws is split among the output shards by a tree: a node deals
   its blocks to its left half by a multivariate hypergeometric draw, one source after another.
   The leaves give every shard an exact number of draws of each source, that is a range of the
   source's draws, so shards are disjoint.
4. A shard is shuffled locally, by a hash of document and copy.

All draws are hashes of a seed, so reruns agree. Only one row per source is planned with; that row
holds arrays of fixed length, and documents meet it in a join that Spark broadcasts while it is
small and splits where a source is hot.

Defined cases: a null text has 0 words; a null source is a source of its own, the last one; a
source without words has target 0 and is not taken; repeated rows with one id are taken alike; ties of draws are
broken by id; a long text counts like any other, its words being counted once to plan; an empty table gives an empty one;
extra columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.llm.common import WORD, fresh, pick, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCKS = 64
SHARDS = 64
SEED = 20240607
ADDED = ("size", "source_size", "target", "taken", "draws")

SIZE = "CAST(coalesce(regexp_count(text, '{}'), 0) AS LONG)".format(WORD.replace("\\", "\\\\"))


def key(seed: int, level: int) -> str:
    """A hash that orders the documents of a source anew at each level."""
    return f"xxhash64({seed + level}, doc_id)"


def targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """source, source_size, target: a row for each source of a table of (source, source_size)."""
    menu = ", ".join(str(w) for w in weights)
    ranked = sizes.withColumn("nth", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))))
    weighed = ranked.selectExpr(
        "*",
        f"CAST(element_at(array({menu}), CAST((nth - 1) % {len(weights)} + 1 AS INT)) AS LONG) AS weight",
        f"{cap}D * source_size AS most",
    )
    order = W.orderBy(F.expr("most / weight"), "nth")
    every = W.partitionBy()
    level = weighed.select(
        "*",
        F.coalesce(F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)).alias("open"),
        F.sum("source_size").over(every).alias("all_size"),
    ).withColumn("level", F.expr(f"({share}D * all_size - {cap}D * below) / open"))
    first_open = F.expr("min_by(level, if(level < most / weight, struct(most / weight, nth), NULL))")
    water = level.select("*", first_open.over(every).alias("water"))
    return water.selectExpr(
        "source", "nth", "source_size", "least(most, coalesce(weight * water, most)) AS target"
    )


def ordered_blocks(blocks: DataFrame, seed: int) -> DataFrame:
    """The blocks of each source in random order: place from 0, and words before and through it."""
    by = W.partitionBy("nth").orderBy(F.expr(f"xxhash64({seed}, nth, block)"), "block")
    through = F.sum("words").over(by.rowsBetween(W.unboundedPreceding, 0))
    return blocks.select("*", (F.row_number().over(by) - 1).alias("place"), through.alias("through"))


def fitted(placed: DataFrame, quota: DataFrame, n: int, name: str) -> DataFrame:
    """A row per source: the place of each block, how many fit the quota whole, and what is left."""
    joined = placed.join(quota, "nth")
    whole = F.col("through") <= F.col("quota")
    places = F.map_from_arrays(F.collect_list("block"), F.collect_list("place"))
    return (
        joined.groupBy("nth", "quota")
        .agg(
            places.alias("at"),
            F.count(F.when(whole, 1)).cast("int").alias(f"{name}_whole"),
            F.coalesce(F.max(F.when(whole, F.col("through"))), F.lit(0)).alias("used"),
        )
        .selectExpr(
            "nth",
            f"transform(sequence(0, {n - 1}), b -> coalesce(element_at(at, b), {n})) AS {name}_at",
            f"{name}_whole",
            "quota - used AS quota",
        )
    )


def hypergeometric(total: str, good: str, drawn: str, u: str) -> str:
    """SQL for the number of good ones among `drawn` of `total`, by its distribution function at u."""
    low = f"greatest(0L, {drawn} - ({total} - {good}))"
    high = f"least({drawn}, {good})"
    step = (
        f"s.w + ln(({good} - k) * CAST({drawn} - k AS DOUBLE))"
        f" - ln((k + 1) * CAST({total} - {good} - {drawn} + k + 1 AS DOUBLE))"
    )
    walk = f"if({high} > {low}, sequence({low}, {high} - 1), array())"
    peak = (
        f"aggregate({walk}, named_struct('w', 0D, 'm', 0D),"
        f" (s, k) -> named_struct('w', {step}, 'm', greatest(s.m, {step})), s -> s.m)"
    )
    mass = (
        f"aggregate({walk}, named_struct('w', 0D, 'c', exp(-t.peak)),"
        f" (s, k) -> named_struct('w', {step}, 'c', s.c + exp({step} - t.peak)), s -> s.c)"
    )
    walked = (
        f"aggregate({walk}, named_struct('w', 0D, 'c', exp(-m.peak), 'n', {low}),"
        f" (s, k) -> named_struct('w', {step}, 'c', s.c + exp({step} - m.peak),"
        f" 'n', if(s.c < {u} * m.mass, k + 1, s.n)), s -> s.n)"
    )
    with_mass = f"transform(array(named_struct('peak', {peak})), t -> named_struct('peak', t.peak, 'mass', {mass}))"
    return f"element_at(transform({with_mass}, m -> {walked}), 1)"


def shard_cuts(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """nth, cuts: the draws of a source that the shards before each shard get.

    `quotas` has (nth, draws). The tree is a table of nodes, each with its range of shards and an
    array of (nth, draws); a level is one projection.
    """
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("nth", F.col("draws").cast("long").alias("n")))).alias("has"))
    slots = "aggregate(has, 0L, (a, x) -> a + x.n)"
    nodes = nodes.selectExpr("0L AS lo", f"{shards}L AS hi", "has", f"{slots} AS all")
    u = f"(shiftrightunsigned(xxhash64({seed}, lo, hi, x.nth), 11) / 9007199254740992D)"
    draw = hypergeometric("a.total", "x.n", "a.room", u)
    left = (
        "aggregate(has, named_struct('total', total, 'room', room,"
        " 'out', CAST(array() AS ARRAY<STRUCT<nth: INT, n: BIGINT>>)),"
        " (a, x) -> element_at(transform(array(" + draw + "), d -> named_struct('total', a.total - x.n,"
        " 'room', a.room - d, 'out', concat(a.out, array(named_struct('nth', x.nth, 'n', d))))), 1),"
        " a -> a.out)"
    )
    for _ in range(max(1, shards - 1).bit_length()):
        split = nodes.selectExpr("*", "(lo + hi) DIV 2 AS mid", f"{slots} AS total").selectExpr(
            "*", f"mid * all DIV {shards} - lo * all DIV {shards} AS room"
        )
        split = split.selectExpr("lo", "mid", "hi", "all", "has", f"if(mid > lo, {left}, has) AS won")
        lost = "zip_with(has, won, (h, w) -> named_struct('nth', h.nth, 'n', h.n - w.n))"
        halves = (
            "inline(if(mid > lo, array(named_struct('lo', lo, 'hi', mid, 'has', won, 'all', all),"
            f" named_struct('lo', mid, 'hi', hi, 'has', {lost}, 'all', all)),"
            " array(named_struct('lo', lo, 'hi', hi, 'has', has, 'all', all))))"
        )
        nodes = split.selectExpr(halves)
    leaves = nodes.selectExpr("lo", "inline(has)")
    rows = leaves.groupBy("nth").agg(F.sort_array(F.collect_list(F.struct("lo", "n"))).alias("got"))
    return rows.selectExpr("nth", "transform(got, (g, i) -> aggregate(slice(got, 1, i), 0L, (a, x) -> a + x.n)) AS cuts")


def plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, shards=SHARDS, seed=SEED) -> DataFrame:
    """One row per source: its target, and which of its blocks are drawn how often and for whom."""
    sized = pick(docs, "doc_id", "text", "source").selectExpr("doc_id", "source", f"{SIZE} AS size")
    keyed = sized.selectExpr("doc_id", "source", "size", f"CAST(pmod({key(seed, 0)}, {BLOCKS}) AS INT) AS block")
    blocks = keyed.groupBy("source", "block").agg(F.sum("size").alias("words"))
    goals = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    goals = goals.selectExpr(
        "source AS goal_source",
        "nth",
        "source_size",
        "target",
        "CAST(if(source_size = 0, 0, floor(target / source_size)) AS INT) AS rounds",
    ).selectExpr("*", "target - rounds * source_size AS quota")
    same = F.expr("source <=> goal_source")

    placed = ordered_blocks(blocks.join(goals.select("goal_source", "nth"), same), seed)
    first = fitted(placed, goals.select("nth", "quota"), BLOCKS, "block")

    cut = first.join(goals.select("nth", "goal_source"), "nth").selectExpr(
        "nth", "goal_source", "quota", f"array_position(block_at, block_whole) - 1 AS cut_block"
    )
    inner = keyed.join(cut, same & F.expr("block = cut_block")).selectExpr(
        "nth", "doc_id", "size", f"CAST(pmod({key(seed, 1)}, {BLOCKS}) AS INT) AS block"
    )
    parts = inner.groupBy("nth", "block").agg(F.sum("size").alias("words"))
    second = fitted(ordered_blocks(parts, seed + 1), cut.select("nth", "quota"), BLOCKS, "part")

    last = second.selectExpr("nth", "quota", "array_position(part_at, part_whole) - 1 AS cut_part")
    tail = inner.join(last, "nth").where("block = cut_part").selectExpr("*", f"{key(seed, 2)} AS k")
    by = W.partitionBy("nth").orderBy("k", F.asc_nulls_first("doc_id"))
    near = tail.withColumn("through", F.sum("size").over(by.rangeBetween(W.unboundedPreceding, 0)))
    edge = near.where("through - size / 2 <= quota").groupBy("nth").agg(F.max("k").alias("last_key"))

    quotas = goals.join(first, "nth", "left").selectExpr(
        "nth", f"rounds * {BLOCKS} + coalesce(block_whole, 0) + if(target > rounds * source_size, 1, 0) AS draws"
    )
    cuts = shard_cuts(quotas, shards, seed)
    return (
        goals.drop("quota")
        .join(first.drop("quota"), "nth", "left")
        .join(second.drop("quota"), "nth", "left")
        .join(edge, "nth", "left")
        .join(cuts, "nth", "left")
    )


def allocate(docs: DataFrame, **options) -> DataFrame:
    """The documents with size, source_size, target, taken, and `draws`: an array of (copy, shard)."""
    seed = options.get("seed", SEED)
    names = [n for n in docs.columns if n.lower() not in ADDED]
    plans = plan(docs, **options)
    row = fresh([*names, *ADDED], "plan")
    one = plans.select(F.struct(*plans.columns).alias(row))
    met = docs.select(*[F.col(f"`{n}`") for n in names], F.expr(SIZE).alias("size")).join(
        one, F.expr(f"source <=> `{row}`.goal_source")
    )
    place = f"element_at(`{row}`.block_at, CAST(pmod({key(seed, 0)}, {BLOCKS}) AS INT) + 1)"
    part = f"element_at(`{row}`.part_at, CAST(pmod({key(seed, 1)}, {BLOCKS}) AS INT) + 1)"
    more = (
        f"CASE WHEN `{row}`.block_at IS NULL THEN 0 WHEN {place} < `{row}`.block_whole THEN 1"
        f" WHEN {place} > `{row}`.block_whole OR `{row}`.part_at IS NULL THEN 0"
        f" WHEN {part} < `{row}`.part_whole THEN 1 WHEN {part} > `{row}`.part_whole THEN 0"
        f" WHEN {key(seed, 2)} <= `{row}`.last_key THEN 1 ELSE 0 END"
    )
    copies = f"(`{row}`.rounds + {more})"
    shard = f"size(filter(`{row}`.cuts, c -> c <= n * {BLOCKS} + {place})) - 1"
    draws = (
        f"if({copies} = 0, CAST(array() AS ARRAY<STRUCT<copy: INT, shard: INT>>),"
        f" transform(sequence(0, {copies} - 1), n -> named_struct('copy', n, 'shard', {shard})))"
    )
    drawn = met.withColumn("draws", F.expr(draws))
    return drawn.select(
        *[F.col(f"`{n}`") for n in names],
        "size",
        F.col(f"`{row}`.source_size").alias("source_size"),
        F.col(f"`{row}`.target").alias("target"),
        (F.col("size") * F.size("draws")).alias("taken"),
        "draws",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as drawn, in shards that are shuffled locally."""
    names = docs.columns
    shards, seed = options.get("shards", SHARDS), options.get("seed", SEED)
    held, taken = [], [*names, *ADDED]  # columns of the documents that `allocate` has too go by other names
    for n in names:
        held.append(fresh(taken, f"own_{n}") if n.lower() in ADDED else n)
        taken.append(held[-1])
    dealt, order = fresh(taken, "dealt"), fresh(taken, "order_key")
    rows = allocate(docs.toDF(*held), **options).select(*[F.col(f"`{n}`") for n in held], F.explode("draws").alias(dealt))
    rows = rows.withColumn(order, F.expr(f"xxhash64({seed}, doc_id, `{dealt}`.copy)"))
    spread = rows.repartition(shards, F.col(f"`{dealt}`.shard"))
    shuffled = spread.sortWithinPartitions(f"`{dealt}`.shard", order)
    return shuffled.select(*[F.col(f"`{h}`").alias(n) for h, n in zip(held, names)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its size, its source's size and target, and the words the mix takes of it."""
    return allocate(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("draws.shard").alias("shards")
    )
