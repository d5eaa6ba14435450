"""Operator 6: exact top-k search by inner product in M-trees.

Vectors are turned into integers. An inner product is largest where the distance is smallest once
each vector x gets one more component, sqrt(M - |x|^2) with M the largest squared length, and each
query a zero there; that distance is a metric, and an M-tree indexes it.

The vectors are dealt into pages of a partition by their nearest pivot, the pivots being a bounded,
documented sample that follows from the ids; a pivot with more vectors than a tree should hold
(eight times the root of their number, 1,024 at least) is dealt into several trees by hash. Each partition builds its own M-tree in one task: leaf pages of `PAGE` vectors,
each with a routing vector and a covering radius, under inner pages of `PAGE` nodes, which store the
distance to their parent's routing vector. A query first searches the tree whose middle is nearest. Its k-th score
there is a bound, and it then goes to the other trees whose covering radius lets them hold something as good; the middles and
radii of all trees are few, as trees grow with the root of the number of vectors. A tree is searched
best first: a queue holds nodes by the least distance at which they can hold anything, a node
is expanded while that is below the query's k-th distance, and the stored distances to the
parent rule out children through the triangle inequality before their own distance is computed. The
distances only decide what is visited, with a slack for rounding; scores are exact integers.
Each partition gives its k best for each query, and a ranking per query merges them.

Defined cases: vectors that are null or hold nulls or values that are not finite take no part; a
vector that is shorter than the longest counts as filled up with zeros, an empty one too; a query with
fewer candidates than k gives all; ties go to the smaller vec_id; repeated rows are candidates of
their own, but one query (with the smallest vector of that id), and a query never finds a row with
its own id; null ids take no part; an empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.llm.common import checkpointed, pick, table

K = 5
EVERY = 50
SCALE = 256.0
PAGE = 128
PIVOTS = 16
BLOCK = 1024
SEED = 17


def integers(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id and x, the components as integers, of the vectors that take part."""
    rows = pick(vectors, "vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    finite = "forall(embedding, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < CAST('Infinity' AS DOUBLE))"
    whole = f"transform(embedding, e -> CAST(floor({scale}D * CAST(e AS DOUBLE)) AS LONG)) AS x"
    rows = rows.where(finite).selectExpr("vec_id", whole)
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 1
    return rows.selectExpr("vec_id", f"concat(x, array_repeat(0L, {longest} - size(x))) AS x")


class Tree:
    """An M-tree over the rows of an array, built level by level from the leaves."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        self.ids, self.x = ids, x
        own = x.astype(np.float64)
        lift = np.sqrt(np.maximum(top - (own * own).sum(axis=1), 0.0))
        self.points = np.hstack([own, lift[:, None]])
        order = self.cluster(self.points, np.arange(len(ids)))
        self.ids, self.x, self.points = ids[order], x[order], self.points[order]
        # levels: routing points, radii, first and last child, distance to the parent's routing point
        self.levels = []
        points, radii = self.points, np.zeros(len(ids))
        self.squares = [(self.points**2).sum(axis=1)]
        while True:
            firsts = np.arange(0, len(points), PAGE)
            lasts = np.minimum(firsts + PAGE, len(points))
            route, radius, near = [], [], np.zeros(len(points))
            for a, b in zip(firsts, lasts):
                page = points[a:b]
                middle = page[np.argmin(((page - page.mean(axis=0)) ** 2).sum(axis=1))]
                d = np.sqrt(((page - middle) ** 2).sum(axis=1))
                near[a:b] = d
                route.append(middle)
                radius.append((d + radii[a:b]).max())
            self.levels.append((points, radii, near))
            points, radii = np.array(route), np.array(radius)
            self.squares.append((points**2).sum(axis=1))
            if len(points) == 1:
                break
        self.root = (points[0], float(radii[0]))

    def cluster(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """An order in which neighbours stand together: halves by the farther of two distant points."""
        out, stack = [], [rows]
        while stack:
            own = stack.pop()
            if len(own) <= PAGE:
                out.append(own)
                continue
            p = points[own]
            a = p[np.argmax(((p - p[0]) ** 2).sum(axis=1))]
            b = p[np.argmax(((p - a) ** 2).sum(axis=1))]
            side = ((p - a) ** 2).sum(axis=1) - ((p - b) ** 2).sum(axis=1)
            half = max(PAGE, (len(own) // 2 + PAGE - 1) // PAGE * PAGE)
            order = np.argsort(side, kind="stable")
            stack += [own[order[half:]], own[order[:half]]]
        return np.concatenate(out)

    def search(self, query_id: int, q: np.ndarray, k: int, floor: int | None = None) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, vec_id), of those that reach a score of `floor`, and the number of distances computed."""
        lifted = np.append(q.astype(np.float64), 0.0)
        square = float((lifted * lifted).sum())
        slack = 1e-5 * (1.0 + math.sqrt(square) + self.root[1])
        far = float(np.sqrt(((lifted - self.root[0]) ** 2).sum()))
        queue = [(max(0.0, far - self.root[1]), 0, len(self.levels) - 1, 0, far)]
        best: list[tuple[int, int]] = []  # a heap of (score, -vec_id), the worst on top
        reach, steps, made = np.inf, 0, 1
        if floor is not None:
            reach = math.sqrt(max(0.0, square + float(self.squares[0][0]) - 2.0 * floor))
        while queue:
            least, _, level, node, own = heapq.heappop(queue)
            if least > reach + slack:
                break
            points, radii, near = self.levels[level]
            a, b = node * PAGE, min(node * PAGE + PAGE, len(points))
            # by the triangle inequality, without a distance of their own
            maybe = a + np.flatnonzero(np.abs(own - near[a:b]) - radii[a:b] <= reach + slack)
            d = np.sqrt(np.maximum(self.squares[level][maybe] + square - 2.0 * (points[maybe] @ lifted), 0.0))
            made += len(maybe)
            if level:
                for child, far in zip(maybe.tolist(), d.tolist()):
                    bound = max(0.0, far - float(radii[child]))
                    if bound <= reach + slack:
                        steps += 1
                        heapq.heappush(queue, (bound, steps, level - 1, child, far))
                continue
            rows = maybe[d <= reach + slack]
            scores = self.x[rows] @ q
            for row, score in zip(rows.tolist(), scores.tolist()):
                other = int(self.ids[row])
                if other == query_id:
                    continue
                entry = (score, -other)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                # the distance at which the k-th score stands; equal scores stay within reach
                reach = math.sqrt(max(0.0, square + float(self.squares[0][0]) - 2.0 * best[0][0]))
        return [(s, -i) for s, i in best], made


def nearest_pivot(rows: DataFrame, pivots: list[list[int]]) -> DataFrame:
    """Adds `cell`, the pivot with the largest cosine."""
    import pandas as pd

    p = np.array(pivots, np.float64)
    p /= np.maximum(np.sqrt((p * p).sum(axis=1, keepdims=True)), 1e-9)

    def run(batches):
        for batch in batches:
            x = np.array(batch["x"].tolist(), np.float64)
            cell = (x @ p.T).argmax(axis=1) if len(batch) else []
            yield pd.DataFrame({"vec_id": batch["vec_id"], "x": batch["x"], "cell": cell})

    return rows.mapInPandas(run, "vec_id bigint, x array<bigint>, cell int")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: float = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with an id divisible by `every` its k best others."""
    spark = vectors.sparkSession
    rows = integers(vectors, scale)
    pivots = rows.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(PIVOTS).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not pivots:
        return spark.createDataFrame([], schema)
    length = "aggregate(x, 0L, (s, e) -> s + e * e)"
    top = rows.agg(F.max(F.expr(length))).first()[0]
    placed = nearest_pivot(rows, [r.x for r in pivots])
    counts = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}
    most = max(1024, 8 * math.isqrt(sum(counts.values())))
    cells = {cell: -(-count // most) for cell, count in counts.items()}
    base, n = {}, 0
    for cell in sorted(cells):
        base[cell], n = n, n + cells[cell]
    lookup = F.create_map(*[F.lit(v) for c in base for v in (c, base[c])])
    parts = F.create_map(*[F.lit(v) for c in cells for v in (c, cells[c])])
    salt = F.pmod(F.xxhash64("vec_id"), parts[F.col("cell")].cast("long"))
    indexed = checkpointed(placed.select((lookup[F.col("cell")] + salt).cast("int").alias("tree"), "vec_id", "x"))
    balls = indexed.groupBy("tree").applyInPandas(lambda own: ball(own, float(top)), BALL).orderBy("tree").collect()
    sent = spark.sparkContext.broadcast([(r.tree, r.middle, r.radius) for r in balls])  # root of the rows / 8 at most

    asked = checkpointed(rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("x").alias("x")))
    asked = asked.withColumn("floor", F.lit(NONE))
    first = checkpointed(searched(indexed, routed(asked, sent, float(top), home=True), k, float(top)))
    floors = first.groupBy(F.col("query_id").alias("q")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    told = asked.join(floors, F.col("vec_id") == F.col("q"), "left").select(
        "vec_id", "x", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(NONE)).alias("floor")
    )
    more = searched(indexed, routed(told, sent, float(top), home=False), k, float(top))
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(more).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


BALL = "tree int, middle array<double>, radius double"
NONE = -(2**62)


def ball(own, top: float):
    """The middle of a tree's vectors, as points of the metric, and how far the farthest is from it."""
    import pandas as pd

    x = np.array(own["x"].tolist(), np.float64)
    points = np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0.0))[:, None]])
    middle = points.mean(axis=0)
    radius = float(np.sqrt(((points - middle) ** 2).sum(axis=1).max()))
    return pd.DataFrame({"tree": [own["tree"].iloc[0]], "middle": [middle.tolist()], "radius": [radius]})


def routed(asked: DataFrame, balls, top: float, home: bool) -> DataFrame:
    """tree, vec_id, x, floor: each query with the tree of the nearest middle, or with the others that can hold as good a score."""
    import pandas as pd

    def run(batches):
        trees = np.array([t for t, _, _ in balls.value], np.int32)
        middles = np.array([m for _, m, _ in balls.value])
        radii = np.array([r for _, _, r in balls.value])
        squares = (middles**2).sum(axis=1)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                own = batch.iloc[at : at + BLOCK].reset_index(drop=True)
                q = np.array(own["x"].tolist(), np.float64)
                q = np.hstack([q, np.zeros((len(q), 1))])
                square = (q * q).sum(axis=1)
                far = np.sqrt(np.maximum(squares[None, :] + square[:, None] - 2.0 * (q @ middles.T), 0.0))
                nearest = far.argmin(axis=1)
                if home:
                    row, column = np.arange(len(q)), nearest
                else:
                    floor = own["floor"].to_numpy()
                    reach = np.sqrt(np.maximum(square + top - 2.0 * floor, 0.0))
                    slack = 1e-5 * (1.0 + np.sqrt(square)[:, None] + radii[None, :])
                    maybe = (far - radii[None, :] <= reach[:, None] + slack) | (floor == NONE)[:, None]
                    maybe[np.arange(len(q)), nearest] = False
                    row, column = np.nonzero(maybe)
                out = own.iloc[row].reset_index(drop=True)
                yield pd.DataFrame({"tree": trees[column], "vec_id": out["vec_id"], "x": out["x"], "floor": out["floor"]})

    return asked.select("vec_id", "x", "floor").mapInPandas(run, "tree int, vec_id bigint, x array<bigint>, floor bigint")


def searched(indexed: DataFrame, asked: DataFrame, k: int, top: float) -> DataFrame:
    """query_id, vec_id, score: the k best that each query finds in the trees that it goes to."""
    import pandas as pd

    # the tree's vectors come first, then its queries
    own = indexed.select("tree", F.lit(0).alias("asks"), "vec_id", "x", F.lit(NONE).alias("floor"))
    met = own.unionByName(asked.select("tree", F.lit(1).alias("asks"), "vec_id", "x", "floor"))
    met = met.repartition("tree").sortWithinPartitions("tree", "asks", "vec_id")

    def run(batches):
        state = {"tree": None, "ids": [], "x": [], "index": None}
        for batch in batches:
            out = []
            for tree, asks, vec_id, x, floor in zip(*[batch[c] for c in ("tree", "asks", "vec_id", "x", "floor")]):
                if tree != state["tree"]:
                    state = {"tree": tree, "ids": [], "x": [], "index": None}
                if not asks:
                    state["ids"].append(vec_id)
                    state["x"].append(x)
                    continue
                if state["index"] is None:
                    state["index"] = Tree(np.array(state["ids"], np.int64), np.array(state["x"], np.int64), top)
                    state["ids"] = state["x"] = []
                found, _ = state["index"].search(int(vec_id), np.array(x, np.int64), k, None if floor == NONE else int(floor))
                out += [(vec_id, other, score) for score, other in found]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    return met.mapInPandas(run, "query_id bigint, vec_id bigint, score bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best others of every fiftieth vector, among all."""
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
