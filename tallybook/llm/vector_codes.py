"""Operator 12: vector code compression, a product quantiser whose entries are found by Orchard search.

Components become integers, vectors are cut into `PARTS` equal parts, and each part position has a
codebook of `ENTRIES` entries at most, which starts as that part of the vectors with the smallest ids. A round
assigns every part to its nearest entry (squared distance, ties to the lower index) and moves each entry
to the floored mean of its parts; an entry without parts stays.

Orchard search finds the nearest entry. Every entry keeps the list of all others by distance from itself.
A part starts at the best of a few entries and walks the list of the entry it is at. An entry not marked
yet is marked and measured; if it is nearer (or as near with a lower index), the part jumps to the start of that
entry's list. By the triangle inequality nothing beyond twice the current distance can be as near, so there
the walk stops. Distances are squared integers, so "beyond" is an exact test, and the result is that of
an exhaustive search. Many parts walk at once, a window of their lists a step, so that the work is numpy's.

Spark holds the vectors: a round is one pass in which each task adds up its own parts, at most
PARTS x ENTRIES partial sums a task, and one aggregation over those. The driver sees the codebooks only, whose
size is ENTRIES vectors whatever the number of rows; they go to the tasks as a broadcast.

Defined cases: vectors that are null or hold a null or a value that is not finite are dropped; a null id comes
last; repeated rows are vectors of their own; vectors shorter than the longest, or whose length is no multiple of
PARTS, are filled up with zeros; integers beyond 2^26 in size (components beyond 65,536) are held at
that bound, which keeps all distances exact; with fewer vectors than ENTRIES the codebooks have fewer entries;
an empty table gives an empty one; of the columns only vec_id, embedding and label are used.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import checkpointed, map_batches, pick, table

SCALE = 1024.0
PARTS = 4
ENTRIES = 256
ROUNDS = 4
MOST = 2**26
#: Entries that a part measures before it walks, and entries of a list in a step.
FIRST = 8
WINDOW = 16


def integers(vectors: DataFrame, scale: float = SCALE, most: int = MOST) -> DataFrame:
    """vec_id, label and x, the components as integers, of the vectors that take part."""
    rows = pick(vectors, "vec_id", "label", "embedding").where("embedding IS NOT NULL")
    finite = "forall(embedding, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < CAST('Infinity' AS DOUBLE))"
    held = f"greatest(least(floor({scale}D * least(greatest(CAST(e AS DOUBLE), -1e12D), 1e12D)), {most}L), -{most}L)"
    return rows.where(finite).selectExpr("vec_id", "label", f"transform(embedding, e -> CAST({held} AS INT)) AS x")


def parts_of(x: list, width: int) -> np.ndarray:
    """(PARTS, rows, width / PARTS) of lists of components, filled up with zeros."""
    sizes = np.fromiter(map(len, x), np.int64, len(x))
    out = np.zeros((len(x), width), np.int64)
    if len(x):
        flat = np.fromiter((e for own in x for e in own), np.int64, int(sizes.sum()))
        out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out.reshape(len(x), PARTS, width // PARTS).transpose(1, 0, 2)


class Orchard:
    """The entries of one codebook and their lists of neighbours."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.ascontiguousarray(entries, np.int64)
        n = len(entries)
        gaps = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(gaps, axis=1, kind="stable")
        pad = WINDOW  # a list ends in entries that are beyond any distance
        self.lists = np.hstack([order, np.zeros((n, pad), np.int64)])
        self.gaps = np.hstack([np.take_along_axis(gaps, order, 1), np.full((n, pad), np.iinfo(np.int64).max)])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each point the nearest entry and its squared distance; and the number of distances measured."""
        n, k = len(points), len(self.entries)
        first = np.linspace(0, k - 1, min(FIRST, k)).astype(np.int64)
        tried = ((points[:, None, :] - self.entries[None, first, :]) ** 2).sum(axis=2)
        own = tried.argmin(axis=1)  # the first of equals, and so the lowest index
        best, at = tried[np.arange(n), own], first[own]
        marked = np.zeros((n, k), bool)
        marked[:, first] = True
        made = n * len(first)
        place, walking = np.zeros(n, np.int64), np.arange(n)
        step = np.arange(WINDOW)
        far = np.iinfo(np.int64).max
        while len(walking):
            rows, columns = at[walking][:, None], place[walking][:, None] + step
            near = self.gaps[rows, columns] <= 4 * best[walking][:, None]
            entry = self.lists[rows, columns]
            r, c = np.nonzero(near & ~marked[walking[:, None], entry])
            found = entry[r, c]
            marked[walking[r], found] = True
            apart = points[walking[r]] - self.entries[found]
            made += len(r)
            distance = np.full(near.shape, far)
            distance[r, c] = np.einsum("ij,ij->i", apart, apart)
            least = distance.min(axis=1)
            index = np.where(distance == least[:, None], entry, k).min(axis=1)
            better = (least < best[walking]) | ((least == best[walking]) & (index < at[walking]))
            jump = walking[better]
            best[jump], at[jump] = least[better], index[better]
            place[walking] += WINDOW
            place[jump] = 0
            walking = walking[better | (near[:, -1] & (place[walking] < k))]
        return at, best, made


def first_codebooks(rows: DataFrame, entries: int, width: int) -> np.ndarray:
    """(PARTS, entries, width / PARTS) from the vectors with the smallest ids; ties by their components."""
    chosen = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    return parts_of([r.x for r in chosen], width)


def partial_sums(rows: DataFrame, codebooks: np.ndarray, width: int) -> DataFrame:
    """entry (its number over all positions), axis, total and n: a task's own sums, made before any shuffle."""
    import pyarrow as pa

    sent = rows.sparkSession.sparkContext.broadcast(codebooks)  # ENTRIES vectors

    def run(batches):
        books = sent.value
        searches = [Orchard(b) for b in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for part, points in enumerate(parts_of(batch.column(0).to_pylist(), width)):
                at, _, _ = searches[part].nearest(points)
                np.add.at(sums[part], at, points)
                counts[part] += np.bincount(at, minlength=len(books[part]))
        used = np.argwhere(counts.reshape(-1))[:, 0]
        axes = books.shape[2]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, axes)),
                pa.array(np.tile(np.arange(axes), len(used))),
                pa.array(sums.reshape(-1, axes)[used].reshape(-1)),
                pa.array(np.repeat(counts.reshape(-1)[used], axes)),
            ],
            names=["entry", "axis", "total", "n"],
        )

    return rows.select("x").mapInArrow(run, "entry bigint, axis bigint, total bigint, n bigint")


def moved(rows: DataFrame, codebooks: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after one round."""
    sums = partial_sums(rows, codebooks, width).groupBy("entry", "axis")
    out = codebooks.copy()
    flat = out.reshape(-1, codebooks.shape[2])
    exact = sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    for r in exact.collect():  # at most one row for each component of a codebook
        flat[r.entry, r.axis] = int(r.total) // r.n
    return out


def fit(rows: DataFrame, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after all rounds."""
    codebooks = first_codebooks(rows, entries, width)
    for _ in range(rounds if codebooks.shape[1] else 0):
        codebooks = moved(rows, codebooks, width)
    return codebooks


def encode(rows: DataFrame, codebooks: np.ndarray, width: int) -> DataFrame:
    """vec_id, label, codes (an index for each part) and error, the squared distance to what they stand for."""
    sent = rows.sparkSession.sparkContext.broadcast(codebooks)

    def make():
        searches = [Orchard(b) for b in sent.value]

        def work(x):
            found = [s.nearest(p)[:2] for s, p in zip(searches, parts_of(x, width))]
            codes = np.stack([at for at, _ in found], axis=1)
            return [codes.astype(np.int32).tolist(), np.sum([d for _, d in found], axis=0).tolist()]

        return work

    return map_batches(rows, ["x"], ["vec_id", "label"], make, "codes array<int>, error bigint")


def decode(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id and x, the components that the codes stand for."""
    sent = codes.sparkSession.sparkContext.broadcast(codebooks)

    def make():
        books = sent.value
        return lambda own: [[[int(e) for b, i in zip(books, c) for e in b[i]] for c in own]]

    return map_batches(codes, ["codes"], ["vec_id"], make, "x array<bigint>")


def codebook_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components, in the order of parts, entries and places."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The codes of every vector that takes part, and the codebooks."""
    rows = integers(vectors)
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    width = max(1, -(-longest // PARTS)) * PARTS
    codebooks = fit(rows, width, entries, rounds)
    return encode(rows, codebooks, width), codebooks


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error, with the errors of its label."""
    codes, codebooks = compress(table(spark, sf_dir, "embeddings"))
    named = checkpointed(
        codes.select(
            "vec_id",
            "label",
            F.expr("lower(array_join(transform(codes, c -> lpad(hex(c), 2, '0')), ''))").alias("code"),
            "error",
        )
    )
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = named.groupBy("label").agg(total.try_cast("bigint").alias("label_error"))
    met = named.join(sums.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(codebooks)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds as one chain of tables, by exhaustive search; for vectors of one length."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row,
         list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), p AS MATERIALIZED (
  SELECT row, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS y
  FROM v, range({parts}) t(part)
), b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, y AS c FROM p WHERE row <= {entries})"""
    ]
    far = "CAST(list_sum(list_transform(list_zip(p.y, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT row, part, y, m.e AS entry, m.d AS d
  FROM (SELECT p.row, p.part, any_value(p.y) AS y, min({{'d': {far}, 'e': b.entry}}) AS m
        FROM p JOIN b{i} b ON p.part = b.part GROUP BY p.row, p.part)
)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (
  SELECT part, entry, place, sum(e) AS total, count(*) AS n
  FROM (SELECT part, entry, unnest(y) AS e, unnest(range(len(y))) AS place FROM a{i}) GROUP BY part, entry, place
), b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
  FROM b{i} b LEFT JOIN (
    SELECT part, entry,
           list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c
    FROM s{i} GROUP BY part, entry
  ) m ON b.part = m.part AND b.entry = m.entry
)"""
            )
    digest = (
        "SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256"
        f" FROM b{rounds}"
    )
    return f"""
WITH {", ".join(steps)}, r AS (
  SELECT row, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY row
)
SELECT v.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
       (SELECT codebooks_sha256 FROM ({digest})) AS codebooks_sha256
FROM v JOIN r USING (row)
"""


ORACLE_SQL = oracle_sql()
