"""Operator 11: near-copies among vectors by randomised-rotation binary codes.

1. Codes. A vector of unit length is rotated at random (three rounds of sign flips and Hadamard transforms, seeded);
   the signs are its binary code, a corner of the cube. With it goes the correction factor <o, x>, o being the
   rotated corner. <o, q> / <o, x> is then an unbiased estimate of <x, q> for any unit q, off by more than
   EPSILON sqrt((1 - f^2) / f^2 / (D - 1)) hardly ever; several rotations are averaged.
2. Candidates. Vectors at an angle t agree in a sign with probability 1 - t / pi. Bands of b signs deal the
   codes of a label into buckets, b growing with the logarithm of the largest label so that buckets of unlike
   vectors stay small; there are so many bands that a pair at the threshold shares none once in 1 / MISS. Codes
   that meet are compared by their differing signs, with a bound of WIDE standard deviations. Only codes travel, not vectors, and a
   task gives a spanning forest of its candidates, never the pairs.
3. Groups. What candidates connect is a group; every link lies inside one. Each vector travels to its group once.
   There the estimates and their bounds decide which pairs need the exact cosine, computed in double precision from the
   original components; only that makes a link. A group of more than `most` vectors meets by bands again, each pair
   in the first band it shares. Tasks give counts of links and a spanning forest.
4. Components of the links.

Equal vectors of a label are one node with a count, so copies cost nothing and may be any share of the rows. A bucket or
group of more than `most` is compared slice by slice. A group of g vectors that are near to each other has g^2 links to
count; that work is done where they meet, and spread over slices.

Defined cases: vectors that are null, empty, zero, or hold a null or a value that is not finite link with nothing, nor do
vectors without a label; only vectors of one length are compared; rows that repeat are vectors of their own and link with
each other, as do rows that share an id; a null id is counted as a neighbour, but is no component's least id and never
kept; at the threshold exactly is a link; an empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.buckets import by_bucket, forest, pairs_by_offset, sliced
from tallybook.llm.common import checkpointed, pick, table
from tallybook.llm.components import roots

LEAST = 0.98
MISS = 1e-9
EPSILON = 6.0
WIDE = 7.0
CODE = 256
BUCKET = 32
MOST = 1024
ROUNDS = 3
SEED = 29
PAIRS = 65_536


def padded(size: int) -> int:
    """The length of a rotated vector: a power of two, 64 at least."""
    return max(64, 1 << (size - 1).bit_length())


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row."""
    n, d = x.shape
    h = 1
    while h < d:
        pair = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Rows turned by the rotation of that number."""
    d = padded(x.shape[1])
    out = np.zeros((len(x), d))
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng([SEED, number, d]).choice([-1.0, 1.0], size=(ROUNDS, d))
    for own in signs:
        out = hadamard(out * own)
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one; cosines don't change."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -exponent[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def code_bits(d: int) -> tuple[int, int]:
    """Bits of a stored code, and the rotations that they come from."""
    return max(CODE, d), max(1, CODE // d)


class Bands:
    """How many signs a band has, and how many bands there are, for so many vectors in the largest label."""

    def __init__(self, largest: int, least: float, miss: float = MISS):
        self.width = min(60, max(4, math.ceil(math.log2(max(1, largest) / BUCKET)) if largest else 4))
        self.agree = 1 - math.acos(min(1.0, max(-1.0, least))) / math.pi
        one = self.agree**self.width
        self.number = math.ceil(math.log(miss) / math.log1p(-one)) if one < 1 else 1

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of unit rows the bands' values, the packed code, and the correction factors of its rotations."""
        d = padded(x.shape[1])
        bits, used = code_bits(d)
        wanted = max(bits, self.width * self.number)
        signs, factors = [], []
        for number in range(-(-wanted // d)):
            turned = rotated(x, number)
            signs.append(turned >= 0)
            if number < used:
                factors.append(np.abs(turned).sum(axis=1) / math.sqrt(d))
        every = np.hstack(signs)
        banded = every[:, : self.width * self.number].reshape(len(x), self.number, self.width)
        values = banded @ (1 << np.arange(self.width, dtype=np.int64))
        return values, np.packbits(every[:, :bits], axis=1), np.stack(factors, axis=1)


def coded(nodes: DataFrame, bands: Bands) -> DataFrame:
    """The nodes with bands, code and factors."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            x = batch.column("x").to_pylist()
            sizes = np.fromiter(map(len, x), np.int64, len(x))
            values, codes, factors = [None] * len(x), [None] * len(x), [None] * len(x)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                made = bands.code(unit(np.array([x[i] for i in rows], np.float64)))
                for i, v, c, f in zip(rows.tolist(), *made):
                    values[i], codes[i], factors[i] = v, c.tobytes(), f.astype(np.float32)
            arrays = [*batch.columns, pa.array(values, pa.list_(pa.int64())), pa.array(codes, pa.binary())]
            arrays.append(pa.array(factors, pa.list_(pa.float32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "bands", "code", "factors"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.mapInArrow(run, f"{fields}, bands array<bigint>, code binary, factors array<float>")


def candidates(codes: DataFrame, least: float, most: int) -> DataFrame:
    """u, v: links that connect all vectors whose codes allow a cosine of `least` or more."""
    import pandas as pd

    differ = math.acos(least) / math.pi
    skinny = codes.selectExpr("node", "label", "size", "posexplode(bands) AS (band, value)", "code")
    key = ["label", "size", "band", "value"]

    def work(frame, starts, ends):
        code = np.frombuffer(b"".join(frame["code"]), np.uint64).reshape(len(frame), -1)
        bits = 64 * code.shape[1]
        limit = bits * differ + WIDE * math.sqrt(bits * differ * (1 - differ))
        first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, j in pairs_by_offset(starts, ends):
            for at in range(0, len(i), PAIRS):
                s, t = i[at : at + PAIRS], j[at : at + PAIRS]
                near = np.bitwise_count(code[s] ^ code[t]).sum(axis=1) <= limit
                first.append(s[near])
                second.append(t[near])
        u, v = forest(frame["node"].to_numpy(), np.concatenate(first), np.concatenate(second))
        return pd.DataFrame({"u": u, "v": v})

    def by_size(frame, starts, ends):  # codes of one length at a time
        sizes = frame["size"].to_numpy()[starts]
        out = []
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            rows = np.concatenate([np.arange(starts[g], ends[g]) for g in own])
            stop = np.cumsum(ends[own] - starts[own])
            out.append(work(frame.iloc[rows], stop - (ends[own] - starts[own]), stop))
        return pd.concat(out, ignore_index=True)

    units = sliced(skinny, key, "node", most)
    return by_bucket(units, [*key, "a", "b"], by_size, "u bigint, v bigint")


def estimates(x: np.ndarray, code: np.ndarray, factors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Rotated unit rows, corners over their factors, for each rotation of the code; and the bound on a row's error."""
    d = padded(x.shape[1])
    bits, used = code_bits(d)
    signs = np.unpackbits(code, axis=1)[:, :bits].astype(np.float32) * 2 - 1
    queries = [rotated(x, k).astype(np.float32) for k in range(used)]
    corners = [signs[:, k * d : (k + 1) * d] / (math.sqrt(d) * factors[:, k : k + 1]) for k in range(used)]
    spread = (1 - np.minimum(factors, 1.0) ** 2) / factors**2 / (d - 1)
    return queries, corners, EPSILON * np.sqrt(spread.mean(axis=1) / used)


def group_links(x, code, factors, own, same_slice: bool, least: float):
    """Pairs (i, j) of rows whose exact cosine is `least` or more, and how many pairs were recomputed."""
    x = scaled(x)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    queries, corners, slack = estimates(x / length[:, None], code, factors)
    first, second, made = [], [], 0
    step = max(1, PAIRS * 4 // len(x))
    for at in range(0, len(x), step):
        rows = slice(at, at + step)
        # each of two vectors is once the corner and once the query
        found = sum(c[rows] @ q.T + q[rows] @ c.T for q, c in zip(queries, corners)) / (2 * len(queries))
        maybe = found + np.maximum(slack[rows, None], slack[None, :]) >= least
        maybe &= np.arange(len(x))[None, :] > np.arange(at, at + len(found))[:, None]
        if not same_slice:
            maybe &= own[rows, None] != own[None, :]
        i, j = np.nonzero(maybe)
        i += at
        made += len(i)
        for p in range(0, len(i), PAIRS):
            s, t = i[p : p + PAIRS], j[p : p + PAIRS]
            cosine = np.einsum("ij,ij->i", x[s], x[t]) / (length[s] * length[t])
            first.append(s[cosine >= least])
            second.append(t[cosine >= least])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *first]), np.concatenate([empty, *second]), made


def exact_links(codes: DataFrame, groups: DataFrame, least: float, most: int) -> DataFrame:
    """Rows (u, null, n): u has n links met in one place; and (u, v, 0): links that connect all that are linked."""
    import pandas as pd

    sizes = groups.groupBy("root").agg(F.count("*").alias("many"))
    placed = groups.join(sizes.where(F.col("many") > most), "root", "left")
    met = codes.join(placed, "node").selectExpr(
        "node", "root", "x", "code", "factors", "copies", "if(many IS NULL, array(0L), bands) AS bands"
    )
    met = met.selectExpr("*", "posexplode(bands) AS (band, value)")
    key = ["root", "band", "value"]

    def work(frame, starts, ends):
        u, v, n = [], [], []
        nodes, copies, own = frame["node"].to_numpy(), frame["copies"].to_numpy(), frame["own"].to_numpy()
        band = frame["band"].to_numpy()
        whole = (frame["a"] == frame["b"]).to_numpy()
        x, code, factors, bands = (frame[c].to_numpy() for c in ("x", "code", "factors", "bands"))
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a < 2:
                continue
            i, j, _ = group_links(
                np.stack(x[a:b]).astype(np.float64),
                np.frombuffer(b"".join(code[a:b]), np.uint8).reshape(b - a, -1),
                np.stack(factors[a:b]).astype(np.float32),
                own[a:b],
                bool(whole[a]),
                least,
            )
            if len(i) and len(bands[a]) > 1:
                every = np.stack(bands[a:b])
                kept = [  # a pair counts in the first band that it shares
                    (every[i[p : p + PAIRS]] == every[j[p : p + PAIRS]]).argmax(axis=1) == band[a]
                    for p in range(0, len(i), PAIRS)
                ]
                kept = np.concatenate(kept)
                i, j = i[kept], j[kept]
            if not len(i):
                continue
            links = np.zeros(b - a, np.int64)
            np.add.at(links, i, copies[a:b][j])
            np.add.at(links, j, copies[a:b][i])
            linked = np.flatnonzero(links)
            u.append(nodes[a:b][linked])
            v.append(np.full(len(linked), -1))
            n.append(links[linked])
            s, t = forest(nodes[a:b], i, j)
            u.append(s)
            v.append(t)
            n.append(np.zeros(len(s), np.int64))
        empty = np.empty(0, np.int64)
        columns = (np.concatenate([empty, *c]) for c in (u, v, n))
        return pd.DataFrame(dict(zip("uvn", columns)))

    units = sliced(met, key, "node", most)
    return by_bucket(units, [*key, "a", "b"], work, "u bigint, v bigint, n bigint")


def link(vectors: DataFrame, least: float = LEAST, most: int = MOST, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    finite = "forall(embedding, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < CAST('Infinity' AS DOUBLE))"
    takes = f"coalesce(label IS NOT NULL AND {finite} AND exists(embedding, e -> e <> 0), false)"
    rows = pick(vectors, "vec_id", "label", "embedding").selectExpr(
        "vec_id", "label", "embedding", "xxhash64(embedding) AS h1", "xxhash64('h2', embedding) AS h2", f"{takes} AS takes"
    )
    own = rows.where("takes")
    # equal vectors of a label are one node; 128 bits of hash tell vectors apart
    nodes = own.groupBy("label", "h1", "h2").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("smallest"), F.any_value("embedding").alias("x")
    )
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "*", F.size("x").alias("size"))
    nodes = checkpointed(nodes)
    largest = nodes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    codes = checkpointed(coded(nodes, Bands(largest, least, miss)))
    groups = roots(candidates(codes, least, most))
    members = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    found = checkpointed(exact_links(codes, checkpointed(members), least, most))
    counts = found.where("v < 0").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    tied = roots(found.where("v >= 0").select("u", "v"))
    named = nodes.select("node", "label", "h1", "h2", "copies", "smallest").join(counts, "node", "left").join(tied, "node", "left")
    named = named.selectExpr("label", "h1", "h2", "smallest", "coalesce(n, 0) + copies - 1 AS n_links", "coalesce(root, node) AS root")
    ids = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    told = named.join(ids, "root").select("label", "h1", "h2", "n_links", "component_id")
    inside = own.select("vec_id", "label", "h1", "h2").join(told, ["label", "h1", "h2"])
    outside = rows.where("NOT takes").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    every = inside.select("vec_id", "n_links", "component_id").unionByName(outside)
    return every.selectExpr("*", "coalesce(vec_id = component_id, false) AS kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, label by label."""
    return link(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS w
  FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= {LEAST}
), r(vec_id, met) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, l.w FROM r JOIN l ON r.met = l.u
), c AS (
  SELECT vec_id, min(met) AS component_id FROM r GROUP BY vec_id
), n AS (
  SELECT u, count(*) AS n FROM l GROUP BY u
)
SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.u = c.vec_id
"""
