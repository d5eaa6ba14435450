"""Near copies by the exact Jaccard similarity of word shingles: candidates, then exact links.

Candidates come from two joins: the trie of SimHash fingerprints (`simhash.near_nodes`), and, for similar texts whose
fingerprints differ in more bits than the trie joins, a prefix join of sets.

Texts with equal words (less case of A-Z and white space) are one node, known by the MD5 of those words; a
node's set holds the XXH64 hashes of its shingles. If two sets of sizes a and b have a Jaccard similarity of
t or more, and all sets are put in one common order, they share an element among the first a - ceil(t a) + 1 of one
and the first b - ceil(t b) + 1 of the other. So every set goes with these elements only to the buckets of equal elements.

Candidates. In a bucket, sizes, places of the element and a sketch rule pairs out. The sketch has one bit of each of
`SLOTS` smallest hashes; its bound fails a pair at t once in 1 / `MISS`, everything else is exact. What candidates connect is
a group; tasks give a spanning forest of them and never the pairs: a row is compared with the first one of its bucket,
rows that are no candidates of that one with the next first one, and so on, and then only rows of different
parts with each other. A group of g near copies so takes work in proportion to g.

Links. The sets of a group meet in slices, each with the group's first set as well. A task connects them by exact
Jaccard similarity in the same manner. Where the slices of a group don't become one component, the sets outside
its largest component meet all slices, so that no link between components is missed.

The order puts elements that are frequent in a bounded sample last, so that a common phrase is in few buckets; the
sample decides the work alone, not the result. A bucket of more than `MOST` rows is compared slice by slice.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts are one node, with no
other copy; texts with equal words are copies whatever their length; a text of any length is held once in a task, with
some 40 bytes a word; rows that share an id are told apart by their words; an empty table gives empty ones.
"""

from __future__ import annotations

import math
import string

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.buckets import by_bucket, forest, least_reached, pairs_by_offset, sliced
from tallybook.llm.common import checkpointed, files_for, map_rows, pick
from tallybook.llm.components import roots

SHINGLE = 5
LEAST = (4, 5)
SEED = 42
#: Texts of the sample that orders the shingles, and shingles kept from it.
SAMPLE = 5_000
FREQUENT = 3
MOST_FREQUENT = 50_000
SLOTS = 128
MISS = 1e-10
#: Rows of a bucket's slice, sets of a group's slice, and rows of a bucket that is compared pair by pair.
MOST = 4096
SETS = 512
FEW = 16
SENT = 500_000
#: Texts whose elements or sets one task has, before there are more tasks than cores.
TEXTS = 5_000

WORDS = (
    f"trim(regexp_replace(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),"
    r" '[\\x20\\x09-\\x0D]+', ' '))"
)
NODE = f"md5({WORDS})"
#: A node in buckets, where an accidental equal only makes a candidate.
SHORT = "CAST(conv(substr(node, 1, 15), 16, 10) AS BIGINT)"

MULTIPLIERS = np.random.default_rng(SEED).integers(0, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The XXH64 hash of each run of so many words, in the order of the text."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z alone, ASCII white space alone
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    hashed = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    return np.fromiter((hashed(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle)).view(np.int64)


def sketch(own: np.ndarray) -> np.ndarray:
    """Two words: of each of so many permutations of the hashes a bit of the smallest one."""
    h = own.view(np.uint64)
    least = np.full(SLOTS, 2**64 - 1, np.uint64)
    for at in range(0, len(h), 2048):
        np.minimum(least, (h[at : at + 2048, None] * MULTIPLIERS).min(axis=0), out=least)
    mixed = (least ^ least >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return np.packbits((mixed >> np.uint64(40)) & np.uint64(1) == 1).view(np.int64)


def least_equal(least: tuple[int, int]) -> int:
    """How many bits of two sketches agree at least, but once in 1 / MISS, at the wanted similarity."""
    agree = (1 + least[0] / least[1]) / 2
    if agree >= 1:
        return SLOTS
    below, k = 0.0, -1
    while below < MISS:
        k += 1
        below += math.comb(SLOTS, k) * agree**k * (1 - agree) ** (SLOTS - k)
    return k


def frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a bounded sample have, sorted, and in how many of them."""
    step = max(1, -(-docs.count() // SAMPLE))
    some = docs.where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(step)) == 0)

    def make():
        return lambda _, texts: [[shingle_set(t, shingle) for t in texts]]

    sets = map_rows(some, ["doc_id", "text"], make, "tokens array<bigint>")
    counts = sets.select(F.explode("tokens").alias("token")).groupBy("token").count().where(F.col("count") >= FREQUENT)
    rows = sorted(tuple(r) for r in counts.orderBy(F.desc("count"), "token").limit(MOST_FREQUENT).collect())
    return np.array([t for t, _ in rows], np.int64), np.array([c for _, c in rows], np.int64)


PREFIX = "token bigint, node bigint, n bigint, pos bigint, s bigint, t bigint"
HELD = [part.split()[0] for part in PREFIX.split(", ")]


def prefixes(docs: DataFrame, shingle: int, least: tuple[int, int]) -> DataFrame:
    """token, node, n, pos, s, t: the first elements of every set, its size, the element's place and the sketch."""
    import pandas as pd

    common = docs.sparkSession.sparkContext.broadcast(frequent(docs, shingle))  # at most MOST_FREQUENT tokens
    p, q = least

    def run(batches):
        tokens, counts = common.value
        for batch in batches:
            out, seen = [], set()
            for node, text in zip(batch["short"].tolist(), batch["text"].tolist()):
                if node in seen:
                    continue
                seen.add(node)
                own = shingle_set(text, shingle)
                n = len(own)
                if not n:
                    continue
                bits = sketch(own)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                    own = own[np.lexsort((own, np.where(tokens[at] == own, counts[at], 0)))]
                own = own[: n + 1 - -(-p * n // q)]
                out.append((own, *[np.full(len(own), v) for v in (node, n)], np.arange(len(own)), *[np.full(len(own), b) for b in bits]))
            columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * len(HELD)
            yield pd.DataFrame(dict(zip(HELD, columns)))

    named = docs.selectExpr(f"{NODE} AS node", "text").selectExpr(f"{SHORT} AS short", "text")
    return named.mapInPandas(run, PREFIX)


def met(rows: DataFrame) -> DataFrame:
    """The rows of buckets with more than one node, each node once; a task holds a batch and one row."""
    import pandas as pd

    def run(batches):
        held = None  # the last row so far, and whether its bucket has others
        for batch in batches:
            c = {k: batch[k].to_numpy() for k in HELD}
            if held:
                c = {k: np.concatenate([[held[0][k]], v]) for k, v in c.items()}
            if not len(c["token"]):
                continue
            same = c["token"][1:] == c["token"][:-1]
            fresh = np.concatenate([[True], ~same | (c["node"][1:] != c["node"][:-1])])
            shared = bool(held and held[1])
            c = {k: v[fresh] for k, v in c.items()}
            same = np.concatenate([[shared], c["token"][1:] == c["token"][:-1]])  # with the row before
            keep = same.copy()
            keep[:-1] |= same[1:]
            held = ({k: v[-1] for k, v in c.items()}, bool(same[-1]))
            yield pd.DataFrame({k: v[:-1][keep[:-1]] for k, v in c.items()})
        if held and held[1]:
            yield pd.DataFrame({k: [v] for k, v in held[0].items()})

    return rows.repartition("token").sortWithinPartitions("token", "node").mapInPandas(run, PREFIX)


def connected(n: int, alike) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that connect all that `alike` does, in work that is small where most are alike.

    `alike(i, rows)` tells which of an array of positions are alike to position i. First ones are compared with
    every position; others, which are tied to a first one, only with those of other parts.
    """
    part, first = np.arange(n), np.zeros(n, bool)
    every, todo = np.arange(n), np.ones(n, bool)
    u, v = [], []

    def tie(i, rows):
        u.append(np.full(len(rows), i))
        v.append(rows)
        own = part[i]
        if (part[rows] != own).any():
            part[np.isin(part, part[rows])] = own

    for i in range(n):
        if todo[i]:
            first[i], todo[i] = True, False
            rows = every[every != i]
            rows = rows[alike(i, rows)]
            todo[rows] = False
            tie(i, rows)
    rest = np.flatnonzero(~first)
    if len(rest) and (part[rest] != part[rest[0]]).any():
        for i in rest.tolist():
            rows = rest[part[rest] != part[i]]
            if len(rows):
                tie(i, rows[alike(i, rows)])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *u]), np.concatenate([empty, *v])


def candidates(rows: DataFrame, least: tuple[int, int]) -> DataFrame:
    """u, v: links that connect all nodes which sizes, places and sketches allow to be similar."""
    import pandas as pd

    p, q = least
    bits = least_equal(least)

    def work(frame, starts, ends):
        node, n, pos, s, t = (frame[c].to_numpy() for c in HELD[1:])

        def alike(i, j):
            wanted = -(-p * (n[i] + n[j]) // (p + q))
            ok = np.minimum(n[i] - pos[i], n[j] - pos[j]) >= wanted
            return ok & (np.bitwise_count(s[i] ^ s[j]) + np.bitwise_count(t[i] ^ t[j]) <= SLOTS - bits)

        s, t = s.view(np.uint64), t.view(np.uint64)
        few = ends - starts <= FEW
        first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, j in pairs_by_offset(starts[few], ends[few]):
            near = alike(i, j)
            first.append(i[near])
            second.append(j[near])
        for a, b in zip(starts[~few].tolist(), ends[~few].tolist()):
            i, j = connected(b - a, lambda i, rows: alike(a + i, a + rows))
            first.append(a + i)
            second.append(a + j)
        u, v = forest(node, np.concatenate(first), np.concatenate(second))
        return pd.DataFrame({"u": u, "v": v})

    units = sliced(rows, ["token"], "node", MOST)
    return by_bucket(units, ["token", "a", "b"], work, "u bigint, v bigint")


def member_sets(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """node, root, tokens, s, t: the sets of the nodes that may have a copy, each once."""
    if members.count() <= SENT:  # the texts then stay where they are
        members = F.broadcast(members)
    named = docs.selectExpr("doc_id", f"{NODE} AS node", "text")
    rows = named.join(members.withColumnRenamed("node", "own"), F.expr("node = own AND doc_id <=> first_id"))
    rows = rows.select("node", "root", "text")

    def make():
        def work(_node, _root, texts):
            sets = [shingle_set(t, shingle) for t in texts]
            bits = [sketch(x) for x in sets]
            return [sets, [int(b[0]) for b in bits], [int(b[1]) for b in bits]]

        return work

    return map_rows(rows, ["node", "root", "text"], make, "tokens array<bigint>, s bigint, t bigint").dropDuplicates(["node"])


class Sets:
    """The sets of one slice of a group."""

    def __init__(self, tokens, s: np.ndarray, t: np.ndarray, least: tuple[int, int]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.ends = np.cumsum(self.sizes)
        self.tokens = np.concatenate([np.empty(0, np.int64), *tokens]).view(np.uint64)  # sorted as such in each set
        self.s, self.t = s.view(np.uint64), t.view(np.uint64)
        self.least, self.bits = least, least_equal(least)

    def alike(self, i: int, rows: np.ndarray) -> np.ndarray:
        """Which rows have the wanted Jaccard similarity with row i; sketches first, then the sets."""
        p, q = self.least
        sizes = self.sizes[rows]
        ok = (np.minimum(sizes, self.sizes[i]) * q >= np.maximum(sizes, self.sizes[i]) * p) & (
            np.bitwise_count(self.s[i] ^ self.s[rows]) + np.bitwise_count(self.t[i] ^ self.t[rows]) <= SLOTS - self.bits
        )
        maybe = np.flatnonzero(ok)
        if len(maybe):
            n = sizes[maybe]
            starts = np.cumsum(n) - n
            at = np.arange(n.sum()) + np.repeat(self.ends[rows[maybe]] - n - starts, n)
            own = self.tokens[self.ends[i] - self.sizes[i] : self.ends[i]]
            found = self.tokens[at]
            place = np.minimum(np.searchsorted(own, found), len(own) - 1)
            both = np.add.reduceat((own[place] == found).astype(np.int64), starts)
            ok[maybe] = both * (p + q) >= p * (n + self.sizes[i])
        return ok


LINKS = "u string, v string"


def slice_links(sets: DataFrame, sizes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """u, v: links that connect what is similar within a slice of a group, or to the group's first set."""
    import pandas as pd

    own = sets.join(sizes, "root").withColumn("slice", F.expr("CAST(pmod(xxhash64(node), slices) AS INT)"))
    lead = own.where("node = first_node AND slices > 1").selectExpr(
        "* EXCEPT (slice)", "explode(filter(sequence(0, slices - 1), x -> x <> slice)) AS slice"
    )
    columns = ["root", "slice", "node", "tokens", "s", "t"]

    def work(frame, starts, ends):
        u, v = [], []
        node, tokens, s, t = (frame[c].to_numpy() for c in columns[2:])
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a > 1:
                group = Sets(tokens[a:b], s[a:b], t[a:b], least)
                i, j = connected(b - a, group.alike)
                low = least_reached(b - a, i, j)
                tied = np.flatnonzero(low != np.arange(b - a))
                u += node[a:b][tied].tolist()
                v += node[a:b][low[tied]].tolist()
        return pd.DataFrame({"u": pd.Series(u, dtype=object), "v": pd.Series(v, dtype=object)})

    return by_bucket(own.select(*columns).unionByName(lead.select(*columns)), ["root", "slice"], work, LINKS)


def cross_links(sets: DataFrame, sizes: DataFrame, tied: DataFrame, least: tuple[int, int]) -> DataFrame:
    """u, v: links between components of one group, where its slices left several."""
    import pandas as pd

    parted = sets.select("node", "root").join(sizes.where("slices > 1"), "root").join(
        tied.select("node", F.col("root").alias("part")), "node", "left"
    ).selectExpr("node", "root", "slices", "coalesce(part, node) AS part")
    counts = parted.groupBy("root", "part").count()
    main = counts.groupBy("root").agg(
        F.max_by("part", F.struct("count", "part")).alias("main"), (F.sum("count") - F.max("count")).alias("outside")
    )
    main = main.where("outside > 0").withColumn("others", F.expr(f"CAST(ceil(outside / {SETS}) AS INT)")).drop("outside")
    placed = parted.join(main, "root").withColumn("slice", F.expr("CAST(pmod(xxhash64(node), slices) AS INT)"))
    placed = placed.withColumn("other", F.expr("if(part = main, -1, CAST(pmod(xxhash64('other', node), others) AS INT))"))
    placed = checkpointed(placed, files_for(sets.count()))
    rows = sets.drop("root").join(placed, "node")
    held = ["root", "slice", "other", "node", "part", "asks", "tokens", "s", "t"]
    # each member once for every slice of the others, and each of the others once for every slice of members
    members = rows.selectExpr("* EXCEPT (other)", "explode(sequence(0, others - 1)) AS other", "false AS asks")
    asking = rows.where("other >= 0").selectExpr("* EXCEPT (slice)", "explode(sequence(0, slices - 1)) AS slice", "true AS asks")
    units = members.select(*held).unionByName(asking.select(*held))

    def work(frame, starts, ends):
        u, v = [], []
        node, part, asks, tokens, s, t = (frame[c].to_numpy() for c in held[3:])
        for a, b in zip(starts.tolist(), ends.tolist()):
            group = Sets(tokens[a:b], s[a:b], t[a:b], least)
            parts, told = part[a:b], np.flatnonzero(~asks[a:b].astype(bool))
            for i in np.flatnonzero(asks[a:b]).tolist():
                rows = told[parts[told] != parts[i]]
                rows = rows[group.alike(i, rows)]
                if len(rows):  # one link to each component is enough
                    _, one = np.unique(parts[rows].astype(str), return_index=True)
                    v += node[a:b][rows[one]].tolist()
                    u += [node[a + i]] * len(one)
        return pd.DataFrame({"u": pd.Series(u, dtype=object), "v": pd.Series(v, dtype=object)})

    sent = placed.agg(F.sum(F.col("others") + F.when(F.col("other") >= 0, F.col("slices")).otherwise(0))).first()[0] or 0
    return checkpointed(by_bucket(units, ["root", "slice", "other"], work, LINKS), tasks_for(sets, sent))


def tasks_for(df: DataFrame, texts: int) -> int:
    """Of work that follows an exchange; large tables have a task for so many texts."""
    return max(df.sparkSession.sparkContext.defaultParallelism, files_for(texts, TEXTS))


def copies(
    docs: DataFrame, shingle: int = SHINGLE, least: tuple[int, int] = LEAST, near: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and (node, root) of each node that is tied to a smaller one.

    Nodes with one root are connected by links of at least the wanted similarity. `near` holds candidates
    found elsewhere, u and v being short names of nodes; they are checked like the others.
    """
    rows = pick(docs, "doc_id", "text")
    ids = checkpointed(rows.selectExpr("doc_id", f"{NODE} AS node"))
    n = ids.count()
    tasks = tasks_for(docs, n)
    buckets = checkpointed(met(prefixes(rows, shingle, least)), tasks)
    met_in_buckets = candidates(buckets, least)
    groups = roots(near.unionByName(met_in_buckets) if near else met_in_buckets, n + buckets.count())
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")
    members = ids.withColumn("short", F.expr(SHORT)).join(groups.withColumnRenamed("node", "short"), "short")
    members = members.groupBy("node", "root").agg(first).selectExpr("node", "root", "first.doc_id AS first_id")
    sets = checkpointed(member_sets(rows, checkpointed(members, files_for(n)), shingle), tasks)
    sizes = sets.groupBy("root").agg(F.count("*").alias("n"), F.min("node").alias("first_node"))
    sizes = checkpointed(sizes.where("n > 1").selectExpr("root", "first_node", f"CAST(ceil(n / {SETS}) AS INT) AS slices"), files_for(n))
    links = checkpointed(slice_links(sets, sizes, least), tasks)
    tied = roots(links, links.count())
    if not sizes.where("slices > 1").head(1):
        return ids, tied
    more = cross_links(sets, sizes, tied, least)
    found = more.count()
    return ids, roots(links.unionByName(more), links.count() + found) if found else tied
