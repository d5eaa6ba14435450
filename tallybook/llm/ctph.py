"""Operator 8: document fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes triggers the end of a chunk where its lowest bits are all ones; with
e bits, chunks have 2^e bytes on average. A chunk gives one base-64 digit, from a hash of its bytes;
of a run of equal digits three stay, so that repetitive passages don't fill the fingerprint. A
fingerprint is `e:digits:digits:...`: the digits for block sizes 2^e, 2^(e+1) and so on while
there are eight or more. e is the smallest with at most 64 triggers, or a smaller one if the text
is so repetitive that its digits still are at most 65. An edit therefore changes a few digits, and
texts of different lengths still share a block size.

Two fingerprints are compared at each block size that both have. Their likeness is the largest of
1 - distance / longer length over these, the distance counting inserted, deleted and replaced
digits; it is 0 if they share no run of `RUN` digits (one digit less than the shorter one where that is less), and
1 for equal fingerprints.

The next document, which the edited texts need, is found without a global order in one task: cut
points from quantiles of the ids split the ids into ranges, every document goes to its range, and
the first of each range also goes, as a marked row, to the range above.

Defined cases: null is an empty text, whose fingerprint is `0:A`; documents with equal ids
follow each other in the order of their texts; a null id comes last; one document is its own next;
repeated rows are documents of their own; an empty table gives an empty one; a text of any length is held once in a task, with
some 60 bytes of tables a byte; extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import bounded_batches, map_rows, pick, table
from tallybook.operators.scorecard import found_at

WINDOW = 7
DIGITS = 64
RUN = 4
LEAST = 8
LEVELS = 65
#: A range is read in order and never held, so beyond so many ranges they just get longer.
RANGE_CHARS = 16_000_000
MOST_RANGES = 65_536
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

ROLL = 0xD6E8FEB86659FD93
CHUNK = 0x9E3779B97F4A7C15
INVERSE = pow(CHUNK, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Fingerprinter:
    """Keeps the tables of powers, which grow to the longest text seen."""

    def __init__(self):
        self.up = powers(CHUNK, 1 << 14)
        self.down = powers(INVERSE, 1 << 14)

    def levels(self, data: np.ndarray) -> np.ndarray:
        """The number of low one bits of the rolling hash at each byte."""
        h = np.zeros(len(data), np.uint64)
        wide = data.astype(np.uint64) + np.uint64(1)
        for k in range(min(WINDOW, len(data))):
            h[k:] += wide[: len(data) - k] * np.uint64(pow(ROLL, k + 1, 2**64))
        h ^= h >> np.uint64(32)
        h *= np.uint64(CHUNK)
        h ^= h >> np.uint64(29)
        low = h & ~(h + np.uint64(1))  # the low ones alone
        return np.bitwise_count(low).astype(np.int64)

    def fingerprint(self, text: str) -> str:
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        n = len(data)
        if not n:
            return "0:A"
        while len(self.up) <= n:
            size = 2 * len(self.up)
            self.up, self.down = powers(CHUNK, size), powers(INVERSE, size)
        level = self.levels(data)
        reach = np.cumsum(np.bincount(level, minlength=LEVELS)[::-1])[::-1]  # triggers at a level or above
        e = int(np.argmax(reach <= DIGITS)) if reach[-1] <= DIGITS else len(reach)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n])])

        def digits(bits: int) -> np.ndarray:
            ends = np.flatnonzero(level >= bits) + 1
            ends = ends if len(ends) and ends[-1] == n else np.append(ends, n)
            starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
            h = (total[ends] - total[starts]) * self.down[starts]
            h ^= h >> np.uint64(31)
            h *= np.uint64(ROLL)
            d = (h >> np.uint64(58)).astype(np.int64)
            same = d[1:] == d[:-1]
            return d if len(d) < 4 else d[np.concatenate([[True] * 3, ~(same[2:] & same[1:-1] & same[:-2])])]

        found = digits(e)
        while e and len(found) <= DIGITS // 2 and len(finer := digits(e - 1)) <= DIGITS + 1:
            e, found = e - 1, finer
        parts, bits = [str(e)], e
        while bits == e or len(found) >= LEAST:
            parts.append(ALPHABET[found].tobytes().decode())
            bits += 1
            found = digits(bits)
        return ":".join(parts)


def distance(a: str, b: str) -> int:
    """Edit distance, a column of the table at a time as bits of an integer."""
    if not a or not b:
        return len(a) + len(b)
    seen: dict[str, int] = {}
    for i, c in enumerate(a):
        seen[c] = seen.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for c in b:
        eq = seen.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = (up << 1 | 1) & full
        down = down << 1 & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
    return score


def share_run(a: str, b: str) -> bool:
    n = min(RUN, max(1, min(len(a), len(b)) - 1))
    runs = {a[i : i + n] for i in range(len(a) - n + 1)}
    return any(b[i : i + n] in runs for i in range(len(b) - n + 1))


def likeness(first: str, second: str) -> float:
    """0 to 1, for two fingerprints."""
    if first == second:
        return 1.0
    e1, *s1 = first.split(":")
    e2, *s2 = second.split(":")
    own = {int(e1) + i: s for i, s in enumerate(s1)}
    best = 0.0
    for i, b in enumerate(s2):
        a = own.get(int(e2) + i)
        if a is not None and share_run(a, b):
            best = max(best, 1 - distance(a, b) / max(len(a), len(b)))
    return best


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and `fingerprint` of every text."""
    def make():
        f = Fingerprinter()
        return lambda _, texts: [[f.fingerprint(t or "") for t in texts]]

    return map_rows(docs, ["doc_id", "text"], make, "fingerprint string")


def neighbour_ranges(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """doc_id, text, place, marked: each range of ids in one place, with the first of the range below.

    `place` counts from the highest ids; the marked rows of the last place are the first documents. Cut points
    and first ids are small tables, of `MOST_RANGES` rows at most, so the plan has one size for any corpus.
    """
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text")
    chars = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)))).first()[0] or 0
    ranges = min(MOST_RANGES, max(16, -(-chars // range_chars)))
    inner = [i / ranges for i in range(1, ranges)]
    points = sorted({int(p) for p in rows.approxQuantile("doc_id", inner, 0.25 / ranges)})
    cuts = spark.createDataFrame([(points,)], "_cuts array<bigint>")
    at = f"if(doc_id IS NULL, size(_cuts), size(_cuts) - {found_at('_cuts', 'doc_id')})"
    placed = rows.crossJoin(F.broadcast(cuts)).selectExpr("doc_id", "text", f"{at} AS place")
    firsts = placed.groupBy("place").agg(F.max("doc_id").alias("top")).orderBy("place").collect()
    # the range above; above the first range stands the last one
    heads = spark.createDataFrame([(r.place, r.top, firsts[i - 1].place) for i, r in enumerate(firsts)], "own int, top bigint, above int")
    met = placed.join(F.broadcast(heads), F.col("place") == F.col("own"))
    stays = F.struct(F.col("place").alias("place"), F.lit(0).alias("marked"))
    lent = F.struct(F.col("above").alias("place"), F.lit(1).alias("marked"))
    is_head = F.col("doc_id").eqNullSafe(F.col("top"))
    both = met.withColumn("at", F.explode(F.when(is_head, F.array(stays, lent)).otherwise(F.array(stays))))
    return both.select("doc_id", "text", F.col("at.place").alias("place"), F.col("at.marked").alias("marked"))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see `query`."""
    import pandas as pd

    bounded_batches(docs.sparkSession)
    ranged = neighbour_ranges(docs)
    dealt = ranged.repartition(F.col("place")).sortWithinPartitions(
        "place", "marked", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")
    )

    def run(batches):
        f = Fingerprinter()
        held = None  # the row that waits for its next one: place, doc_id, text, fingerprint

        def row(doc_id, text, own, after, after_own):
            new = edited(text, after)
            new_own = f.fingerprint(new)
            digest = hashlib.sha256(new.encode("utf-8")).hexdigest()
            return (doc_id, len(text), digest, own, new_own, likeness(own, new_own), likeness(own, after_own))

        for batch in batches:
            out = []
            for doc_id, text, place, marked in zip(batch["known"], batch["text"], batch["place"], batch["marked"]):
                text = text or ""
                doc_id = None if doc_id is None else int(doc_id)
                if held and held[0] != place:
                    held = None
                if marked and not held:
                    continue  # only the first of the marked rows follows a document
                own = f.fingerprint(text)
                if held:
                    out.append(row(*held[1:], text, own))
                held = None if marked else (place, doc_id, text, own)
            columns = dict(zip(COLUMNS, zip(*out))) if out else {n: [] for n in COLUMNS}
            columns["doc_id"] = pd.array(list(columns["doc_id"]), dtype="Int64")  # exact beside nulls
            yield pd.DataFrame(columns)

    # the id travels as text: a null among them would make pandas hold all of them as doubles
    return dealt.selectExpr("CAST(doc_id AS STRING) AS known", "text", "place", "marked").mapInPandas(run, SCHEMA)


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text and its edited text, fingerprinted and compared."""
    return compare_with_next(table(spark, sf_dir, "documents"))
