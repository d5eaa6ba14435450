"""Operator 4: byte-level exact substring dedup by blockwise suffix sorting.

A byte goes if it is covered by a string of `min_bytes` bytes that also starts in a document with a
smaller id. Suffixes are therefore compared to that depth only, and sorted one bucket at a time:

- Cover sample. Of every window of `min_bytes` bytes the position of the smallest hash of `GRAM`
  bytes (the leftmost, on ties) is in the sample, and is the window's anchor. Two equal windows have
  equal anchors at an equal distance from their starts. That is what a difference cover grants any
  two suffixes (a distance below its period at which both meet the sample), but with
  about 2 / (min_bytes - GRAM + 2) of the positions instead of about a fifth.
- Buckets. All windows with one anchor string belong to one bucket of suffixes. An anchor that
  only one document has needs no sorting; the first exchange finds those that more have.
- Ranks. A bucket sorts the sample's suffixes from the anchor on, and what stands before it read
  backwards, and keeps the common lengths of neighbours. From these ranks every window, at whatever
  distance from its anchor, gets the class of its part before and of its part from the anchor on: a
  pair of numbers, equal for equal windows only. Long ties so cost no comparison of bytes, and a
  bucket needs memory for its sample and one distance at a time.

Work is dealt in blocks of documents and buckets of anchors whose numbers follow from the bytes.
Exact copies of a text with a smaller id are found first, by a 128-bit hash, and take no part. A
block sends an anchor, and a run of windows with one anchor, once, however many of its documents hold
it, so a string that a third of all documents hold is a row for each block at most. Texts are
exchanged once; the three steps that read them share that exchange.

Defined cases: null is an empty text; texts shorter than `min_bytes` keep all; rows that repeat an id
do not remove from each other; a row with a null id removes nothing and loses nothing; very long
texts are worked through in pieces of `PIECE` windows; of documents that hold a string the smallest id keeps it, and ids
cannot tie but by repeating; an empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import pick, table

MIN_BYTES = 50
GRAM = 20
PIECE = 1 << 18
BLOCK_BYTES = 8_000_000
LEAST_BLOCKS = 64

ROLL = 0xD6E8FEB86659FD93
MIX = 0x9E3779B97F4A7C15


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(ROLL)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from each position, by doubling."""
    power = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
    span, out, length = 1, None, 0
    while True:
        if k & span:
            if out is None:
                out = power
            else:
                n = len(data) - length - span + 1
                out = out[:n] * np.uint64(pow(ROLL, span, 2**64)) + power[length : length + n]
            length += span
        if length == k:
            return mixed(out)
        power = power[:-span] * np.uint64(pow(ROLL, span, 2**64)) + power[span:]
        span *= 2


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """The position of the leftmost minimum of each w neighbours."""
    at, span = np.arange(len(h), dtype=np.int32), 1
    while span < w:
        step = min(span, w - span)
        left = h[:-step] <= h[step:]
        at = np.where(left, at[:-step], at[step:])
        h = np.where(left, h[:-step], h[step:])
        span += step
    return at


def runs_of(data: np.ndarray, min_bytes: int):
    """For each piece: its offset, and of each run of windows with one anchor the first window, the
    number of windows, the anchor's distance from the first, and the anchor's hash."""
    windows = len(data) - min_bytes + 1
    for offset in range(0, windows, PIECE):
        n = min(PIECE, windows - offset)
        h = gram_hashes(data[offset : offset + n + min_bytes - 1], GRAM)
        at = window_minima(h, min_bytes - GRAM + 1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        anchor = at[first]
        yield offset, first, np.diff(np.append(first, n)), anchor - first, mixed(h[anchor])


def packed(array: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values


class Block:
    """The documents of one block, in a fixed order; exact copies and short texts are set apart."""

    def __init__(self, rows: pd.DataFrame, min_bytes: int):
        self.min_bytes = min_bytes
        marked = rows[rows["copy"]]
        copies = set(zip(marked["doc_id"], marked["h1"], marked["h2"]))
        docs = rows[~rows["copy"]].sort_values(["unknown", "doc_id", "h1", "h2"], kind="stable")
        self.docs = []
        for doc_id, unknown, h1, h2, text in zip(*[docs[c] for c in ("doc_id", "unknown", "h1", "h2", "text")]):
            known = not unknown
            data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            copied = known and (doc_id, h1, h2) in copies
            self.docs.append((int(doc_id) if known else None, data, copied))

    def working(self):
        for i, (doc_id, data, copied) in enumerate(self.docs):
            if doc_id is not None and not copied and len(data) >= self.min_bytes:
                yield i, doc_id, data

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchor hashes of the block, and which of them more than one document has."""
        found = [np.empty(0, np.uint64)]
        for _, _, data in self.working():
            found.append(np.unique(np.concatenate([h for *_, h in runs_of(data, self.min_bytes)])))
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        return values, counts > 1

    def shared_runs(self, shared: np.ndarray) -> None:
        """Keeps the runs whose anchor is shared: one entry for each distinct string of bytes."""
        ids: dict[bytes, int] = {}
        hashes, distances, least = [], [], []
        self.at = {}  # document: first windows, numbers of windows, entries
        for i, doc_id, data in self.working():
            raw, m = data.tobytes(), self.min_bytes - 1
            starts, counts, entries = [], [], []
            for offset, first, count, distance, h in runs_of(data, self.min_bytes):
                keep = np.flatnonzero(among(h, shared))
                f, c = (first[keep] + offset), count[keep]
                starts.append(f)
                counts.append(c)
                for a, n, k, d in zip(f.tolist(), c.tolist(), h[keep].tolist(), distance[keep].tolist()):
                    text = raw[a : a + n + m]
                    entry = ids.setdefault(text, len(hashes))
                    if entry == len(hashes):
                        hashes.append(k)
                        distances.append(d)
                        least.append(doc_id)  # documents come in order, so the first is the least
                    entries.append(entry)
            if entries:
                self.at[i] = (np.concatenate(starts), np.concatenate(counts), np.array(entries))
        texts = list(ids)
        h = np.array(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.hashes = h[order]
        self.texts = [texts[i] for i in order.tolist()]
        self.distances = np.array(distances, np.uint16)[order]
        self.least = np.array(least, np.int64)[order]

    def removed(self, i: int, window_least: np.ndarray, window_start: np.ndarray) -> np.ndarray:
        """A mask of the bytes of a document that go."""
        doc_id, data, copied = self.docs[i]
        if copied and len(data) >= self.min_bytes:
            return np.ones(len(data), bool)
        gone = np.zeros(len(data) + 1, np.int32)
        if i in self.at:
            first, count, entry = self.at[i]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            least = window_least[np.repeat(window_start[self.rank[entry]], count) + within]
            hit = (np.repeat(first, count) + within)[least < doc_id]
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + self.min_bytes, -1)
        return np.cumsum(gone[:-1]) > 0


def in_buckets(hashes: np.ndarray, buckets: int):
    """Slices of sorted hashes by bucket."""
    width = 2**64 // buckets + 1
    edges = np.searchsorted(hashes, np.array([i * width for i in range(1, buckets)], np.uint64))
    edges = [0, *edges.tolist(), len(hashes)]
    return [(b, edges[b], edges[b + 1]) for b in range(buckets) if edges[b] < edges[b + 1]]


def ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of rows of bytes, and how many bytes each shares with the one before."""
    n, width = rows.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = rows
    order = np.lexsort(wide.view(">u8").T[::-1])
    differ = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.concatenate([[0], common])


def context(text: np.ndarray, at: np.ndarray, stop: np.ndarray, width: int, step: int) -> np.ndarray:
    """Bytes from `at` on in direction `step`, zeros from `stop` on."""
    out = np.zeros((len(at), width), np.uint8)
    for k in range(width):
        place = at + step * k
        inside = place < stop if step > 0 else place >= stop
        out[inside, k] = text[place[inside]]
    return out


def window_minimums(texts: list[bytes], distances: np.ndarray, least: np.ndarray, min_bytes: int):
    """For each window of each string the least id among the strings' documents that hold it.

    Returns the flat array and where each string's windows start in it.
    """
    size = np.array([len(t) for t in texts], np.int64)
    text = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum(size)
    start = end - size
    windows = size - min_bytes + 1
    flat_start = np.cumsum(windows) - windows
    anchor = start + distances
    reach = min_bytes - GRAM  # the farthest that an anchor can stand from its window's start
    right_order, right_common = ranks(context(text, anchor, end, min_bytes, 1))
    left_order, left_common = ranks(context(text, anchor - 1, start, max(reach, 1), -1))
    out = np.empty(int(windows.sum()), np.int64)
    left, right = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    for distance in range(reach + 1):
        own = np.flatnonzero((distances >= distance) & (distances - distance < windows))
        if not len(own):
            continue
        right[right_order] = np.cumsum(right_common < min_bytes - distance)
        left[left_order] = np.cumsum(left_common < distance) if distance else 0
        pair = left[own] * (len(texts) + 1) + right[own]
        order = np.argsort(pair, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair[order]) != 0]))
        low = np.minimum.reduceat(least[own][order], first)
        found = np.empty(len(own), np.int64)
        found[order] = np.repeat(low, np.diff(np.append(first, len(own))))
        out[flat_start[own] + distances[own] - distance] = found
    return out, flat_start


ANSWER = "block int, bucket int, step int, a binary, b binary"


def answers_of(rows: pd.DataFrame, step: int) -> pd.DataFrame:
    return rows[rows["step"] == step].sort_values("bucket", kind="stable")


def shared_hashes(answers: pd.DataFrame) -> np.ndarray:
    parts = [unpacked(a, np.uint64) for a in answers_of(answers, 1)["a"]]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)  # buckets in order: sorted


def anchor_rows(block: int, own: Block, buckets: int) -> pd.DataFrame:
    values, many = own.anchors()
    return pd.DataFrame(
        [(block, b, 0, values[i:j].tobytes(), np.packbits(many[i:j]).tobytes()) for b, i, j in in_buckets(values, buckets)],
        columns=["block", "bucket", "step", "a", "b"],
    )


def share_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    """For each block its anchors in this bucket that more than one document has."""
    values = [np.frombuffer(a, np.uint64) for a in rows["a"]]
    several = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(v)).astype(bool) for v, b in zip(values, rows["b"])]
    every = np.concatenate(values)
    every.sort()
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for block, bucket, v, many in zip(rows["block"], rows["bucket"], values, several):
        shared = v[many | among(v, twice)]
        if len(shared):
            out.append((block, bucket, 1, packed(shared), b""))
    return pd.DataFrame(out, columns=["block", "bucket", "step", "a", "b"])


def run_rows(block: int, own: Block, buckets: int) -> pd.DataFrame:
    """The block's runs with shared anchors: lengths, distances and least ids; and their bytes."""
    import zstandard

    out = []
    for b, i, j in in_buckets(own.hashes, buckets):
        size = np.array([len(t) for t in own.texts[i:j]], np.uint32)
        head = size.tobytes() + own.distances[i:j].tobytes() + own.least[i:j].tobytes()
        pack = zstandard.ZstdCompressor(level=1).compress
        out.append((block, b, int(j - i), pack(head), pack(b"".join(own.texts[i:j]))))
    return pd.DataFrame(out, columns=["block", "bucket", "step", "a", "b"])


def least_windows(rows: pd.DataFrame, min_bytes: int) -> pd.DataFrame:
    """For each block the windows of its runs that a smaller id than the block's own holds."""
    ids: dict[bytes, int] = {}
    distances, least, sent = [], [], []
    for block, bucket, n, a, b in zip(rows["block"], rows["bucket"], rows["step"], rows["a"], rows["b"]):
        head = unpacked(a, np.uint8)
        size = head[: 4 * n].view(np.uint32).astype(np.int64)
        far = head[4 * n : 6 * n].view(np.uint16)
        low = head[6 * n :].view(np.int64)
        raw, end = unpacked(b, np.uint8).tobytes(), np.cumsum(size)
        own = np.empty(n, np.int64)
        for i, (s, e, d, m) in enumerate(zip((end - size).tolist(), end.tolist(), far.tolist(), low.tolist())):
            text = raw[s:e]
            entry = own[i] = ids.setdefault(text, len(least))
            if entry == len(least):
                distances.append(d)
                least.append(m)
            elif m < least[entry]:
                least[entry] = m
        sent.append((block, bucket, own, low, size - min_bytes + 1))
    flat, start = window_minimums(list(ids), np.array(distances, np.int64), np.array(least, np.int64), min_bytes)
    out = []
    for block, bucket, own, low, windows in sent:
        within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        found = flat[np.repeat(start[own], windows) + within]
        lower = found < np.repeat(low, windows)
        told = np.logical_or.reduceat(lower, np.cumsum(windows) - windows)
        if told.any():
            values = found[np.repeat(told, windows)]
            out.append((block, bucket, 2, packed(np.flatnonzero(told).astype(np.uint32)), packed(values)))
    return pd.DataFrame(out, columns=["block", "bucket", "step", "a", "b"])


def result_rows(own: Block, answers: pd.DataFrame, buckets: int, keep_bytes: bool) -> pd.DataFrame:
    windows = np.array([len(t) for t in own.texts], np.int64) - own.min_bytes + 1
    start = np.cumsum(windows) - windows
    flat = np.repeat(own.least, windows)
    edges = {b: i for b, i, _ in in_buckets(own.hashes, buckets)}
    told = answers_of(answers, 2)
    for bucket, a, b in zip(told["bucket"], told["a"], told["b"]):
        entry = unpacked(a, np.uint32).astype(np.int64) + edges[bucket]
        n = windows[entry]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        flat[np.repeat(start[entry], n) + within] = unpacked(b, np.int64)
    out = []
    for i, (doc_id, data, _) in enumerate(own.docs):
        gone = own.removed(i, flat, start)
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        kept = data[~gone].tobytes()
        spans = [{"start": int(a), "end": int(b)} for a, b in zip(first, last)] if keep_bytes else None
        digest = hashlib.sha256(kept).hexdigest()
        out.append((doc_id, len(data), int(gone.sum()), len(first), digest, kept if keep_bytes else None, spans))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
    columns = dict(zip(names, zip(*out))) if out else {n: [] for n in names}
    columns["doc_id"] = pd.array(list(columns["doc_id"]), dtype="Int64")  # exact beside nulls
    return pd.DataFrame(columns)


RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary,"
    " spans array<struct<start:bigint,end:bigint>>"
)


def dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with `keep_bytes` what is left and the removed spans."""
    if min_bytes < GRAM:
        raise ValueError(f"min_bytes must be {GRAM} or more")
    rows = pick(docs, "doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = buckets = max(LEAST_BLOCKS, -(-total // BLOCK_BYTES))

    hashed = rows.selectExpr("doc_id", "xxhash64(text) AS h1", "xxhash64('text', text) AS h2", "text")
    skinny = hashed.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "h1", "h2")
    first = skinny.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    copies = skinny.join(first, ["h1", "h2"]).where("doc_id > least").select("doc_id", "h1", "h2").distinct()
    block = f"CAST(pmod(xxhash64(doc_id, h1, h2), {blocks}) AS INT) AS block"
    # a null among the ids of a block would make pandas hold all of them as doubles
    own = ("coalesce(doc_id, 0L) AS doc_id", "doc_id IS NULL AS unknown", "h1", "h2")
    both = hashed.selectExpr(block, *own, "text", "false AS copy").unionByName(
        copies.selectExpr(block, *own, "CAST(NULL AS STRING) AS text", "true AS copy")
    )

    def first_step(key, own):
        return anchor_rows(key[0], Block(own, min_bytes), buckets)

    def second_step(key, own, answers):
        part = Block(own, min_bytes)
        part.shared_runs(shared_hashes(answers))
        return run_rows(key[0], part, buckets)

    def last_step(key, own, answers):
        part = Block(own, min_bytes)
        part.shared_runs(shared_hashes(answers))
        return result_rows(part, answers, buckets, keep_bytes)

    grouped = both.groupBy("block")
    anchors = grouped.applyInPandas(first_step, ANSWER)
    shared = anchors.groupBy("bucket").applyInPandas(share_anchors, ANSWER)
    runs = grouped.cogroup(shared.groupBy("block")).applyInPandas(second_step, ANSWER)
    least = runs.groupBy("bucket").applyInPandas(lambda p: least_windows(p, min_bytes), ANSWER)
    answers = shared.unionByName(least)
    return grouped.cogroup(answers.groupBy("block")).applyInPandas(last_step, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: bytes, bytes removed, removed runs and the digest of what is left."""
    found = dedup(table(spark, sf_dir, "documents"), keep_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
