"""Operator 7: byte-level BPE with reuse of content-defined chunks.

A text is cut where a rolling hash of its last eight code points hits a mask, so that equal
passages give equal chunks wherever they stand. A chunk is encoded once per task, however many
documents hold it, up to its first and from its last certain word boundary: a space between a
visible character and a letter, where the vocabulary's own splitting always starts a new piece. What
remains at both ends of a join is encoded again as one string. Where a chunk has no certain
boundary, the repair goes on into the next chunk, and so on until both sides agree, at the latest
at the ends of the text. The tokens are therefore exactly those of the whole text.

Pieces of Latin text alone are encoded from the same vocabulary's table of ranks by a second library,
which gives the same tokens in a third of the time; all others by the tokenizer itself.

The store of encoded chunks is emptied when it holds `STORE_CHARS` code points, which costs time
only. Decoding works piece by piece too, as every piece is a whole string.

Defined cases: null is an empty text; an empty text has no tokens; the string of a special token in
a text gives that token, as in the library; repeated rows give repeated results; a text of any length is
encoded chunk by chunk, its tokens being held at once; there are no ties, as the merges have one order; an empty table gives an
empty one; extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.common import map_rows, table

#: The string of the vocabulary's special token.
SPECIAL = "<|endoftext|>"
OTHER = re.compile("[^\\x00-\\u024f]")
WINDOW = 8
MASK_BITS = 9
STORE_CHARS = 16_000_000
MULTIPLIER = 0x9E3779B97F4A7C15


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_of_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def files(path: str | None, ranks: str | None) -> tuple[str, str | None]:
    """The vocabulary and its table of ranks; another vocabulary is used without one unless it is given."""
    return (path, ranks) if path else (vocabulary(), ranks or ranks_of_vocabulary())


def by_ranks(path: str, special: int):
    """An encoder from the table of ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: special}
    )


def cuts(codes: np.ndarray) -> np.ndarray:
    """Where chunks start (without 0), by the hash of the code points before."""
    if len(codes) <= WINDOW:
        return np.empty(0, np.int64)
    h = codes.astype(np.uint64) * np.uint64(MULTIPLIER)
    h ^= h >> np.uint64(31)
    factor, span = MULTIPLIER, 1
    while span < WINDOW:
        h = h[:-span] * np.uint64(factor) + h[span:]
        factor, span = factor * factor % 2**64, span * 2
    h ^= h >> np.uint64(32)
    return np.flatnonzero((h[:-1] & np.uint64((1 << MASK_BITS) - 1)) == 0) + WINDOW


def certain(codes: np.ndarray) -> np.ndarray:
    """Places where the vocabulary's splitting starts a piece, whatever stands elsewhere."""
    before, here, after = codes[:-2], codes[1:-1], codes[2:]
    visible = ((before > 0x20) & (before < 0x7F)) | ((before >= 0xC0) & (before < 0x250))
    letter = ((after | 0x20) >= 0x61) & ((after | 0x20) <= 0x7A)
    return np.flatnonzero(visible & (here == 0x20) & letter) + 1


class Codec:
    """Encodes and decodes texts by way of their chunks."""

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = self.tokenizer.token_to_id(SPECIAL)
        self.ranks = by_ranks(ranks, special) if ranks else None
        self.names = [str(i) for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True) + 1)]
        self.store: dict[str, tuple[int, object, str]] = {}
        self.stored = 0

    def pieces(self, text: str) -> list[str]:
        """The strings to encode: chunk bodies and repaired joins, which make up the text."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = cuts(codes)
        if not len(starts):
            return [text] if text else []
        safe = certain(codes)
        ends = np.append(starts, len(codes))
        starts = np.insert(starts, 0, 0)
        # a boundary counts if both its neighbours are in the chunk, so that the chunk alone tells
        low = np.searchsorted(safe, starts + 1, "left")
        high = np.searchsorted(safe, ends - 1, "left")
        out, at = [], 0
        for a, b in zip(low.tolist(), high.tolist()):
            if a < b:
                first, last = int(safe[a]), int(safe[b - 1])
                if first > at:
                    out.append(text[at:first])
                if last > first:
                    out.append(text[first:last])
                at = last
        out.append(text[at:])
        return out

    def learn(self, texts: list[list[str]]) -> None:
        """Encode and decode the pieces that are not in the store, each once."""
        new = list(dict.fromkeys(p for pieces in texts for p in pieces if p not in self.store))
        for i in range(0, len(new), 2000):
            part = new[i : i + 2000]
            ids = self.tokens(part)
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            for p, x, t in zip(part, ids, back):
                self.store[p] = (len(x), self.form(x), t)
                self.stored += len(p)

    def tokens(self, pieces: list[str]) -> list[list[int]]:
        latin = [self.ranks is not None and not OTHER.search(p) for p in pieces]
        others = [p for p, fast in zip(pieces, latin) if not fast]
        slow = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
        encode = self.ranks.encode if self.ranks else None
        return [encode(p, allowed_special="all") if fast else next(slow).ids for p, fast in zip(pieces, latin)]

    def form(self, ids: list[int]) -> object:
        return np.array(ids, np.int32)

    def run(self, texts: list[str]):
        """For each text the stored entries of its pieces, in order."""
        batch, size = [], 0
        for i, text in enumerate(texts):
            batch.append(self.pieces(text))
            size += len(text)
            if size > STORE_CHARS // 4 or i + 1 == len(texts):
                if self.stored > STORE_CHARS:
                    self.store, self.stored = {}, 0
                self.learn(batch)
                for pieces in batch:
                    yield [self.store[p] for p in pieces]
                batch, size = [], 0

    def encode(self, texts: list[str]) -> list[list]:
        """Of each text the tokens, and whether they decode to the text."""
        none = np.empty(0, np.int32)
        ids, exact = [], []
        for text, entries in zip(texts, self.run(texts)):
            ids.append(np.concatenate([none, *[e[1] for e in entries]]))
            exact.append("".join([e[2] for e in entries]) == text)
        return [ids, exact]


class DigestCodec(Codec):
    """Stores ids as decimal text, for digests that need no list of ids."""

    def form(self, ids: list[int]) -> bytes:
        names = self.names
        return ",".join([names[i] for i in ids]).encode()

    def digests(self, texts: list[str]) -> list[list]:
        rows = []
        for entries in self.run(texts):
            ids = hashlib.sha256(b",".join([e[1] for e in entries if e[0]]))
            decoded = hashlib.sha256("".join([e[2] for e in entries]).encode("utf-8"))
            rows.append((sum(e[0] for e in entries), ids.hexdigest(), decoded.hexdigest()))
        return [list(c) for c in zip(*rows)] if rows else [[], [], []]


def encode(docs: DataFrame, path: str | None = None, ranks: str | None = None) -> DataFrame:
    """doc_id, `ids`, the tokens of the text, and `exact`: whether they decode to it."""
    path, ranks = files(path, ranks)

    def make():
        codec = Codec(path, ranks)
        return lambda _, texts: codec.encode([t or "" for t in texts])

    return map_rows(docs, ["doc_id", "text"], make, "ids array<int>, exact boolean")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and `decoded`, the text of the tokens in `ids`; null ids give an empty text."""
    path = path or vocabulary()

    def make():
        tokenizer = Codec(path).tokenizer

        def work(_, ids):
            lists = [[] if x is None else [int(i) for i in x] for x in ids]
            return [tokenizer.decode_batch(lists, skip_special_tokens=False)]

        return work

    return map_rows(encoded, ["doc_id", "ids"], make, "decoded string").select("doc_id", "decoded")


def digest(docs: DataFrame, path: str | None = None, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    path, ranks = files(path, ranks)

    def make():
        codec = DigestCodec(path, ranks)
        return lambda _, texts: codec.digests([t or "" for t in texts])

    return map_rows(docs, ["doc_id", "text"], make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document, encoded and decoded again."""
    return digest(table(spark, sf_dir, "documents"))
