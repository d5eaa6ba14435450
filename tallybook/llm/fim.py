"""Operator 13: fill-in-middle transformation with a piece table.

A document is never edited. Its text is one immutable buffer, the sentinels are others, and a
piece table lists descriptors (buffer, start, length) in the order in which they read as the document. Cutting
splits a descriptor in two; an arrangement permutes the descriptors and puts those of sentinels between
them; the inverse permutation restores the original. Lengths, digests and the written text
stream over the descriptors, so that no intermediate text is built.

The cuts stand after lines (`[^\\n]*\\n|[^\\n]+`) and follow from a SHA-256 of a seed and the id: the draw
needs no state, and a rerun or a retried task gives the same result. With draws h1 to h4 of 32 bits and n
lines the prefix ends after min(h1 mod (n+1), h2 mod (n+1)) lines and the middle after the larger; a
document is transformed if h3 mod 100 is under `rate`, and reads suffix first (spm) if h4 mod 100 is under `spm`,
else prefix first (psm).

Defined cases: null is an empty text; an empty text, and one that holds a sentinel, stays plain; a
null id draws like the empty string; a text of any length is held once, as bytes, with one offset for each
line; repeated rows, and rows that share an id, are each transformed by themselves, alike where their
texts are; an empty table gives an empty one; extra columns pass through `transform`, whatever their
names, and the added ones then get a leading underscore.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import fresh, map_batches, map_rows, pick, table

#: The sentinels before prefix, middle and suffix.
SENTINELS = ("<P>", "<M>", "<S>")
SEED = 7
RATE = 100
SPM = 50
#: The parts in the order of each form; a part's sentinel stands before it.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}

Piece = tuple[int, int, int]


class PieceTable:
    """Descriptors over immutable byte buffers. Buffer 0 is the text."""

    def __init__(self, text: bytes, others: tuple[bytes, ...] = ()):
        self.buffers = [memoryview(b) for b in (text, *others)]
        self.pieces: list[Piece] = [(0, 0, len(text))]

    def cut(self, *offsets: int) -> None:
        """Split the descriptors of the text at ascending offsets into it; empty parts stay parts."""
        for at in offsets:
            buffer, start, length = self.pieces.pop()
            self.pieces += [(buffer, start, at - start), (buffer, at, start + length - at)]

    def arrange(self, order: tuple[int, ...]) -> None:
        """The parts in the given order, each behind the buffer of its sentinel."""
        self.pieces = [p for part in order for p in ((part + 1, 0, len(self.buffers[part + 1])), self.pieces[part])]

    def restore(self, order: tuple[int, ...]) -> None:
        """The inverse of `arrange`: sentinels go, parts return to their places."""
        parts = self.pieces[1::2]
        inverse = [order.index(part) for part in range(len(order))]
        self.pieces = [parts[place] for place in inverse]

    def stream(self):
        """The bytes of the document, piece by piece and not copied."""
        for buffer, start, length in self.pieces:
            if length:
                yield self.buffers[buffer][start : start + length]

    def digest(self) -> str:
        out = hashlib.sha256()
        for part in self.stream():
            out.update(part)
        return out.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.stream())


def line_ends(text: bytes) -> np.ndarray:
    """The offset after each line."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits."""
    known = "" if doc_id is None else str(doc_id)
    code = hashlib.sha256(f"{seed}:{known}".encode()).hexdigest()
    return [int(code[i : i + 8], 16) for i in range(0, 32, 8)]


def code_points(part) -> int:
    """The number of code points in bytes of UTF-8."""
    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80)) if len(part) else 0


class Transformer:
    """The transformation of one document after the other."""

    def __init__(self, rate: int = RATE, spm: int = SPM, seed: int = SEED, sentinels: tuple[str, ...] = SENTINELS):
        self.rate, self.spm, self.seed = rate, spm, seed
        self.marks = tuple(s.encode() for s in sentinels)

    def form(self, text: bytes, h: list[int]) -> str:
        if not text or any(m in text for m in self.marks) or h[2] % 100 >= self.rate:
            return "plain"
        return "spm" if h[3] % 100 < self.spm else "psm"

    def arranged(self, doc_id: int | None, text: str | None):
        """n, form, code points of prefix and middle (None if plain), and the piece table of the output."""
        own = (text or "").encode("utf-8")
        h = draws(doc_id, self.seed)
        ends = line_ends(own)
        pieces, form = PieceTable(own, self.marks), self.form(own, h)
        if form == "plain":
            return len(ends), form, None, None, pieces
        first, last = sorted(x % (len(ends) + 1) for x in h[:2])
        a, b = (int(ends[k - 1]) if k else 0 for k in (first, last))
        pieces.cut(a, b)
        pieces.arrange(ORDERS[form])
        return len(ends), form, code_points(own[:a]), code_points(own[a:b]), pieces

    def rebuilt(self, output: bytes, form: str) -> PieceTable:
        """The piece table of the document that an output and its form come from.

        A text that is transformed holds no sentinel, and none can arise where a part meets one, as
        each begins with a character that it holds nowhere else; so the first find of each is it.
        """
        pieces = PieceTable(output)
        if form == "plain":
            return pieces
        at, offsets = 0, []
        for part in ORDERS[form]:
            at = output.index(self.marks[part], at)
            offsets += [at, at + len(self.marks[part])]
        pieces.cut(*offsets)
        pieces.pieces.pop(0)  # nothing stands before the first sentinel
        pieces.restore(ORDERS[form])
        return pieces


def checked(sentinels: tuple[str, ...]) -> tuple[str, ...]:
    """Three sentinels that differ and whose first character stands nowhere else in one."""
    heads = {s[:1] for s in sentinels}
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or "" in sentinels or any(h in s[1:] for h in heads for s in sentinels):
        raise ValueError("three different sentinels, whose first characters occur in none again")
    return sentinels


def transform(
    docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED, sentinels: tuple[str, ...] = SENTINELS
) -> DataFrame:
    """The documents with `fim_text` and `fim_form`."""
    settings = (rate, spm, seed, checked(sentinels))

    def make():
        own = Transformer(*settings)

        def work(ids, texts):
            made = [own.arranged(i, t) for i, t in zip(ids, texts)]
            return [[p.joined().decode("utf-8") for *_, p in made], [form for _, form, *_ in made]]

        return work

    text, form = fresh(docs.columns, "fim_text"), fresh(docs.columns, "fim_form")
    return map_batches(docs, ["doc_id", "text"], docs.columns, make, f"`{text}` string, `{form}` string")


def restore(made: DataFrame, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """doc_id and `text` from a table of doc_id, fim_text and fim_form."""
    marks = checked(sentinels)

    def make():
        own = Transformer(sentinels=marks)
        return lambda texts, forms: [[own.rebuilt(t.encode("utf-8"), f).joined().decode("utf-8") for t, f in zip(texts, forms)]]

    return map_batches(pick(made, "doc_id", "fim_text", "fim_form"), ["fim_text", "fim_form"], ["doc_id"], make, "text string")


DIGEST = (
    "n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, the cuts, and digests of the output and of what is rebuilt from it."""

    def make():
        own = Transformer()

        def row(doc_id, text):
            n, form, prefix, middle, pieces = own.arranged(doc_id, text)
            restored = own.rebuilt(pieces.joined(), form)
            return n, form, prefix, middle, pieces.digest(), restored.digest()

        return lambda ids, texts: list(zip(*map(row, ids, texts))) or [[]] * 6

    return map_rows(docs, ["doc_id", "text"], make, DIGEST)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text, transformed and restored."""
    return digest(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM documents
), h AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS u,
         CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2,
         CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT doc_id, t, u, len(u) AS n,
         least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS x,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS y, coalesce(array_to_string(u[b + 1:n], ''), '') AS z
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
