"""Small tables and plain versions that the corpus tests share."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, fp string, votes int, place string"
SF_DIR = "/root/testdata/sf0.001"


def awkward(n_long: int = 3000) -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties, repeated rows and clashing columns."""
    rows = random.Random(7)
    prose = " ".join(rows.choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=n_long))
    shared = "The same line stands on every site of this small table, word for word."
    texts = [
        None,
        "",
        "   \n\t ",
        "one",
        "one two",
        "One TWO three four five",
        "one two three four five",
        prose,
        prose,
        prose + " end",
        f"{shared}\nown line a",
        f"{shared}\nown line b\n{shared}",
        "mail a@b.cd call +1 (555) 010-9999 card 4111 1111 1111 1111 at 10.0.0.1",
        "no boundary" * 50,
        "ümläut 日本語 😀 <|endoftext|> end",
        "aaaa" * 100,
        "\x00\x01 control",
    ]
    table = [
        (i, t, ("en", "de", None)[i % 3], ("s1", "s2", None, "s3")[i % 4], len(t or ""), "x", "y", i, None)
        for i, t in enumerate(texts)
    ]
    table += [(100 + i, f"{shared}\nsite {i}", "en", f"site{i}", 10, None, None, None, "p") for i in range(6)]
    table += [table[6], table[6], (None, "text without an id", None, None, None, None, None, None, None)]
    return table


def awkward_docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(folder: str = SF_DIR) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode("utf-8")).hexdigest()


def held(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
