"""Fill-in-middle by a piece table; exact ids, long texts and labels of one kind in the text operators."""

from __future__ import annotations

import random
import re
import time

import pytest

from compare import connect, differences
from llm_cases import SF_DIR, awkward, awkward_docs, no_docs, sha
from tallybook.llm import bpe, ctph, fim, langid, pii, simhash, suffixes, toxicity


def plain_fim(doc_id, text):
    """n, form, prefix_chars, middle_chars and output by string operations."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    code = sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(code[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < 50:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["a\nb\nc", "\n\n", "x", "ends\n", "<P", "a <S\n> <", "has <M> in it\nand more", "é\n日本\n😀", "\r\nq\x0bw e\n"]


@pytest.mark.parametrize("source", ["table", "awkward", "edge"])
def test_digests_against_strings(spark, source):
    if source == "table":
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    elif source == "awkward":
        docs = awkward_docs(spark)
    else:
        docs = spark.createDataFrame([(k * 100 + i, t) for k in range(6) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, form, prefix, middle, output = plain_fim(r.doc_id, r.text)
        want.append((r.doc_id, n, form, prefix, middle, sha(output), sha(r.text or "")))
    assert sorted((tuple(r) for r in fim.digest(docs).collect()), key=str) == sorted(want, key=str)


def test_against_sql(spark):
    assert differences(fim.query(spark, SF_DIR), connect(SF_DIR), fim.ORACLE_SQL) == []


def test_transform_passes_columns_and_restores(spark):
    docs = awkward_docs(spark).withColumnRenamed("size", "fim_text")
    made = fim.transform(docs)
    assert made.columns == [*docs.columns, "_fim_text", "fim_form"] and made.count() == len(awkward())
    told = made.drop("fim_text").withColumnRenamed("_fim_text", "fim_text")
    back = {(r.doc_id, r.text) for r in fim.restore(told).collect()}
    assert back == {(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()}
    assert fim.transform(no_docs(spark)).count() == 0 and fim.digest(no_docs(spark)).count() == 0


def test_rates_forms_and_sentinels(spark):
    docs = spark.createDataFrame([(i, f"line {i}\nsecond\nthird\n") for i in range(400)], "doc_id long, text string")
    half = {r.fim_form: r.n for r in fim.transform(docs, rate=50, spm=0).groupBy("fim_form").agg({"*": "count"}).toDF("fim_form", "n").collect()}
    assert set(half) == {"plain", "psm"} and 140 < half["plain"] < 260
    own = fim.transform(docs, sentinels=("{pre}", "{mid}", "{suf}"))
    assert own.where("fim_text LIKE '%{mid}%'").count() == 400
    assert fim.restore(own, ("{pre}", "{mid}", "{suf}")).join(docs, ["doc_id", "text"]).count() == 400
    for bad in (("a", "a", "b"), ("<P>", "<M>", ""), ("<P<", "<M>", "<S>")):
        with pytest.raises(ValueError):
            fim.transform(docs, sentinels=bad)


def test_pieces_share_the_buffer():
    text = b"0123456789"
    pieces = fim.PieceTable(text, (b"<P>", b"<M>", b"<S>"))
    pieces.cut(2, 2)
    assert pieces.pieces == [(0, 0, 2), (0, 2, 0), (0, 2, 8)]
    pieces.arrange(fim.ORDERS["spm"])
    assert pieces.joined() == b"<S>23456789<P>01<M>" and pieces.digest() == sha(pieces.joined())
    assert all(part.obj in (text, b"<P>", b"<M>", b"<S>") for part in pieces.stream())
    pieces.restore(fim.ORDERS["spm"])
    assert pieces.joined() == text and pieces.pieces == [(0, 0, 2), (0, 2, 0), (0, 2, 8)]


def test_a_megabyte_of_lines():
    text = "".join(f"{i}\n" for i in range(150_000))
    start = time.perf_counter()
    n, form, *_, pieces = fim.Transformer().arranged(5, text)
    assert n == 150_000 and fim.Transformer().rebuilt(pieces.joined(), form).digest() == sha(text)
    assert time.perf_counter() - start < 2


IDS = (2**53 + 1, None, 2**53 + 2, 2**60 + 1, 5)


def wide_docs(spark):
    """Ids beside a null that no double holds, in one batch."""
    rows = [(i, f"text number {k} with mail a{k}@b.org and some more words", "en", "s") for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


@pytest.mark.parametrize(
    "made",
    [
        pii.find_spans,
        pii.redact,
        lambda d: langid.identify(d, langid.fit(d)),
        lambda d: toxicity.score(d, toxicity.Model(0.0)),
        lambda d: toxicity.drop_toxic(d, toxicity.Model(0.0)),
        lambda d: suffixes.dedup(d, keep_bytes=False),
        simhash.components,
        simhash.drop_copies,
        bpe.encode,
        bpe.digest,
        ctph.fingerprints,
        ctph.compare_with_next,
        fim.digest,
        fim.transform,
    ],
)
def test_ids_are_exact_beside_a_null(spark, made):
    assert sorted(str(r.doc_id) for r in made(wide_docs(spark)).collect()) == sorted(map(str, IDS))


@pytest.mark.parametrize("unit", ["http://", "token=", "password: ", "a@b.", "1.", "+1(", "account 1"])
def test_personal_data_in_linear_time(unit):
    scanner = pii.Scanner(pii.anchors())
    start = time.perf_counter()
    scanner.spans(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - start < 10


def test_secrets_after_an_inner_cue():
    scanner = pii.Scanner(pii.anchors())
    text = "password=abctoken= hunter2x secret:'quoted1' token==weird12 api_key:   spaced1"
    found = [text[a:b] for k, a, b in scanner.spans(text) if k == "secret"]
    assert found == ["abctoken=", "hunter2x", "quoted1", "=weird12", "spaced1"]


def test_labels_of_one_kind_reject_nothing(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).where("score = 1").count() == len(awkward())
    assert toxicity.drop_toxic(docs, model).count() == len(awkward())


def test_languages_without_a_limit_and_from_whole_texts(spark):
    rows = random.Random(3)
    words = {lang: ["".join(rows.choices(letters, k=5)) for _ in range(30)] for lang, letters in (("a", "abcdef"), ("b", "uvwxyz"))}
    texts = []
    for i in range(60):  # the first 3,000 characters tell nothing
        lang = "ab"[i % 2]
        texts.append((i, "1234 " * 600 + " ".join(rows.choices(words[lang], k=40)), lang))
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    found = langid.identify(docs, langid.fit(docs)).join(docs, "doc_id")
    assert found.where("lang <> lang_pred").count() == 0
    many = spark.createDataFrame([(i, f"text {chr(97 + i % 26)}", f"l{i}") for i in range(1100)], "doc_id long, text string, lang string")
    assert len(langid.fit(many).languages) == 1100


def test_one_row_of_repeats_that_differ_elsewhere(spark):
    rows = [(1, "the same text in every row of this table", f"s{i}") for i in range(6)]
    kept = {
        simhash.drop_copies(spark.createDataFrame(rows[k:] + rows[:k], "doc_id long, text string, source string").repartition(3)).first().source
        for k in range(3)
    }
    assert kept == {"s0"}


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def plain_fingerprint(text):
    """Context-triggered pieces byte by byte, with whole integers; written from the description of the method."""
    data, whole = text.encode(), 2**64
    if not data:
        return "0:A"
    roll, mix = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15
    level = []
    for i in range(len(data)):
        h = sum((data[i - k] + 1) * roll ** (k + 1) for k in range(min(7, i + 1))) % whole
        h = (h ^ h >> 32) * mix % whole
        h ^= h >> 29
        ones = 0
        while h >> ones & 1:
            ones += 1
        level.append(ones)

    def digits(bits):
        out, piece = [], 0
        start = 0
        for i, byte in enumerate(data):
            piece = (piece + (byte + 1) * pow(mix, i - start, whole)) % whole
            if level[i] >= bits or i == len(data) - 1:
                d = (piece ^ piece >> 31) * roll % whole >> 58
                out.append(d)
                piece, start = 0, i + 1
        return thinned(out)

    def thinned(found):
        """Of a run of equal digits three stay, as the operator counts them."""
        return [d for i, d in enumerate(found) if i < 3 or len(found) < 4 or not (found[i] == found[i - 1] == found[i - 2] == found[i - 3])]

    e = next(b for b in range(66) if sum(x >= b for x in level) <= 64)
    found = digits(e)
    while e and len(found) <= 32 and len(finer := digits(e - 1)) <= 65:
        e, found = e - 1, finer
    parts, bits = [], e
    while bits == e or len(found) >= 8:
        parts.append("".join(ALPHABET[d] for d in found))
        bits += 1
        found = digits(bits)
    return ":".join([str(e), *parts])


def test_fingerprints_against_whole_integers():
    rows = random.Random(12)
    maker = ctph.Fingerprinter()
    texts = ["", "a", "aaaa" * 30, "é" * 50, "one two three"]
    texts += ["".join(rows.choices("abc de.\n", k=rows.randint(1, 1500))) for _ in range(60)]
    for text in texts:
        assert maker.fingerprint(text) == plain_fingerprint(text), text[:80]


def test_the_plan_of_neighbours_has_one_size(spark):
    docs = spark.range(4000).selectExpr("id * 7 AS doc_id", "repeat('word ', 20) AS text")
    few, many = (ctph.neighbour_ranges(docs, chars)._jdf.queryExecution().executedPlan().toString() for chars in (100_000, 500))
    assert len(many.splitlines()) == len(few.splitlines()) and len(many) < 1.2 * len(few)
