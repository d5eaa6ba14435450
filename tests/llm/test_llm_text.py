"""Operators that work on one text at a time, against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from llm_cases import awkward, awkward_docs, documents, held, no_docs, sha
from tallybook.llm import bpe, ctph, langid, pii, toxicity

tokenizers = pytest.importorskip("tokenizers")


def plain_spans(text):
    out = []
    for kind, pattern in pii.BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def base_spans(text, scanner=pii.Scanner(pii.anchors())):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in scanner.spans(text) if k in pii.BASE)


def test_pii_equals_the_patterns_on_random_texts():
    rows = random.Random(3)
    parts = ["0123456789", "..", "@ab.", "+ -()", "a1.@", "1.2 -", "4111 1111 1111 1111", "a@b.c@d.e"]
    for _ in range(4000):
        text = "".join(rows.choice(rows.choice(parts)) for _ in range(rows.randint(0, 60)))
        assert base_spans(text) == plain_spans(text), text


def test_pii_query(spark):
    got = {r.doc_id: r for r in pii.query(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text, _ in documents():
        plain = plain_spans(text or "")
        assert got[doc_id].base_sha256 == sha(plain)
        assert got[doc_id].n_email == plain.count("email:")


def test_pii_adds_spans_and_redacts(spark):
    text = "see https://x.org/a?b=1. IBAN: DE89 3704 0044 0532 0130 00, token = 'abcdef123456' and a@b.cd"
    kinds = [k for k, _, _ in pii.Scanner(pii.anchors()).spans(text)]
    assert {"email", "url", "account", "secret"} <= set(kinds)
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r.redacted_text for r in pii.redact(df).collect()}
    assert out[2] is None and "[email]" in out[1] and "a@b" not in out[1] and "DE89" not in out[1]


def test_pii_awkward(spark):
    rows = pii.find_spans(awkward_docs(spark)).collect()
    assert len(rows) == len(awkward()) and pii.find_spans(no_docs(spark)).count() == 0
    assert {s.kind for r in rows for s in r.found} >= {"email", "ip", "card", "phone"}


def plain_tokens(texts):
    library = tokenizers.Tokenizer.from_file(bpe.vocabulary())
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    return ids, [library.decode(i, skip_special_tokens=False) for i in ids]


def test_bpe_equals_the_library_on_random_texts():
    rows = random.Random(4)
    parts = ["a", "b", " ", "  ", "\n", "é", "'s", "1", "<|endoftext|>", "日本", "😀", ".", "the ", "The", "x y", " "]
    texts = ["".join(rows.choices(parts, k=rows.randint(0, 3000))) for _ in range(300)]
    want = plain_tokens(texts)[0]
    for ranks in (None, bpe.ranks_of_vocabulary()):
        ids, exact = bpe.Codec(bpe.vocabulary(), ranks).encode(texts)
        assert [x.tolist() for x in ids] == want
        assert all(exact)


def test_latin_code_points_encode_alike():
    texts = ["".join(chr(c) + " " * (c % 3) for c in range(a, a + 64)) for a in range(0, 0x250, 32)]
    texts += [f"x{chr(c)}y {chr(c)}{chr(c)} 1{chr(c)}" for c in range(0x250)]
    ids, _ = bpe.Codec(bpe.vocabulary(), bpe.ranks_of_vocabulary()).encode(texts)
    assert [x.tolist() for x in ids] == plain_tokens(texts)[0]


def test_bpe_reuses_chunks():
    codec = bpe.Codec(bpe.vocabulary())
    rows = random.Random(5)
    passage = " ".join("".join(rows.choices("abcdefgh", k=6)) for _ in range(2000))
    codec.encode([f"first start {passage}"])
    before = codec.stored
    codec.encode([f"another beginning of it {passage}"])
    assert codec.stored - before < len(passage) // 10


@pytest.mark.parametrize("source", ["table", "awkward"])
def test_bpe_digests(spark, source):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") if source == "table" else awkward_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    ids, back = plain_tokens([r.text or "" for r in rows])
    want = sorted((len(i), sha(",".join(map(str, i))), sha(t)) for i, t in zip(ids, back))
    assert sorted(tuple(r)[1:] for r in bpe.digest(docs).collect()) == want
    assert bpe.digest(no_docs(spark)).count() == 0


def test_bpe_round_trip(spark):
    docs = awkward_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    back = bpe.decode(bpe.encode(docs)).join(docs, "doc_id")
    assert back.where("decoded <> coalesce(text, '')").count() == 0


def plain_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_edit_distance():
    rows = random.Random(6)
    for _ in range(500):
        a, b = ("".join(rows.choices("abc", k=rows.randint(0, 70))) for _ in "ab")
        assert ctph.distance(a, b) == plain_distance(a, b)


@pytest.mark.parametrize("source", ["table", "awkward"])
def test_fingerprints_of_next_documents(spark, source):
    if source == "table":
        docs, rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), documents()
    else:
        docs = awkward_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    rows = sorted(((i, t or "") for i, t, _ in rows), reverse=True)
    got = {r.doc_id: r for r in ctph.compare_with_next(docs).collect()}
    assert len(got) == len(rows)
    maker = ctph.Fingerprinter()
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.fingerprint == maker.fingerprint(text)
        assert r.edited_sha256 == sha(ctph.edited(text, after))
        assert r.near_next == ctph.likeness(r.fingerprint, maker.fingerprint(after))
    if source == "table":
        near = sorted(r.near_edited for r in got.values())
        other = sorted(r.near_next for r in got.values() if r.near_next < 1)
        assert near[len(near) // 10] > 0.4 and other[len(other) * 9 // 10] < 0.2


def test_fingerprints_awkward(spark):
    assert ctph.compare_with_next(awkward_docs(spark)).count() == len(awkward())
    assert ctph.compare_with_next(no_docs(spark)).count() == 0
    one = ctph.compare_with_next(awkward_docs(spark).where("doc_id = 5")).first()
    assert one.near_next == 1.0
    assert ctph.likeness(ctph.Fingerprinter().fingerprint(""), "0:A") == 1.0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    row = found.where("held_out").agg(F.avg(F.expr("if(lang = lang_pred, 1, 0)"))).first()
    assert row[0] > 0.95
    assert all(r.held_out == (held(r.doc_id, 4) == 2) for r in found.collect())


def test_language_awkward(spark):
    docs = awkward_docs(spark)
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert len(got) == len(awkward())
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert by_id[0] == by_id[1] == by_id[2] == "und" and by_id[7] in ("en", "de")
    assert langid.identify(docs, langid.fit(no_docs(spark))).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(no_docs(spark), langid.fit(docs)).count() == 0


def test_codewords_are_apart():
    for n in (2, 4, 20, 200):
        words = langid.codewords(n)
        assert min((words[i] != words[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_toxicity_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.query(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in found) / len(found)
    hits = sum(r.predicted for r in found if r.toxic) / sum(r.toxic for r in found)
    clean = [r for r in found if not r.toxic]
    assert right > 0.95 and hits > 0.75 and sum(r.predicted for r in clean) < 0.03 * len(clean)
    assert all((held(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in found)


def test_label_model_finds_accuracies_and_correlations():
    import numpy as np

    random_ = np.random.default_rng(1)
    truth = random_.random(20000) < 0.2
    votes = np.stack([np.where(truth, random_.random(20000) < a, random_.random(20000) < 0.002) for a in (0.9, 0.8, 0.7, 0.6)])
    votes = np.vstack([votes, votes[3:]]).T.astype(int)  # the last voter repeats the one before
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.LabelModel(5, 5)
    model.fit(patterns, counts.astype(float))
    assert abs(model.share - 0.2) < 0.03
    assert model.parent[3] == 4 or model.parent[4] == 3
    found = model.posterior(votes) > 0.5
    assert (found == truth).mean() > 0.97


def test_toxicity_awkward(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame(
        [(i, None, (0, 1, None)[i % 3]) for i in range(40)] + [(None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).count() == len(awkward())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    none = labels.where("toxic = 0")
    assert toxicity.score(docs, toxicity.fit(docs, none)).where("score <> 0").count() == 0
    assert toxicity.drop_toxic(docs, toxicity.fit(docs, none)).count() == len(awkward())
    assert toxicity.score(no_docs(spark), toxicity.fit(no_docs(spark), labels)).count() == 0
