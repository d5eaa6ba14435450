"""Operator 3: language identification by error-correcting output codes.

Every language of the labels gets a codeword of `BITS` bits. The words are chosen one after another
among seeded random candidates as the farthest from those chosen. For each bit a linear classifier
over hashed character n-grams (1 to 3 code points, lower case, cut at non-letters) learns the bit of
a document's language; all bits are fitted together by mini-batch gradient steps on the logistic
loss. A text's bits are decoded by loss: the language with the smallest sum of logistic losses
between the margins and its codeword, each bit weighted by the classifier's accuracy on a part of the
sample that it did not learn from. The score is the softmax of the negative losses; a text is
`ambiguous` if the two best languages are closer than `MARGIN` of the total weight.

Fitting uses a bounded sample of whole texts: the rows with the smallest hashes of the id, `PER_LANGUAGE` of
each language at most, fewer where there are so many languages that all would have more than `ROWS`, but
`FEWEST` of each. Every whole text is scored.

Defined cases: null texts and texts without a letter get `und`, score 0; rows with a null language
are not learned from; without any row to learn from every text gets `und`; with one language, that
one, and there is no limit on languages; repeated rows get equal results, of rows to learn from that share id and
language the text that sorts first counts; ties go to the language that sorts first; a text of any length is
counted at once, in memory of some 40 bytes a code point; an empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.llm.common import fold, map_rows, pick, table

BITS = 15
DIM_BITS = 15
#: Rows of the sample: so many a language at most, and so many in all, but some of each language.
PER_LANGUAGE = 1500
ROWS = 6000
FEWEST = 16
EPOCHS = 12
RATE = 2.0
MARGIN = 0.1
SEED = 11

MIX = np.uint64(0x9E3779B97F4A7C15)


def codewords(n: int, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """n rows of +1 and -1, all different, far from each other; for more languages, longer words."""
    bits = max(bits, 2 * int(np.ceil(np.log2(max(n, 2)))) + 3)
    random = np.random.default_rng(seed)
    chosen: list[np.ndarray] = []
    for _ in range(n):
        candidates = random.choice([-1, 1], size=(200, bits))
        if chosen:
            apart = (candidates[:, None, :] != np.array(chosen)[None, :, :]).sum(axis=2).min(axis=1)
            best = candidates[int(np.argmax(apart))]
        else:
            best = candidates[0]
        chosen.append(best)
    return np.array(chosen, np.float32)


def letter_mask(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters: a table over those in the text."""
    seen, where = np.unique(codes, return_inverse=True)
    table_ = np.fromiter((chr(c).isalpha() for c in seen), bool, len(seen))
    return table_[where]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text and their counts; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.float32)
    letters = letter_mask(codes)
    if not letters.any():
        return np.empty(0, np.int64), np.empty(0, np.float32)
    one = np.where(letters, codes, 32).astype(np.uint64)
    one = np.concatenate([[np.uint64(32)], one, [np.uint64(32)]])
    keep = (one[1:] != 32) | (one[:-1] != 32)  # runs of other characters become one space
    one = one[np.concatenate([[True], keep])]
    two = one[:-1] * np.uint64(0x1F1F1F) + one[1:]
    three = two[:-1] * np.uint64(0x1F1F1F) + one[2:]
    shift = np.uint64(64 - DIM_BITS)
    h = np.concatenate([((a + np.uint64(k)) * MIX) >> shift for k, a in enumerate((one, two, three), 1)])
    counts = np.bincount(h.astype(np.int64), minlength=1 << DIM_BITS)
    at = np.flatnonzero(counts)
    values = np.sqrt(counts[at]).astype(np.float32)
    return at, values / np.float32(np.sqrt((values * values).sum()))


class Model:
    """Codewords, linear classifiers and the weights of their bits."""

    def __init__(self, languages: list[str], seed: int = SEED):
        self.languages = languages
        self.code = codewords(len(languages), seed=seed) if languages else np.zeros((0, BITS), np.float32)
        self.weights = np.zeros((1 << DIM_BITS, self.code.shape[1]), np.float32)
        self.bias = np.zeros(self.code.shape[1], np.float32)
        self.trust = np.ones(self.code.shape[1], np.float32)

    def margins(self, text: str) -> np.ndarray | None:
        at, values = grams(text)
        return values @ self.weights[at] + self.bias if len(at) else None

    def fit(self, rows: list[tuple[tuple[np.ndarray, np.ndarray], int]], seed: int = SEED) -> None:
        """Learn from (grams, language) of the sampled rows."""
        random = np.random.default_rng(seed)
        random.shuffle(rows)
        held = rows[: len(rows) // 10] if len(rows) >= 100 else []
        rows = rows[len(held) :]
        for epoch in range(EPOCHS):
            rate = np.float32(RATE / (1 + epoch))
            for i in random.permutation(len(rows)):
                (at, values), y = rows[i]
                word = self.code[y]
                margin = values @ self.weights[at] + self.bias
                step = rate * word / (1 + np.exp(np.clip(word * margin, -30, 30)))
                self.weights[at] += values[:, None] * step[None, :]
                self.bias += np.float32(0.01) * step
        if held:
            right = np.mean([(v @ self.weights[a] + self.bias > 0) == (self.code[y] > 0) for (a, v), y in held], axis=0)
            odds = np.log((right * len(held) + 1) / ((1 - right) * len(held) + 1))
            self.trust = np.clip(odds, 0.05, None).astype(np.float32)
        self.trust /= self.trust.mean()

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        margin = self.margins(text) if text and self.languages else None
        if margin is None:
            return "und", 0.0, False
        loss = (np.logaddexp(0, -self.code * margin[None, :]) * self.trust[None, :]).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss).astype(np.float64)
        close = len(order) > 1 and loss[order[1]] - loss[order[0]] < MARGIN * self.trust.sum()
        return self.languages[order[0]], float(1 / share.sum()), bool(close)


def packed(text: str) -> tuple[bytes, bytes]:
    """The n-grams of a whole text: their numbers, and their values in steps of 1 / 255 of the largest."""
    at, values = grams(text)
    top = values.max() if len(at) else 1.0
    return at.astype("<u2").tobytes(), np.ceil(values / top * 255).astype(np.uint8).tobytes()


def unpacked(at: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(values, np.uint8).astype(np.float32)
    return np.frombuffer(at, "<u2").astype(np.int64), v / np.float32(np.sqrt((v * v).sum()))


def fit(learn: DataFrame) -> Model:
    """A model from the rows of (doc_id, text, lang); see above for the sample.

    The sampled texts are read whole, by the tasks; the driver gets three bytes for each of their
    distinct n-grams, of which a text has 2^DIM_BITS at most.
    """
    rows = pick(learn, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())
    model = Model(names)
    if not names:
        return model
    wanted = min(PER_LANGUAGE, max(FEWEST, ROWS // len(names)))
    by = W.partitionBy("lang", "slot").orderBy("k", "doc_id")
    slots = 16  # a language is ranked in parts, so that a frequent one is no single task
    keyed = rows.selectExpr("lang", "doc_id", f"xxhash64({SEED}, doc_id) AS k").distinct().selectExpr("*", f"pmod(k, {slots}) AS slot")
    chosen = keyed.withColumn("nth", F.row_number().over(by)).where(f"nth <= {-(-wanted // slots)}")
    chosen = chosen.select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"), "k")
    met = rows.join(F.broadcast(chosen), F.expr("lang = _lang AND doc_id <=> _id"))  # at most the sample's rows
    sample = met.groupBy("lang", "doc_id", "k").agg(F.min("text").alias("text"))  # one text of a repeated id

    def make():
        return lambda _lang, _id, _k, texts: list(zip(*map(packed, texts)))

    found = map_rows(sample, ["lang", "doc_id", "k", "text"], make, "at binary, v binary")
    got = sorted(found.collect(), key=lambda r: (r.k, r.doc_id or 0, r.at, r.v))
    index = {n: i for i, n in enumerate(names)}
    model.fit([(unpacked(r.at, r.v), index[r.lang]) for r in got if r.at])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # its size depends on the languages alone

    def make():
        own = Model([])
        vars(own).update(sent.value)
        return lambda _, texts: [list(c) for c in zip(*map(own.decode, texts))] if texts else [[], [], []]

    return map_rows(docs, ["doc_id", "text"], make, "lang_pred string, score double, ambiguous boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs.where(fold(4) != 2)))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
