"""Operator 1: toxicity by weak supervision.

1. Voters. From a bounded sample of labelled rows, words and word beginnings that stand out in
   toxic texts are found by likelihood ratio and odds and dealt into lexicons, one word's forms into one. Each lexicon is a
   voter, and so are fixed patterns of form (shouting, exclamation marks, repetition and so on).
2. Votes. Every document outside the held-out fold votes; Spark counts the vote patterns, of which
   there are at most 2^voters.
3. Label model. EM over the counted patterns estimates the class share and each voter's accuracy
   given the unseen class. The voters' correlations given the class are then measured as
   conditional mutual information; the maximum spanning tree over those above a threshold joins the
   model, each voter then depending on the class and one other voter, and EM runs again.
4. Classifier. A logistic regression over the words and beginnings learns the label model's
   posteriors on the sample and scores every whole text.

Labels are used only to find the lexicons and to tell which class of the label model is the toxic
one; `PER_CLASS` rows of each class at most, those with the smallest hash of the id, outside the fold.

Defined cases: a null text counts as empty; an empty text gets the classifier's base score; a
document without a label is scored like any other; null labels count as none; without toxic rows
to learn from every score is 0, without clean ones 1, and in both cases `drop_toxic` keeps every document; repeated rows
get equal scores; terms that stand out equally are taken in alphabetic order; a text of any length is scored whole, its
distinct words being held at once; an empty table gives an empty one; extra columns pass through `drop_toxic`, whatever their names.
"""

from __future__ import annotations

import math
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import checkpointed, files_for, filter_rows, fold, map_rows, pick, table

FOLDS = 5
#: Rows of the sample, clean and toxic at most; and in a file.
PER_CLASS = (9000, 3000)
PER_FILE = 1000
LEXICONS = 7
SIZES = (4, 5, 6)
#: Terms kept, the most telling first; a bound on the model, as `PER_CLASS` is one on the sample.
TERMS = 4096
#: For terms that no clean text of the sample has, and for others.
LEAST_ODDS = (2.5, 4.5)
LEAST_RATIO = 16.0
LEAST_SHARE = 0.005
LEAST_GAIN = 0.002
#: A lexicon's terms were chosen as rare in clean texts, so its votes get a prior: so many silent
#: clean texts for each text that votes.
SURE = 2.0
SEED = 5
EDGES = ".,;:!?\"'()[]{}<>*_-«»¿¡"


def words_of(text: str) -> set[str]:
    return {w.strip(EDGES) for w in set(text.lower().split())}


def terms_of(words: set[str]) -> set[str]:
    """Words, and their first letters marked by a star."""
    out = set(words)
    for n in SIZES:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    out.discard("")
    return out


def patterns(text: str) -> list[bool]:
    """Voters on the form of a text."""
    n = max(len(text), 1)
    marks = text.count("!")
    tokens = text.split()
    return [
        len(text) > 20 and text.upper() == text,
        marks * 50 > n,
        len(tokens) > 20 and len(set(tokens)) * 4 < len(tokens),
        text.count("?") * 50 > n,
    ]


PATTERNS = 4


#: The same as terms_of, in SQL.
TERMS_SQL = "array_distinct(concat(filter(words, w -> w <> ''), {}))".format(
    ", ".join(f"transform(filter(words, w -> length(w) > {n}), w -> concat(left(w, {n}), '*'))" for n in SIZES)
)


def standout(rows: DataFrame) -> list[str]:
    """Terms that stand out in the toxic rows of (toxic, words), by likelihood ratio and odds.

    Spark counts the terms; the driver gets those that a share of the toxic rows have.
    """
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    least = max(3, LEAST_SHARE * n)  # a passage that a few texts share is no sign
    terms = rows.selectExpr("toxic", f"explode({TERMS_SQL}) AS term").groupBy("term")
    counts = terms.agg(F.sum("toxic").alias("x"), F.sum(1 - F.col("toxic")).alias("y"))
    odds = f"ln((x + 0.5D) / ({n} - x + 0.5D)) - ln((y + 0.5D) / ({m} - y + 0.5D))"
    often = counts.where(f"x >= {least}").where(f"{odds} >= if(y > 0, {LEAST_ODDS[1]}, {LEAST_ODDS[0]})")

    def part(seen: int, expected: float) -> float:
        return seen * math.log(seen / expected) if seen else 0.0

    ratio = {}
    for term, x, y in often.collect():
        share = (x + y) / (n + m)
        cells = ((x, share * n), (y, share * m), (n - x, (1 - share) * n), (m - y, (1 - share) * m))
        ratio[term] = 2 * sum(part(*c) for c in cells)
    best = [t for t in ratio if ratio[t] >= LEAST_RATIO]
    return sorted(best, key=lambda t: (-ratio[t], t))[:TERMS]


class LabelModel:
    """Class share, and each voter's vote given the class and, where correlated, its parent's vote."""

    def __init__(self, voters: int, lexicons: int):
        self.lexicons = lexicons
        self.parent = [-1] * voters
        self.share = 0.1
        self.tables = np.zeros((voters, 2, 2, 2))  # voter, class, parent's vote, own vote

    def factors(self, votes: np.ndarray) -> np.ndarray:
        """log P(votes, class), a row per pattern."""
        out = np.tile(np.log([1 - self.share, self.share]), (len(votes), 1))
        for v, p in enumerate(self.parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                out[:, y] += np.log(self.tables[v, y, above, votes[:, v]])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        f = self.factors(votes)
        return 1 / (1 + np.exp(np.clip(f[:, 0] - f[:, 1], -500, 500)))

    def maximize(self, votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> None:
        mass = np.stack([counts * (1 - toxic), counts * toxic])
        self.share = float(np.clip(mass[1].sum() / counts.sum(), 1e-6, 1 - 1e-6))
        for v, p in enumerate(self.parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                cells = np.ones((2, 2))
                if y == 0 and v < self.lexicons:
                    cells[:, 0] += SURE * counts.sum()
                np.add.at(cells, (above, votes[:, v]), mass[y])
                self.tables[v, y] = cells / cells.sum(axis=1, keepdims=True)

    def correlate(self, votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> None:
        """The spanning tree of the voters' strongest correlations given the class."""
        n, total = votes.shape[1], counts.sum()
        gains = []
        for i in range(n):
            for j in range(i):
                gain = 0.0
                for mass in (counts * (1 - toxic), counts * toxic):
                    cell = np.full((2, 2), 1e-9)
                    np.add.at(cell, (votes[:, i], votes[:, j]), mass)
                    share = cell / cell.sum()
                    apart = share.sum(axis=1, keepdims=True) * share.sum(axis=0, keepdims=True)
                    gain += cell.sum() / total * float((share * np.log(share / apart)).sum())
                gains.append((gain, i, j))
        group = list(range(n))
        links: dict[int, list[int]] = {v: [] for v in range(n)}
        for gain, i, j in sorted(gains, reverse=True):
            if gain >= LEAST_GAIN and group[i] != group[j]:
                links[i].append(j)
                links[j].append(i)
                group = [group[i] if g == group[j] else g for g in group]
        self.parent = [-1] * n
        seen: set[int] = set()
        for root in range(n):
            stack = [] if root in seen else [(root, -1)]
            while stack:
                v, p = stack.pop()
                seen.add(v)
                self.parent[v] = p
                stack += [(u, v) for u in links[v] if u not in seen]

    def fit(self, votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> None:
        toxic = np.clip(votes[:, : self.lexicons].mean(axis=1) * 2, 0.02, 0.98)
        for tree in (False, True):
            if tree:
                self.correlate(votes, counts, toxic)
            for _ in range(rounds):
                self.maximize(votes, counts, toxic)
                toxic = self.posterior(votes)


class Model:
    """Lexicons, label model and linear classifier."""

    def __init__(self, constant: float = 0.0):
        self.constant: float | None = constant
        self.lexicon: dict[str, int] = {}
        self.weights: dict[str, float] = {}
        self.base = 0.0

    def votes(self, text: str) -> int:
        """The votes as bits, lexicons first."""
        out = 0
        for term in terms_of(words_of(text)) & self.lexicon.keys():
            out |= 1 << self.lexicon[term]
        for i, v in enumerate(patterns(text)):
            out |= int(v) << (LEXICONS + i)
        return out

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        x = self.base + sum(self.weights[t] for t in sorted(terms_of(words_of(text)) & self.weights.keys()))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def bits(patterns_: list[int], voters: int) -> np.ndarray:
    return np.array([[p >> v & 1 for v in range(voters)] for p in patterns_], int).reshape(-1, voters)


def regress(rows: list[list[int]], targets: np.ndarray, n: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features by gradient steps with momentum."""
    at = np.concatenate([np.array(r, int) for r in rows]) if rows else np.empty(0, int)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, base = np.zeros(n), 0.0
    size = np.bincount(at, minlength=n) + 1.0
    move, move_base = np.zeros(n), 0.0
    for _ in range(rounds):
        x = base + np.bincount(row, w[at], len(rows))
        miss = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - targets
        grad = np.bincount(at, miss[row], n) / size + 0.002 * w
        move = 0.9 * move - 0.5 * grad
        move_base = 0.9 * move_base - 0.5 * miss.mean()
        w, base = np.maximum(w + move, 0.0), base + move_base
    return w, float(base)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample: toxic, words, and the votes of the patterns as bits; copies count once."""
    own = pick(labels, "doc_id", "toxic").where(fold(FOLDS) != 0).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    chosen = None
    for toxic in (0, 1):
        part = own.where(F.col("toxic") == toxic).select("doc_id", F.lit(toxic).alias("toxic")).distinct()
        part = part.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(PER_CLASS[toxic])
        chosen = part if chosen is None else chosen.unionByName(part)
    met = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most sum(PER_CLASS) rows

    def make():
        def work(_labels, texts):
            form = [sum(int(p) << i for i, p in enumerate(patterns(t or ""))) for t in texts]
            return [[sorted(words_of(t or "")) for t in texts], form]

        return work

    rows = map_rows(met, ["toxic", "text"], make, "words array<string>, form int")
    return checkpointed(rows.dropDuplicates(["toxic", "words"]), files_for(sum(PER_CLASS), PER_FILE))


def features(rows: DataFrame, found: list[str]) -> list[tuple[int, int, list[int]]]:
    """Of each sampled row the label, the votes of the patterns and which of the terms it has."""
    sent = rows.sparkSession.sparkContext.broadcast(found)  # at most TERMS terms

    def make():
        names = {t: i for i, t in enumerate(sent.value)}

        def work(_labels, _forms, words):
            return [[sorted(names[t] for t in terms_of(set(w)) & names.keys()) for w in words]]

        return work

    got = map_rows(rows, ["toxic", "form", "words"], make, "terms array<int>", left_out="words")
    return sorted((r.toxic, r.form, list(r.terms)) for r in got.collect())


def count_votes(docs: DataFrame, model: Model) -> list[tuple[int, int]]:
    """How many documents outside the held-out fold vote in each way."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # at most TERMS terms

    def make():
        own = Model()
        vars(own).update(sent.value)
        return lambda _, texts: [[own.votes(t or "") for t in texts]]

    votes = map_rows(docs.where(fold(FOLDS) != 0), ["doc_id", "text"], make, "votes int")
    return sorted((r.votes, r["count"]) for r in votes.groupBy("votes").count().collect())


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    chosen = sample(docs, labels)
    found = standout(chosen)
    rows = features(chosen, found)
    truth = np.array([y for y, _, _ in rows], int)
    if not truth.any() or truth.all():
        return Model(1.0 if truth.any() else 0.0)
    model = Model()
    families = list(dict.fromkeys(t[: SIZES[0]] for t in found))  # forms of one word vote once
    dealt = {f: i % LEXICONS for i, f in enumerate(families)}
    model.lexicon = {t: dealt[t[: SIZES[0]]] for t in found}
    counted = count_votes(docs, model)
    voters = LEXICONS + PATTERNS
    label = LabelModel(voters, LEXICONS)
    label.fit(bits([p for p, _ in counted], voters), np.array([c for _, c in counted], float))

    def own_votes(form: int, terms: list[int]) -> int:
        out = form << LEXICONS
        for t in terms:
            out |= 1 << model.lexicon[found[t]]
        return out

    believed = label.posterior(bits([own_votes(f, t) for _, f, t in rows], voters))
    if believed[truth == 1].mean() < believed[truth == 0].mean():
        believed = 1 - believed
    weights, base = regress([t for _, _, t in rows], believed, len(found))
    model.weights = {t: float(w) for t, w in zip(found, weights) if w > 0}
    model.base, model.constant = base, None
    return model


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """doc_id (or the columns in `keep`) and `score`, the probability of toxicity, for every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        own = Model()
        vars(own).update(sent.value)
        return lambda *columns: [[own.score(t or "") for t in columns[-1]]]

    return map_rows(docs, [*(keep or ["doc_id"]), "text"], make, "score double")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model doesn't call toxic, with all their columns.

    A model that could not be learned, for want of labels of one kind, rejects nothing.
    """
    if model.constant is not None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        own = Model()
        vars(own).update(sent.value)
        return lambda texts: [[own.score(t or "") < 0.5 for t in texts]]

    return filter_rows(docs, "text", make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold(FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
