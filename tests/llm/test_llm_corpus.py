"""Operators that compare documents, and the pipeline, against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from compare import connect, differences
from llm_cases import SF_DIR, awkward, awkward_docs, documents, no_docs, sha, words
from tallybook.llm import line_spread, mixing, mtree, simhash, suffixes, toxicity
from tallybook.llm.components import roots

xxhash = pytest.importorskip("xxhash")


# suffix dedup


def plain_removed(rows, least=50):
    seen = {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        for j in range(len(data) - least + 1):
            seen.setdefault(data[j : j + least], doc_id)
    out = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - least + 1):
            if seen[data[j : j + least]] < doc_id:
                gone[j : j + least] = b"\1" * least
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), spans, sha(kept))
    return out


def digest(rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def test_suffix_dedup_of_random_texts(spark):
    rows = random.Random(8)
    base = "".join(rows.choices("ab ", k=400))

    def part():
        return rows.choice([
            base[rows.randint(0, 300) :][: rows.randint(0, 150)],
            "ab" * rows.randint(0, 60),
            "x" * rows.randint(0, 80),
            "é" * rows.randint(0, 40),
            "".join(rows.choices("abcdefgh ", k=rows.randint(0, 90))),
        ])

    docs = [(i, "".join(part() for _ in range(rows.randint(0, 5)))) for i in range(100)]
    found = suffixes.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = plain_removed(docs)
    assert digest(found) == want and sum(w[1] for w in want.values()) > 3000
    for r in found:
        data, spans = docs[r.doc_id][1].encode(), r.spans
        left = b"".join(data[a:b] for a, b in zip([0, *(s.end for s in spans)], [*(s.start for s in spans), len(data)]))
        assert bytes(r.kept) == left


def test_suffix_dedup_query(spark):
    assert digest(suffixes.query(spark, SF_DIR).collect()) == plain_removed([(i, t) for i, t, _ in documents()])


def test_suffix_pieces_join(spark, monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    whole = [(o + f, n) for o, first, count, *_ in suffixes.runs_of(data, 50) for f, n in zip(first, count)]
    monkeypatch.setattr(suffixes, "PIECE", 100)
    parts = [(o + f, n) for o, first, count, *_ in suffixes.runs_of(data, 50) for f, n in zip(first, count)]
    assert sum(n for _, n in whole) == sum(n for _, n in parts) == 2951 and {a for a, _ in whole} <= {a for a, _ in parts}


def test_suffix_dedup_awkward(spark):
    rows = suffixes.dedup(awkward_docs(spark)).collect()
    assert len(rows) == len(awkward()) and suffixes.dedup(no_docs(spark)).count() == 0
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[8][0].n_removed == by_id[8][0].n_bytes > 0 and by_id[7][0].n_removed < by_id[7][0].n_bytes
    assert len(by_id[6]) == 3 and by_id[None][0].n_removed == 0 and by_id[0][0].n_bytes == 0


# SimHash


def plain_fingerprint(text):
    own = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(own[i : i + 4]).encode(), 42) for i in range(max(1, len(own) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, budget=4):
    """Smallest id reachable, for a list of (id, fingerprint)."""
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                root[find(b)] = find(a)
    least = {}
    for doc_id, f in prints:
        r = find(f)
        least[r] = min(least.get(r, doc_id), doc_id)
    return {doc_id: least[find(f)] for doc_id, f in prints}


def test_simhash_query(spark):
    prints = [(i, plain_fingerprint(t)) for i, t, _ in documents()]
    want = plain_components(prints)
    got = simhash.query(spark, SF_DIR).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in prints}
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("part", [simhash.PART, 20])
def test_trie_join_of_dense_fingerprints(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rows = random.Random(9)
    centers = [rows.getrandbits(64) for _ in range(8)]
    prints = set()
    for _ in range(400):
        f = rows.choice(centers)
        for _ in range(rows.randint(0, 6)):
            f ^= 1 << rows.randrange(64)
        prints.add(f)
    prints = sorted(prints)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in prints]
    links = simhash.links(spark.createDataFrame(signed, "fp long"))
    assert links.count() < 20 * 15 * len(prints)
    found = {r.node % 2**64: r.root for r in roots(links).collect()}
    groups = defaultdict(set)
    for f in prints:
        groups[found.get(f, f - 2**64 if f >= 2**63 else f)].add(f)
    want = defaultdict(set)
    for f, c in plain_components([(f, f) for f in prints]).items():
        want[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (1000, 1001)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)}


def test_simhash_awkward(spark):
    got = simhash.components(awkward_docs(spark)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(awkward()) and by_id[0].fp == by_id[1].fp == by_id[2].fp == 0
    assert by_id[2].component_id == 0 and by_id[6].component_id == 5 and by_id[8].component_id == 7
    kept = simhash.drop_copies(awkward_docs(spark))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == awkward_docs(spark).columns and len(ids) == len(set(ids))
    assert 0 in ids and 1 not in ids and 5 in ids and 6 not in ids
    assert simhash.components(no_docs(spark)).count() == simhash.drop_copies(no_docs(spark)).count() == 0


def plain_likeness(a, b):
    x, y = (set(tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))) if t else set() for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def plain_near(texts, least=0.8):
    """The smallest position that each text reaches over pairs of a Jaccard similarity of `least`."""
    own = [words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    label = list(range(len(own)))
    for i, a in enumerate(own):
        for j in range(i):
            if label[i] != label[j] and plain_likeness(a, own[j]) >= least:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_copies_are_those_of_the_exact_similarity(spark):
    rows = random.Random(21)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = rows.choices(vocabulary, k=60)
    texts = []
    for _ in range(25):  # copies with one to ten words changed, on both sides of 0.8
        base = rows.choices(vocabulary, k=rows.randint(40, 160)) + common
        for changes in (0, 1, 2, 4, 6, 8, 10):
            own = list(base)
            for _ in range(changes):
                own[rows.randrange(len(own))] = rows.choice(vocabulary)
            texts.append(" ".join(own))
    base = rows.choices(vocabulary, k=80)
    for _ in range(40):  # a large group in one bucket, and what only the second round compares
        own = list(base)
        for _ in range(rows.randint(0, 3)):
            own[rows.randrange(80)] = rows.choice(vocabulary)
        texts.append(" ".join(own))
    texts += [None, "", "one", "One", "one two three four five", "one two  three four\nfive"]
    label = plain_near(texts)
    got = simhash.drop_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(label))


def test_copies_without_an_id_are_judged_by_their_text(spark):
    rows = random.Random(5)
    a, b, c, d, e = (" ".join(rows.choices([f"w{i}" for i in range(500)], k=50)) for _ in range(5))
    table = [(None, a), (None, b), (None, b), (None, c), (1, c), (2, d), (2, e), (2, e), (3, d)]
    got = simhash.drop_copies(spark.createDataFrame(table, "doc_id long, text string"))
    assert sorted(got.collect(), key=str) == sorted([(None, a), (None, b), (1, c), (2, d), (2, e)], key=str)


@contextmanager
def checkpoint_files(spark, partitions):
    """How many files each checkpoint has that is written meanwhile, with so many partitions after every exchange."""
    held = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    spark.range(1).checkpoint()
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    old, found = set(folder.iterdir()), []
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield found
        found += [len(list(d.glob("part-*"))) for d in set(folder.iterdir()) - old]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rounds_of_few_edges_are_one_file(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long").checkpoint()
    with checkpoint_files(spark, 40) as found:
        got = {r.node: r.root for r in roots(edges, 200).collect()}
    assert got == {i: 0 for i in range(1, 201)}
    assert len(found) > 3 and set(found) == {1}


def test_copies_of_few_texts_are_few_files(spark, monkeypatch):
    monkeypatch.setattr(simhash.likeness, "SETS", 8)  # so that slices meet too
    rows = random.Random(34)
    texts = []
    for _ in range(4):
        base = rows.choices([f"w{i}" for i in range(900)], k=80)
        for _ in range(30):
            own = list(base)
            for _ in range(rows.randint(0, 6)):
                own[rows.randrange(80)] = rows.choice("abcdef")
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    with checkpoint_files(spark, 40) as found:
        got = sorted(r.doc_id for r in simhash.drop_copies(docs).collect())
    assert got == sorted(set(plain_near(texts)))
    assert len(found) > 10 and max(found) <= spark.sparkContext.defaultParallelism


def test_pipeline_copies_come_from_the_trie(spark, monkeypatch):
    """Without the candidates of the prefix join, the trie of fingerprints still finds what it can: 4 bits, then 0.8 exactly."""
    rows = random.Random(8)
    texts = []
    for _ in range(30):
        own = rows.choices([f"w{i}" for i in range(2000)], k=400)
        texts.append(" ".join(own))
        for changes in (1, 2, 4, 8):
            own = list(own)
            for _ in range(changes):
                own[rows.randrange(400)] = rows.choice("abcdef")
            texts.append(" ".join(own))
    texts += ["one two three four five", "One two three  four five", None, ""]
    fps = [simhash.fingerprint(t, 5) for t in texts]
    label = list(range(len(texts)))
    for i, t in enumerate(texts):
        for j in range(i):
            near = ((fps[i] ^ fps[j]) % 2**64).bit_count() <= simhash.BUDGET
            if near and plain_likeness(words((t or "").lower()), words((texts[j] or "").lower())) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert len(set(label)) < len(texts) - 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(simhash.likeness, "candidates", lambda rows, _: rows.selectExpr("node AS u", "node AS v").limit(0))
    assert sorted(r.doc_id for r in simhash.drop_copies(docs).collect()) == sorted(set(label))


# top-k search


def test_top_k_on_clusters_and_ties(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, 8))
    rows = [(int(i), (centers[i % 5] + 0.05 * rng.normal(size=8)).round(1).tolist(), "x") for i in range(700)]
    rows += [(900, None, None), (901, [float("nan")] * 8, None), (902, [None] * 8, None), (903, [], None), (None, rows[0][1], None)]
    rows += [(950, rows[0][1], "copy"), (950, rows[0][1], "copy")]
    found = defaultdict(list)
    for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    valid = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v, _ in rows if i is not None and i not in (900, 901, 902, 903)]
    for q, x in {i: x for i, x in valid if i % 50 == 0}.items():
        best = sorted((-int(x @ y), i) for i, y in valid if i != q)[:5]
        own = sorted(found[q])
        assert {(v, s) for _, v, s in own} == {(i, -s) for s, i in best}
    assert set(found) == {i for i, _ in valid if i % 50 == 0}


def test_top_k_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert mtree.top_k(spark.createDataFrame([], schema)).count() == 0
    two = mtree.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], schema)).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in two] == [(0, 1, 1)]


def test_tree_prunes_on_clusters():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 8)) * 1000
    x = (centers[np.arange(8000) % 40] + rng.normal(size=(8000, 8))).astype(np.int64)
    tree = mtree.Tree(np.arange(8000), x, float((x * x).sum(axis=1).max()))
    _, made = tree.search(0, x[0], 5)
    assert made < 4000


# line dedup and mixing


def test_line_dedup_keeps_the_first(spark):
    docs = line_spread.drop_boilerplate(awkward_docs(spark), counts=True)
    got = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == len(awkward()) and set(awkward_docs(spark).columns) <= set(docs.columns)
    assert got[10].n_removed == 0 and got[11].text == "own line b" and got[103].text == "site 3"
    assert got[0].text is None and got[0].n_lines == 0 and got[1].n_lines == 1
    assert line_spread.drop_boilerplate(no_docs(spark)).count() == 0


@pytest.mark.parametrize("sites", [2, 5, 40])
def test_line_dedup_near_the_threshold(spark, sites):
    rows = [(d, f"line {k}", f"s{d}") for k in range(30) for d in range(k * 100, k * 100 + 25 + k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = line_spread.drop_boilerplate(docs, min_sites=sites).where("text <> ''").count()
    assert kept == sum(1 if 25 + k >= sites else 25 + k for k in range(30))


def test_mixing_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.allocate(docs).collect()
    assert rows == mixing.allocate(docs.repartition(5)).collect() or sorted(
        (r.doc_id, r.taken) for r in rows
    ) == sorted((r.doc_id, r.taken) for r in mixing.allocate(docs.repartition(5)).collect())
    taken, size, target, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        assert r.size == len(words(r.text)) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    full, total = set(), 1.5 * sum(size.values())
    while True:  # the excess is reshared by weight until no target is above twice its source
        rest = total - sum(2 * size[s] for s in full)
        share = {s: rest * weights[s] / sum(w for t, w in weights.items() if t not in full) for s in size if s not in full}
        over = {s for s, x in share.items() if x > 2 * size[s]}
        if not over:
            break
        full |= over
    for s in size:
        assert abs(target[s] - share.get(s, 2 * size[s])) < 1e-6 * total
        assert abs(taken[s] - target[s]) <= largest[s]


def test_mix_gives_whole_shards(spark):
    docs = awkward_docs(spark)
    planned = mixing.allocate(docs)
    assert planned.count() == len(awkward())
    mixed = mixing.mix(docs, shards=4)
    copies = sum(len(r.draws) for r in planned.collect())
    assert mixed.columns == docs.columns and mixed.count() == copies
    assert mixing.mix(no_docs(spark)).count() == 0


def test_mix_passes_clashing_columns_through(spark):
    rows = [(i, f"one two {i}", "ab"[i % 2], f"x{i}", [i], float(i), f"y{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, Size string, draws array<int>, target double, own_size string")
    mixed = mixing.mix(docs, shards=4)
    assert mixed.dtypes == docs.dtypes
    assert {str(tuple(r)) for r in mixed.collect()} <= {str(tuple(r)) for r in docs.collect()}
    assert mixed.count() > 20


def test_shards_get_exact_quotas(spark):
    quotas = spark.createDataFrame([(1, 70), (2, 0), (3, 31), (4, 7)], "nth int, draws int")
    cuts = {r.nth: r.cuts for r in mixing.shard_cuts(quotas, 8, 3).collect()}
    sizes = np.array([np.diff([*cuts[n], q]) for n, q in ((1, 70), (2, 0), (3, 31), (4, 7))])
    assert (sizes >= 0).all() and sizes.sum(axis=1).tolist() == [70, 0, 31, 7]
    assert set(sizes.sum(axis=0).tolist()) <= {13, 14}


def test_hypergeometric_draws(spark):
    n, total, good, drawn = 20000, 60, 25, 20
    sql = mixing.hypergeometric(f"{total}L", f"{good}L", f"{drawn}L", "u")
    got = Counter(r.x for r in spark.range(n).selectExpr(f"(id + 0.5D) / {n} AS u").selectExpr(f"{sql} AS x").collect())
    mean = sum(k * c for k, c in got.items()) / n
    variance = sum((k - mean) ** 2 * c for k, c in got.items()) / n
    p = good / total
    assert abs(mean - drawn * p) < 0.01
    assert abs(variance - drawn * p * (1 - p) * (total - drawn) / (total - 1)) < 0.05


# SQL and pipeline


@pytest.mark.parametrize("operator", [line_spread, mtree])
def test_against_sql(spark, operator):
    assert differences(operator.query(spark, SF_DIR), connect(SF_DIR), operator.ORACLE_SQL) == []


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = [r for r in docs.collect() if model.score(r.text or "") < 0.5]

    sites, first = defaultdict(set), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        for pos, line in enumerate((r.text or "").split("\n")):
            sites[line].add(r.source)
            first.setdefault(line, (r.doc_id, pos))
    kept = {}
    for r in rows:
        lines = enumerate((r.text or "").split("\n"))
        kept[r.doc_id] = "\n".join(
            t for pos, t in lines if len(sites[t]) < line_spread.MIN_SITES or first[t] == (r.doc_id, pos)
        )
    order = sorted(kept)
    label = plain_near([kept[i] for i in order])  # five words, Jaccard 0.8
    single = {i: kept[i] for k, i in enumerate(order) if label[k] == k}
    deduped = corpus_pipeline.drop_copies(spark, spark.createDataFrame([(i, kept[i]) for i in order], "doc_id long, text string"), SF_DIR)
    assert {r.doc_id: r.text for r in deduped.collect()} == single

    from tallybook.llm.bpe import vocabulary
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    tokens = {i: library.encode(t, add_special_tokens=False).ids for i, t in single.items()}
    source = {r.doc_id: r.source for r in rows}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    counts = Counter(r.doc_id for r in got)
    assert set(counts) <= set(single) and max(counts.values()) <= 2
    assert all(r.exact and list(r.ids) == tokens[r.doc_id] for r in got)
    size = Counter()
    taken = Counter()
    for i, t in single.items():
        size[source[i]] += len(words(t))
        taken[source[i]] += len(words(t)) * counts[i]
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 0.05 * sum(size.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "bpe"]
