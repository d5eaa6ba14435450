"""Near copies among vectors, vector codes, and vectors of several lengths."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest

from compare import connect, differences
from llm_cases import SF_DIR
from tallybook.llm import mtree, near_vectors, vector_codes
from tallybook.llm.buckets import forest, least_reached

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n_links string, x int"


def awkward_vectors(spark):
    """Nulls, values that are no numbers, zeros, repeated rows and ids, clashing columns."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=8).astype(np.float32)
    rows = [(i, (base + 0.02 * rng.normal(size=8)).tolist(), (0, 1, None)[i % 3], "c", "n", 1) for i in range(30)]
    rows += [
        (40, None, 0, None, None, None),
        (41, [], 0, None, None, None),
        (42, [float("nan")] * 8, 0, None, None, None),
        (43, [float("inf")] * 8, 0, None, None, None),
        (44, [None] * 8, 0, None, None, None),
        (45, [0.0] * 8, 0, None, None, None),
        (2**53 + 1, base.tolist(), 0, None, None, None),
        (2**60 + 1, (2 * base).tolist(), 0, None, None, None),
        (None, base.tolist(), 0, None, None, None),
        (3, rows[3][1], 0, "c", "n", 1),
        (3, rows[3][1], 0, "c", "n", 1),
        (3, rows[4][1], 0, "c", "n", 1),
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def plain_links(rows, least=0.98):
    """(vec_id, n_links, component_id, kept) by brute force."""

    def usable(v, label):
        return label is not None and v and all(e is not None and np.isfinite(e) for e in v) and any(v)

    known = [(i, np.array(v, np.float64), label) for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    a, b = [], []
    for m, (i, x, label) in enumerate(known):
        for j, y, other in known[:m]:
            if label == other and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                a.append(i)
                b.append(j)
    low = least_reached(len(rows), np.array(a, int), np.array(b, int))
    links = np.bincount(np.array(a + b, int), minlength=len(rows))
    ids = {}
    for i, r in enumerate(low):
        ids.setdefault(r, []).append(rows[i][0])
    out = []
    for i, (vec_id, *_ ) in enumerate(rows):
        component = min((x for x in ids[low[i]] if x is not None), default=None)
        out.append((vec_id, int(links[i]), component, vec_id is not None and vec_id == component))
    return sorted(out, key=str)


def test_links_of_awkward_vectors(spark):
    rows, vectors = awkward_vectors(spark)
    got = sorted((tuple(r) for r in near_vectors.link(vectors).collect()), key=str)
    assert got == plain_links([r[:3] for r in rows])
    assert near_vectors.link(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("dims", "most"), [(3, 1024), (64, 1024), (64, 16), (100, 16)])
def test_links_against_brute_force(spark, dims, most):
    rng = np.random.default_rng(dims + most)
    rows = []
    for _ in range(12):  # groups around the threshold, chains, and one large group
        base = rng.normal(size=dims)
        for spread in rng.uniform(0.02, 0.35, size=8):
            noise = rng.normal(size=dims)
            rows.append((base + spread * noise * np.linalg.norm(base) / np.linalg.norm(noise)).tolist())
    base = rng.normal(size=dims)
    rows += [(base + 0.05 * rng.normal(size=dims)).tolist() for _ in range(120)]
    rows += [rng.normal(size=dims).tolist() for _ in range(150)] + [rows[0], rows[0], (3 * np.array(rows[1])).tolist(), [1.0]]
    table = [(i, v, i % 2) for i, v in enumerate(rows)]
    vectors = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((tuple(r) for r in near_vectors.link(vectors, most=most).collect()), key=str)
    assert got == plain_links(table)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    errors, bounds = [], []
    for _ in range(40):
        x, q = near_vectors.unit(rng.normal(size=(2, 64)))
        x = near_vectors.unit(np.stack([x, 0.6 * x + 0.8 * q]))
        bands = near_vectors.Bands(1000, 0.98)
        _, code, factors = bands.code(x)
        queries, corners, slack = near_vectors.estimates(x, code, factors)
        found = sum(c @ r.T for r, c in zip(queries, corners)) / len(queries)
        errors.append(float(found[0, 1] - x[0] @ x[1]))
        bounds.append(float(slack[0]))
    assert abs(np.mean(errors)) < 0.03 and all(abs(e) < b for e, b in zip(errors, bounds))


def test_rotations_keep_lengths_and_angles():
    x = np.random.default_rng(2).normal(size=(5, 100))
    for number in (0, 3):
        turned = near_vectors.rotated(x, number)
        assert turned.shape == (5, 128) and np.allclose(turned @ turned.T, x @ x.T)


def test_bands_miss_hardly_any_pair():
    for largest in (1, 100, 10**6, 10**9):
        bands = near_vectors.Bands(largest, 0.98)
        assert (1 - bands.agree**bands.width) ** bands.number <= near_vectors.MISS * 1.0001
        assert largest / 2**bands.width <= near_vectors.BUCKET or bands.width == 4


def test_forests_connect_what_pairs_connect():
    nodes = np.array([5, 9, 5, 7, 3, 11])
    u, v = forest(nodes, np.array([0, 2, 4]), np.array([1, 3, 4]))
    assert sorted(zip(u.tolist(), v.tolist())) == [(7, 5), (9, 5)]


def test_no_limit_on_large_components(spark):
    rows = [(1, [1e30, 0.0, 0.0, 1e-30], 0), (2, [1e30, 1e20, 0.0, 0.0], 0), (3, [-1e300, 0.0, 0.0, 0.0], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert [r.n_links for r in near_vectors.link(vectors).orderBy("vec_id").collect()] == [1, 1, 0]
    assert vector_codes.compress(vectors)[0].count() == 3


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """The codes by exhaustive search, from (vec_id, integers)."""
    width = max(1, -(-max(len(x) for _, x in rows) // parts))
    x = np.array([list(v) + [0] * (width * parts - len(v)) for _, v in rows], np.int64).reshape(len(rows), parts, width)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))[:entries]
    books = x[first].transpose(1, 0, 2).copy()

    def nearest():
        gaps = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return gaps.argmin(axis=2), gaps.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        at, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[at[:, p] == e, p]
                if len(own):
                    books[p, e] = [int(s) // len(own) for s in own.sum(axis=0)]
    return (*nearest(), books)


def test_orchard_search_equals_exhaustive_search():
    rng = np.random.default_rng(8)
    for n, dims in ((1, 4), (7, 1), (256, 4), (200, 16)):
        entries = rng.integers(-60, 60, size=(n, dims))
        entries[n // 2 :] = entries[: n - n // 2]  # equal entries: the lower index wins
        points = rng.integers(-80, 80, size=(500, dims))
        at, far, made = vector_codes.Orchard(entries).nearest(points)
        gaps = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (at == gaps.argmin(axis=1)).all() and (far == gaps.min(axis=1)).all()
    tight = rng.integers(0, 10**5, size=(256, 3))
    _, _, made = vector_codes.Orchard(tight).nearest(tight[rng.integers(0, 256, 400)] + 1)
    assert made < 400 * 120  # near entries, lists end early


def test_codes_of_awkward_vectors(spark):
    rows, vectors = awkward_vectors(spark)
    valid = [(i, [int(np.floor(1024 * float(e))) for e in v]) for i, v, *_ in rows if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    at, errors, books = plain_codes(valid)
    codes, found = vector_codes.compress(vectors)
    want = sorted((str(i), a.tolist(), int(e)) for (i, _), a, e in zip(valid, at, errors))
    assert sorted((str(r.vec_id), list(r.codes), r.error) for r in codes.collect()) == want
    assert (found == books).all()
    back = {r.vec_id: list(r.x) for r in vector_codes.decode(codes, found).collect()}
    place = [i for i, _ in valid].index(7)
    assert back[7] == [int(e) for p in range(4) for e in books[p, at[place, p]]]
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA))[0].count() == 0


def test_codes_of_many_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), (rng.normal(size=12) * 0.1).tolist(), int(i % 3)) for i in rng.permutation(900)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    at, errors, books = plain_codes([(i, [int(np.floor(1024 * e)) for e in v]) for i, v, _ in rows])
    codes, found = vector_codes.compress(vectors)
    assert (found == books).all()
    text = ",".join(str(e) for p in books for entry in p for e in entry)
    assert vector_codes.codebook_digest(found) == hashlib.sha256(text.encode()).hexdigest()
    want = sorted((i, a.tolist(), int(e)) for (i, _, _), a, e in zip(rows, at, errors))
    assert sorted((r.vec_id, list(r.codes), r.error) for r in codes.collect()) == want


@pytest.mark.parametrize("operator", [near_vectors, vector_codes])
def test_against_sql(spark, operator):
    assert differences(operator.query(spark, SF_DIR), connect(SF_DIR), operator.ORACLE_SQL) == []


def test_links_sql_on_planted_copies(spark, tmp_path):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.08) for x in base[i % 6]], i % 2) for i in range(120)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vectors.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert differences(near_vectors.query(spark, str(tmp_path)), con, near_vectors.ORACLE_SQL) == []
    assert vectors.count() > near_vectors.query(spark, str(tmp_path)).where("kept").count()


def test_queries_skip_trees_that_are_too_far(spark):
    rng = np.random.default_rng(10)
    centers = rng.normal(size=(16, 8)) * 50
    rows = [(i, (centers[i % 16] + rng.normal(size=8)).tolist()) for i in range(6000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows}
    visits = []
    real = mtree.routed
    try:
        mtree.routed = lambda *a, **k: visits.append(real(*a, **k)) or visits[-1]
        found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in mtree.top_k(vectors).collect()}
    finally:
        mtree.routed = real
    ids, x = np.array(list(whole)), np.array(list(whole.values()))
    for q in range(0, 6000, 500):
        scores = x @ whole[q]
        best = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != q)[:5]
        assert [found[q, n] for n in range(1, 6)] == [(i, -s) for s, i in best]
    home, rest = (v.count() for v in visits)
    assert home == 120 and rest < 120 * 8  # of 15 other trees or more


def test_top_k_of_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8 if i % 2 else 5).tolist()) for i in range(0, 600, 5)] + [(7, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.floor(256 * np.array(v + [0.0] * (8 - len(v)))).astype(int) for i, v in rows}
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in mtree.top_k(vectors).collect()}
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ y), i) for i, y in whole.items() if i != q)[:5]
        assert [found[q, k] for k in range(1, 6)] == [(i, -s) for s, i in best]
