"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import projections as P
from tillwise.llm.queries import op1_neighbours

SCHEMA = "vec_id long, embedding array<float>, id long, vector string"


def brute(ids, vectors, queries, k):
    out = {}
    for q in queries:
        mine = vectors[ids == q][0]
        score = (vectors * mine).sum(1)
        order = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
        out[q] = [(i, -s) for s, i in order]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def test_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    wanted = brute(ids, vectors, ids[ids % 20 == 0], 20)
    got = {}
    for r in op1_neighbours(spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(wanted)
    hits = 0
    for q, rows in got.items():
        assert [rank for rank, *_ in rows] == list(range(1, 21))
        assert [s for *_, s in rows] == sorted((s for *_, s in rows), reverse=True)
        truth = dict(wanted[q])
        hits += sum(i in truth for _, i, _ in rows)
        for _, i, s in rows:
            assert s == pytest.approx(float(vectors[ids == q][0] @ vectors[ids == i][0]), abs=1e-12)
    assert hits >= 0.9 * 20 * len(wanted)


def test_recall_of_a_structured_block():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    vectors = (centres[rng.integers(0, 40, 6000)] + 0.3 * rng.normal(size=(6000, 32))) * rng.uniform(0.5, 2, (6000, 1))
    block = P.Block(np.arange(6000), vectors, float(np.linalg.norm(vectors, axis=1).max()), 11)
    queries = vectors[:200]
    rows, best, verified = block.search(queries, 10)
    exact = -np.sort(-(queries @ vectors.T), axis=1)[:, :10]
    assert (best >= exact[:, -1:] - 1e-9).mean() >= 0.9
    assert verified < 200 * 6000


def test_every_pair_of_blocks_meets(spread, monkeypatch):
    """Over many partitions, as a large table would be."""
    monkeypatch.setattr(P, "ROWS", 50)
    monkeypatch.setattr(P, "QUERIES", 4)
    rng = np.random.default_rng(8)
    ids, vectors = np.arange(600), np.round(rng.normal(size=(600, 6)), 3)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    got = {}
    for r in P.nearest(frame(spread, rows), F.col("id") % 20 == 0, k=10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    wanted = brute(ids, vectors, ids[ids % 20 == 0], 10)
    assert set(got) == set(wanted) and all(len(mine) == 10 for mine in got.values())
    assert sum(len(got[q] & {i for i, _ in wanted[q]}) for q in wanted) >= 0.9 * 10 * len(wanted)


def test_copies_tie_by_id_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS", 16)
    monkeypatch.setattr(P, "QUERIES", 2)
    same, other = [1.0, 2.0, 3.0], [3.0, 2.0, -1.0]
    rows = [(i, same if i % 3 else other) for i in range(100)] + [(20, same)]
    got = P.nearest(frame(spark, rows), F.col("id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()
    for q in (0, 20, 40, 60, 80):
        mine = [(r.vec_id, r.score) for r in got if r.query_id == q]
        kind = [i for i in range(100) if (i % 3 == 0) == (q % 3 == 0) and i != q]
        assert [i for i, _ in mine] == kind[:5] and {s for _, s in mine} == {14.0}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 1.0]), (6, [2.0, 1.0]), (None, [5.0, 5.0]), (7, [1.0]), (20, None), (40, []), (8, [-1.0, 0.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in P.nearest(frame(spark, rows), F.col("id") % 20 == 0).collect())
    assert got == [(0, 1, 6, 2.0), (0, 2, 8, -1.0)]
    assert P.nearest(frame(spark, []), F.col("id") % 20 == 0).count() == 0
    assert P.nearest(frame(spark, rows[1:6]), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("p, k, value", [(0.95, 12, 21.026), (0.5, 1, 0.4549), (0.99, 6, 16.812), (0.97, 12, 22.742)])
def test_chi_square(p, k, value):
    assert P.chi_square_quantile(p, k) == pytest.approx(value, abs=2e-3)


def test_leaves_hold_every_point_once():
    points = np.random.default_rng(0).normal(size=(1000, 4))
    points[:600] = 1.0
    found = P.leaves(points, 32)
    assert sorted(np.concatenate(found).tolist()) == list(range(1000)) and max(map(len, found)) <= 32


def clustered(n, length=16, per_cluster=50, seed=6):
    """Vectors of one norm in tight clusters, their number growing with n."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // per_cluster, length))
    vectors = centres[np.arange(n) % len(centres)] + 0.02 * rng.normal(size=(n, length))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def test_what_is_sent_grows_with_the_table(spark, monkeypatch):
    """Four times the vectors and queries: a query is sent to about as many blocks, and finds its neighbours."""
    monkeypatch.setattr(P, "ROWS", 100)
    sent, store = [], P.durable

    def spy(df, *more):
        out = store(df, *more)
        if "query" in df.columns:
            sent.append(out.count())
        return out

    monkeypatch.setattr(P, "durable", spy)
    routes = {}
    for n in (2000, 8000):
        vectors = clustered(n)
        sent.clear()
        rows = P.nearest(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), F.col("id") % 20 == 0, k=5).collect()
        routes[n] = sum(sent) / (n / 20)
        single = vectors.astype(np.float32).astype(float)
        queries = np.arange(0, n, 20)
        scores = single[queries] @ single.T
        scores[np.arange(len(queries)), queries] = -2
        fifth = dict(zip(queries.tolist(), np.sort(scores, axis=1)[:, -5]))
        assert len(rows) == 5 * len(queries) and np.mean([r.score >= fifth[r.query_id] - 1e-9 for r in rows]) >= 0.95
    assert routes[8000] < 1.5 * routes[2000] and routes[8000] < 0.25 * 128


def test_every_vector_is_in_one_part_and_a_hot_block_has_several(spread, monkeypatch):
    monkeypatch.setattr(P, "ROWS", 60)
    vectors = np.round(clustered(600, 6), 3)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, [0.5] * 6) for i in range(300)]
    index = P.Index.of(P.usable(frame(spread, rows)), 5)
    parts = index.parts.collect()
    blocks = [P.pickle.loads(r.data) for r in parts]
    assert sorted(i for b in blocks for i in b.ids.tolist()) == sorted(i for i, _ in rows)
    assert max(len(b.ids) for b in blocks) < 2 * 60 and max(r.part for r in parts) >= 4
    numbers, low, high = index.boxes[6]
    for row, block in zip(parts, blocks):
        at = numbers.tolist().index(row.block)
        assert (block.points >= low[at] - 1e-12).all() and (block.points <= high[at] + 1e-12).all()


def test_planes_halve_a_sample():
    points = np.random.default_rng(1).normal(size=(4000, P.DIMENSIONS))
    planes = P.Planes.fitted(points, 13, 1.0)
    sizes = np.bincount(planes.block(points), minlength=16)
    assert planes.levels == 4 and sizes.min() >= 249 and sizes.sum() == 4000
    assert P.Planes.fitted(points[:0], 1, 1.0).block(points).max() == 0
    assert P.Planes.fitted(np.ones((50, P.DIMENSIONS)), 4, 1.0).block(points).max() < 4
