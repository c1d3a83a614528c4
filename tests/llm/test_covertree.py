"""Vector codes against Lloyd's rounds by brute force."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillwise.llm import covertree


def nearest(parts, book):
    square = ((parts[:, None] - book) ** 2).sum(2)
    return square.argmin(1), square.min(1)


def expected(rows, parts=16, entries=64, rounds=2):
    """rows (vec_id, vector, label), all vectors of one length; (vec_id, code, error, label_error) and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(256 * x) for x in r[1]]))
    data = np.array([[math.floor(256 * x) for x in r[1]] for r in kept], np.int64)
    edges = covertree.cuts(data.shape[1], parts)
    split = [data[:, a:b] for a, b in zip(edges, edges[1:])]
    books = [part[:entries].copy() for part in split]
    for _ in range(rounds):
        for part, book in zip(split, books):
            label, _ = nearest(part, book)
            for e in set(label.tolist()):
                chosen = part[label == e]
                book[e] = chosen.sum(0) // len(chosen)
    found = [nearest(part, book) for part, book in zip(split, books)]
    errors = sum(square for _, square in found)
    codes = ["".join(f"{label[i]:02x}" for label, _ in found) for i in range(len(kept))]
    per_label = {}
    for r, error in zip(kept, errors):
        per_label[r[2]] = per_label.get(r[2], 0) + int(error)
    return sorted([(r[0], c, int(e), per_label[r[2]]) for r, c, e in zip(kept, codes, errors)], key=str), books


def coded(spark, data, partitions=3, **more):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' AS id", "0 AS length", "'y' AS code", "'z' AS error", "1 AS part")
    out, books = covertree.vector_codes(df.repartition(partitions), **more)
    return sorted(map(tuple, covertree.with_label_errors(out).select("vec_id", "code", "error", "label_error").collect()), key=str), books


def random_rows(n, length=32, seed=5, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(9, length))
    return [(i, (middles[i % 9] + spread * rng.normal(size=length)).tolist(), i % 4 if i % 7 else None) for i in range(n)]


@pytest.mark.parametrize("rows, leaf", [(8192, 16), (50, 4), (7, 1)])
def test_equals_brute_force_whatever_the_blocks(spark, spread, rows, leaf):
    data = random_rows(400)
    want, books = expected(data)
    got, mine = coded(spark, data, rows=rows, leaf=leaf)
    assert got == want
    assert all((a == b).all() for a, b in zip(mine[32], books)) and len(mine) == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(90, 16) + [(200, None, 1), (201, [None] + [0.0] * 15, 1), (202, [nan] * 16, None), (203, [inf] + [1.0] * 15, 2), (None, [0.5] * 16, 3)]
    rows += [(5, [0.25] * 16, 1), (5, [0.25] * 16, 1), (300, [0.0] * 16, None), (301, [-0.001] * 16, None)]
    assert coded(spark, rows)[0] == expected(rows)[0]


def test_few_vectors_and_an_empty_table(spark):
    rows = random_rows(5, 16)
    assert coded(spark, rows)[0] == expected(rows)[0]
    assert all(error == 0 for _, _, error, _ in coded(spark, rows)[0])
    assert coded(spark, [])[0] == []


def test_one_vector_for_a_third_of_the_rows(spark, spread):
    rows = random_rows(300) + [(1000 + i, [0.125] * 32, 1) for i in range(150)]
    assert coded(spark, rows, rows=64)[0] == expected(rows)[0]


def test_lengths_have_codebooks_of_their_own(spark):
    short, odd = random_rows(80, 16), [(500 + i, v, 9) for i, v, _ in random_rows(70, 19, seed=8)]
    got, books = coded(spark, short + odd + [(900, [], 8)])
    want = expected(short)[0] + expected(odd)[0] + [(900, "00" * 16, 0, 0)]
    assert got == sorted(want, key=str) and sorted(books) == [0, 16, 19]
    assert covertree.cuts(19, 16) == [0, 2, 4, 6, *range(7, 20)]


def test_huge_components_are_held(spark):
    rows = random_rows(70, 16) + [(100, [1e300] + [-1e300] * 15, 1)]
    limit = covertree.LARGEST / 256
    assert coded(spark, rows)[0] == expected([(i, [max(-limit, min(limit, x)) for x in v], label) for i, v, label in rows])[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(-40, 40), st.integers(-3, 3)), min_size=1, max_size=120), st.integers(1, 12), st.integers(1, 9))
def test_tree(points, entries, leaf):
    points = np.array(points, np.int64)
    tree = covertree.CoverTree(points, leaf)
    book = points[:entries].copy() + 1
    sums, number, label, _ = tree.assign(book)
    want, _ = nearest(points[tree.order], book)
    assert sorted(tree.order) == list(range(len(points))) and (label == want).all()
    assert (number == np.bincount(want, minlength=len(book))).all()
    assert all((sums[e] == points[tree.order][want == e].sum(0)).all() for e in range(len(book)))
    for a, b, centre, radius, total in zip(tree.first, tree.end, tree.centre, tree.radius, tree.sums):
        assert (np.sqrt(((tree.points[a:b] - centre) ** 2).sum(1)) <= radius + 1e-9).all() and (tree.points[a:b].sum(0) == total).all()


def test_centres_of_a_level_are_apart_and_cover():
    points = np.random.default_rng(3).integers(-500, 500, (600, 3))
    centres, found, _, _ = covertree.farthest_first(points, 600)
    for i in range(3, 10):
        chosen = points[centres[found > 4**i]]
        apart = np.sqrt(((points[:, None] - chosen) ** 2).sum(2))
        between = np.sqrt(((chosen[:, None] - chosen) ** 2).sum(2)) + np.eye(len(chosen)) * 1e9
        assert apart.min(1).max() <= 2**i and between.min() > 2**i


def test_subtrees_are_assigned_whole():
    """With tight groups of points most are never compared, and none with all entries."""
    rng = np.random.default_rng(1)
    middles = rng.integers(-2000, 2000, (40, 4))
    points = middles[rng.integers(0, 40, 8000)] + rng.integers(-3, 4, (8000, 4))
    tree = covertree.CoverTree(points)
    *_, compared = tree.assign(middles)
    assert compared < 8000


def test_what_a_round_shuffles_does_not_grow_with_the_rows(spark, spread):
    def sums(n):
        df = spark.range(n).selectExpr("id AS vec_id", "transform(sequence(1, 16), i -> (id * i % 97) / 50) AS embedding", "1 AS label").repartition(2)
        clean = covertree.usable(df, "vec_id", "embedding", "label")
        blocks = clean.mapInArrow(covertree._blocks(16, 256, 16), covertree.BLOCKS)
        books = spark.sparkContext.broadcast({16: [np.zeros((64, 1), np.int64) for _ in range(16)]})
        return blocks.mapInArrow(covertree._summed(books), covertree.SUMS).agg(F.count("*")).first()[0]

    assert sums(500) == sums(3000)
