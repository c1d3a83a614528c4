"""The line model against enumeration, and its held-out accuracy."""

import itertools

import numpy as np
import pytest
from odd import ROWS, documents

from tillwise.llm import crf
from tillwise.llm.queries import op6_quality

TEXTS = [b"One line.\nANOTHER!! LINE!!\n\na | b | c |", b"", b"\n", b"single", b"x x x x x x\nshort.\nNormal text of a line, with words.\n1234"]


def random_model(seed=0):
    rng = np.random.default_rng(seed)
    return crf.Model(rng.normal(size=(len(crf.OFFSETS), crf.STATISTICS, crf.WIDTH)) * 0.3, rng.normal(size=(2, 2)), 0.4)


def test_marginals_equal_enumeration():
    model = random_model()
    lines = crf.Lines.of(TEXTS)
    assert lines.count.tolist() == [4, 1, 2, 1, 4]
    evidence, got = crf._evidence(lines, model), crf.marginals(lines, model)
    start = 0
    for count in lines.count:
        own = evidence[start : start + count]
        total, good = 0.0, np.zeros(count)
        for labels in itertools.product((0, 1), repeat=int(count)):
            weight = np.exp(sum(e for e, y in zip(own, labels) if y) + sum(model.transition[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            good += weight * np.array(labels)
        assert got[start : start + count] == pytest.approx(good / total)
        start += count


def test_scores_do_not_depend_on_company():
    model = random_model(1)
    together = crf.quality(TEXTS, model)
    assert together == pytest.approx([crf.quality([text], model)[0] for text in TEXTS])
    assert ((together >= 0) & (together <= 1)).all()


def test_quality_is_weighted_by_length():
    model = random_model(2)
    lines = crf.Lines.of(TEXTS[:1])
    good = crf.marginals(lines, model)
    assert crf.quality(TEXTS[:1], model)[0] == pytest.approx((lines.size * good).sum() / lines.size.sum())


def test_fit_learns_and_is_repeatable():
    good = [f"Some words of text number {i}, with a full stop.\nAnd a second line." .encode() for i in range(40)]
    bad = [f"SHOUT!! {i}!! LOUD!! WORDS!!\nTHEY!! GO!! ON!!".encode() for i in range(40)]
    model = crf.fit(good + bad, [1] * 40 + [0] * 40)
    assert crf.quality([b"Another line of words."], model)[0] > 0.7 > 0.3 > crf.quality([b"LOUD!! AGAIN!! HERE!!"], model)[0]
    again = crf.fit(good + bad, [1] * 40 + [0] * 40)
    assert (model.weights == again.weights).all()
    assert crf.quality([b"x"], crf.fit([], []))[0] == 0.5


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = op6_quality(spark, folder)
    assert got.count() == 1000
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 80 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95


def test_odd_documents(spark):
    labels = spark.createDataFrame([(1, 1), (10, 0), (99, 1), (None, 0), (2, None)], "doc_id long, quality int")
    docs = documents(spark)
    model = crf.fit_quality(docs, labels)
    got = crf.scored(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in ROWS), key=str)
    kept = crf.accepted(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    nothing = crf.fit_quality(documents(spark, []), labels)
    assert crf.scored(documents(spark, []), nothing).count() == 0
    assert {r.score for r in crf.scored(docs, nothing).collect()} == {0.5}


def test_the_driver_gets_line_statistics_and_no_texts(spark, monkeypatch):
    """The model is that of the texts, of repeated ids the least one, in any partitioning."""
    rows = [(i, f"Some words of text {i}.\nA second line, {i}." if i % 2 else f"SHOUT!! {i}!!\nLOUD!! WORDS!!") for i in range(60)]
    docs = spark.createDataFrame([*rows, (1, "zzz"), (1, "zzz")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    want = crf.fit([text.encode() for _, text in rows], [i % 2 for i, _ in rows])
    for parts in (1, 7):
        got = crf.fit_quality(docs.repartition(parts), labels)
        assert (got.weights == want.weights).all() and (got.transition == want.transition).all()
    assert crf.fit_quality(docs.limit(0), labels).weights.sum() == 0


def test_accepted_keeps_all_columns_whatever_their_names(spark):
    docs = documents(spark)
    kept = crf.accepted(docs, random_model(), 0.0)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
