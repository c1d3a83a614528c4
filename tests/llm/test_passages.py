"""Toxic passages: segments against their definition, scores against labels."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from odd import ROWS, documents

from tillwise.llm import passages as P
from tillwise.llm.queries import op10_toxicity


def by_definition(scores, offset=0):
    """The best contiguous segment, then the same to its left and right."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-9:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    i, j = at
    return by_definition(scores[:i], offset) + [(i + offset, j + offset, best)] + by_definition(scores[j:], offset + j)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1.03, 2.11, 4.57]), max_size=40))
def test_segments_are_the_maximal_ones(gains):
    at = [i for i, g in enumerate(gains) if g]
    got = P.maximal_segments(at, [gains[i] for i in at], 0.77)
    wanted = by_definition([g or -0.77 for g in gains])
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in wanted]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in wanted])


def test_tokens():
    assert P.tokens(b'"Stupid!!"') == ["stupid", "stup-", "stupi-", "stupid-"] and P.tokens(b"***") == []
    counts = P.occurrences(b"Ab ab ab, abcde abcdX")
    assert counts["ab"] == 2 and counts["abcd-"] == 2 and counts[""] == counts["ab"] + counts["abcde"] + counts["abcdx"]


def test_log_odds(spark):
    counts = spark.createDataFrame([("", 100, 900), ("bad", 30, 0), ("the", 10, 90), ("good", 0, 90)], "token string, toxic long, clean long")
    got = {r.token: r for r in P.log_odds(counts).collect()}
    assert got["the"].odds == pytest.approx(0) and got["bad"].z > 4 and got["good"].odds < 0
    y, x = 30 + P.PRIOR * 0.1, P.PRIOR * 0.9
    assert got["bad"].odds == pytest.approx(math.log(y / 100) - math.log(x / 900))
    assert got["bad"].z == pytest.approx(got["bad"].odds / math.sqrt(1 / y + 1 / x))


def test_extreme_values():
    """The constant lambda makes the mean of exp(lambda * score) one over clean words."""
    clean = [(1000, [2.0], [2.0])] * 40 + [(1000, [], [])] * 60
    scale, constant = P.extreme_values(clean)
    words = 100_001
    assert 0.05 < scale <= 1 and 0 < constant <= 1
    if scale < 1:
        assert math.exp(-scale * P.DRIFT) + (40 * math.exp(2 * scale) + math.exp(4 * scale)) / words == pytest.approx(1, abs=1e-6)


@pytest.mark.parametrize("sf, least", [("0.01", 0.9)])
def test_held_out_accuracy(spark, sf, least):
    folder = f"/root/testdata/sf{sf}"
    got = op10_toxicity(spark, folder)
    assert got.count() == 1000
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 60 and np.mean([r.predicted == r.toxic for r in rows]) >= least


def test_passages_of_odd_documents(spark):
    model = P.Toxicity({"idiot": (6.0, 9.0), "trash": (5.0, 9.0), "scum": (5.0, 9.0)}, 1.0, 0.01, 3.0, -4.0)
    got = {r.doc_id: r for r in P.toxic_passages(documents(spark), model).collect()}
    assert got[10].score > 0.5 and [(p.first, p.after) for p in got[10].passages] == [(0, 4)]
    assert all(r.score < 0.5 and not r.passages for i, r in got.items() if i != 10)
    assert P.toxic_passages(documents(spark), model).count() == len(ROWS)
    assert P.toxic_passages(documents(spark, []), model).count() == 0
    none = P.fit_toxicity(documents(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in P.toxic_passages(documents(spark), none).collect()} == {0.0}


def test_one_word_in_a_long_text_counts_less():
    model = P.Toxicity({"idiot": (6.0, 9.0)}, 1.0, 0.01)
    short, long = (model.evidence([(0, 1, 6.0)], n) for n in (10, 10_000))
    assert short > long > 0 or long == 0


def test_every_copy_of_a_passage_is_found(spark):
    model = P.Toxicity({"idiot": (6.0, 9.0), "trash": (5.0, 9.0), "scum": (5.0, 9.0)}, 1.0, 0.01, 3.0, -4.0)
    plain = "word " * 50
    insults = ["You idiot, trash scum!", "you Idiot trash SCUM"] * 3 + ["you idiot trash scum"]
    repeated = "".join(plain + insult + " " for insult in insults)
    ends_dense = "".join(plain + word + " " for word in ("idiot", "trash", "scum") * 2) + plain + "idiot trash scum"
    docs = spark.createDataFrame([(1, repeated), (2, ends_dense), (3, plain + insults[0])], "doc_id long, text string")
    got = {r.doc_id: r for r in P.toxic_passages(docs, model).collect()}
    assert [(p.first, p.after) for p in got[1].passages] == [(54 * i + 51, 54 * i + 54) for i in range(7)]
    assert [(p.first, p.after) for p in got[2].passages][-1] == (356, 359) and got[2].score > 0.5
    # seven equal passages weigh as 1 + log2(7) in the document
    (_, segments, copy), = P._Scanner(model).scan([repeated.encode()])
    assert copy == [1, 2, 3, 4, 5, 6, 7]
    n = len(repeated.split())
    assert model.evidence(segments, n, copy) == pytest.approx((1 + math.log2(7)) * model.evidence(segments[:1], n))


def test_two_partitionings_give_the_same_model(spark):
    """Equal texts with different ids and labels: the smallest id decides, wherever the rows lie."""
    rng = np.random.default_rng(5)
    common, insults = [f"w{i}" for i in range(40)], ["idiot", "moron", "scum"]
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = rng.choice(common, 12).tolist() + (rng.choice(insults, 6).tolist() if toxic else [])
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    for j in range(200):  # copies of texts under other ids, with labels of their own
        rows.append((1000 + 7 * j, rows[j][1]))
        marks.append((1000 + 7 * j, int(j % 3 == 0)))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    models = []
    for order in (1, -1):
        docs = spark.createDataFrame(rows[::order], "doc_id long, text string").repartition(1 if order > 0 else 9)
        models.append(P.fit_toxicity(docs, labels))
    assert models[0].scores and models[0] == models[1]
