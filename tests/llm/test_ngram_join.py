"""The n-gram join against comparing every pair."""

import random

import numpy as np
import pyarrow as pa
import pytest
from odd import ROWS, documents

from tillwise.llm import ngram_join as N
from tillwise.llm.components import components
from tillwise.llm.words import Words, shingles


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sets_of(rows, size):
    out = []
    for doc_id, text, *_ in rows:
        words = lower(text).encode().split()
        out.append((doc_id, frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))) if words else frozenset()))
    return out


def expected(rows, like):
    sets = sets_of(rows, like.words)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= like.percent * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, a) in enumerate(sets):
        reach = [d for j, (d, _) in enumerate(sets) if find(j) == find(i) and d is not None]
        out.append((doc_id, len(a), (min(reach, default=None) if a else doc_id)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def cluster(seed, bases=6, copies=25, words=60):
    """Texts with copies at many distances, passages that texts share, and short texts."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    passage = [word() for _ in range(40)]
    rows, doc_id = [], 100
    for _ in range(bases):
        base = [word() for _ in range(words)]
        for _ in range(copies):
            text = [w if rnd.random() > rnd.choice([0, 0.01, 0.02, 0.05]) else word() for w in base]
            if rnd.random() < 0.3:
                text = text[: rnd.randrange(3, words)] + passage
            if rnd.random() < 0.1:
                text = passage + [word()]
            rows.append((doc_id, " ".join(text), "en", "a"))
            doc_id += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("like", [N.Similarity(4, 85), N.Similarity(2, 60)])
def test_components_equal_all_pairs(spark, like):
    rows = cluster(like.words) + [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 6)), "en", "b") for i in range(30)]
    assert found(N.ngram_components(documents(spark, rows), like)) == expected(rows, like)


def test_spread_lists(spark, monkeypatch):
    """Lists that go to several tasks, with all shingles common."""
    monkeypatch.setattr(N, "_common", lambda counts: (np.minimum(counts, 5).astype(np.uint8), np.arange(len(counts)), np.full(len(counts), 3)))
    rows = cluster(9, bases=3)
    assert found(N.ngram_components(documents(spark, rows), N.Similarity(3, 80))) == expected(rows, N.Similarity(3, 80))


def test_odd_documents(spark):
    like = N.Similarity(4, 85)
    assert found(N.ngram_components(documents(spark), like)) == expected(ROWS, like)
    assert N.ngram_components(documents(spark, []), like).count() == 0
    kept = N.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, 7, 7, 8, 9, 10, None], key=str)


def test_shingles_are_those_of_the_words():
    texts = ["a b c d e a b c d", "A  b\tc", "", "é É x y z w", "a b c d", "a b c d\n"]
    text, value = shingles(Words.of([t.encode() for t in texts]), 4)
    wanted = [s for _, s in sets_of([(i, t) for i, t in enumerate(texts)], 4)]
    names = {}
    for i, s in enumerate(wanted):
        mine = set(value[text == i].tolist())
        assert len(mine) == len(s) == (text == i).sum()
        names[frozenset(mine)] = s
    assert len(names) == len(set(wanted))
    # the shingle of a short text is none of longer ones
    assert not set(value[text == 1].tolist()) & set(value[text != 1].tolist())


def test_heads_of_lists_in_batches_of_any_size():
    rnd = random.Random(4)
    rows = sorted((rnd.randrange(12), 0, 1, rnd.randrange(3), rnd.randrange(40), 9, rnd.randrange(5)) for _ in range(120))
    rows += [(50, 0, 2, 0, 7, 9, 0), (51, 0, 1, 0, 8, 9, 0)]
    names = ["token", "salt", "spread", "light", "gid", "n", "pos"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]

    def run(size):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + size]), kinds)], names) for i in range(0, len(rows), size)
        ]
        return {(b["token"], b["gid"], b["head"]) for batch in N._with_heads(iter(batches)) for b in batch.to_pylist()}

    whole = run(1000)
    lists = {}
    for token, _, spread, light, gid, *_ in rows:
        lists.setdefault((token, spread), []).append(gid)
    assert whole == {(t, g, members[0]) for (t, spread), members in lists.items() for g in members if len(members) > 1 or spread > 1}
    assert all(run(size) == whole for size in (1, 2, 3, 7, 50))


def test_components_of_a_graph(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(500, 501 + i) for i in range(40)] + [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(90)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_text_without_ids_connects_others(spark):
    words = [f"w{i}" for i in range(100)]
    changed = lambda n: " ".join(f"x{i}" if i < n else word for i, word in enumerate(words))
    # the first and the last are too different, the one between links with both
    rows = [(5, changed(0), "en", "a"), (None, changed(10), "en", "a"), (None, changed(10), "en", "a"), (7, changed(16), "en", "a")]
    rows += [(None, "some other text that has no id at all", "en", "a"), (9, "a text that links with nothing here", "en", "a")]
    like = N.Similarity(4, 80)
    got = found(N.ngram_components(documents(spark, rows), like))
    assert got == expected(rows, like)
    assert {component for doc_id, _, component in got if doc_id in (5, 7)} == {5}


def test_a_hot_list_is_split_at_few_tasks(spark, monkeypatch):
    rows = [(i, f"one hot passage here w{i}", "en", "a") for i in range(700)]
    counts = N.slot_counts(N.utf8(documents(spark, rows).coalesce(2), "doc_id", "text"), 4)
    assert counts.max() >= 700 and counts.sum() == 1400
    monkeypatch.setattr(N, "RUN", 100)
    assert N._common(counts)[2].max() == 8


def test_bounded_tables_are_iterated_in_few_jobs(spark, monkeypatch):
    from tillwise.llm import ngram_join

    parts, plain = [], type(spark.range(0)).toLocalIterator
    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", lambda self, *a, **k: (parts.append(self.rdd.getNumPartitions()), plain(self, *a, **k))[1])
    monkeypatch.setattr(ngram_join, "let_go", lambda spark: None)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
        counts = ngram_join.slot_counts(ngram_join.utf8(docs, "doc_id", "text"), 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert sorted(counts[counts > 0]) == [2, 2, 2] and parts == [4]  # 23 before: a job for each
