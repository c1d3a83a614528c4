"""Mixing against a plain sharing of the excess and a sort of the hashes."""

import hashlib
import re

import pytest
from odd import ROWS, documents

from tillwise.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    target, open_names, left = {}, set(names), share * sum(sizes.values())
    while open_names:
        total = sum(weight[n] for n in open_names)
        full = {n for n in open_names if left * weight[n] / total >= most * sizes[n]}
        if not full:
            target |= {n: left * weight[n] / total for n in open_names}
            break
        target |= {n: most * sizes[n] for n in full}
        left -= sum(most * sizes[n] for n in full)
        open_names -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, "c": 1000, "d": 3, None: 50}, {"only": 7}, {"a": 0, "b": 10}, {"a": 0}, {"a": 40, "b": 100},
    {f"s{i:02}": (i * 37) % 101 + 1 for i in range(23)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix(spark):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = [(i, "w " * (i * 7919 % 60), "en", f"s{i % 4}" if i % 3 else "hot") for i in range(3000)] + [r for r in ROWS if r[1] != ROWS[6][1]]
    docs = documents(spark, rows)
    got = mixing.mix_sources(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.size) for r in got))) == sorted(str((i, words(t))) for i, t, *_ in rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    target = plain_targets(sizes)
    for source in sizes:
        mine = [r for r in got if r.source == source]
        assert mine[0].target == pytest.approx(target[source]) and mine[0].source_size == sizes[source]
        largest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - target[source]) <= max(1, largest / 2)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
        # nested: who is taken more often has a smaller hash
        hashes = sorted((int(hashlib.md5(str(r.doc_id).encode() if r.doc_id is not None else b"null").hexdigest()[:15], 16), -r.copies) for r in mine if r.size)
        assert [c for _, c in hashes] == sorted(c for _, c in hashes)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got if r.size)


def test_empty_table(spark):
    assert mixing.mix_sources(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [(1, "", "en", "a"), (2, None, None, None)])).count() == 0


def test_rows_of_one_id_go_together(spark):
    got = mixing.mix_sources(documents(spark, [(1, "a b", "en", "x")] * 5 + [(2, "c d", "en", "y")])).collect()
    assert len({r.copies for r in got if r.source == "x"}) == 1
