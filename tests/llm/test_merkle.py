"""The Merkle manifest against a plain tree in Python."""

import hashlib

import pytest
from odd import ROWS, documents
from pyspark.sql import functions as F

from tillwise.llm import merkle

FIELDS = ("doc_id", "source", "lang", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def proof(nodes, at):
    """Siblings, level by level, as (before, after), and the last node."""
    path = []
    while len(nodes) > 1:
        begin = at - at % 16
        path.append(("".join(nodes[begin:at]), "".join(nodes[at + 1 : begin + 16])))
        nodes, at = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], at // 16
    return path, nodes[0]


def expected(rows, tampered=()):
    """rows (doc_id, text, lang, source); the texts of ids in ``tampered`` are read in lower case."""
    groups = {}
    for doc_id, text, lang, source in rows:
        seen = text.lower() if text and doc_id in tampered else text
        groups.setdefault(source, []).append((doc_id, leaf(doc_id, source, lang, text), leaf(doc_id, source, lang, seen)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        groups[source].sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
    subroots = [proof([m[1] for m in groups[source]], 0)[1] for source in order]
    out = []
    for i, source in enumerate(order):
        for at, (doc_id, node, seen) in enumerate(groups[source]):
            inner, subroot = proof([m[1] for m in groups[source]], at)
            outer, root = proof(subroots, i)
            for before, after in inner + outer:
                seen = h(before + seen + after)
            out.append((doc_id, node, subroot, root, h("".join(a + b for a, b in inner + outer)), seen, seen == root))
    return sorted(out, key=str)


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.select(names).collect()), key=str)


def audit(docs, tampered=(), **more):
    return merkle.audited(docs, {"text": F.lower("text")}, F.coalesce(F.col("doc_id").isin(*tampered, -1), F.lit(False)), fields=FIELDS, **more)


def test_odd_rows(spark):
    assert found(audit(documents(spark), (2, 5, 8))) == expected(ROWS, (2, 5, 8))


def test_empty_table(spark):
    assert audit(documents(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [[(1, "x", "en", "a")], [(1, "x", "en", None), (1, "x", "en", None)], [(2**62 + i, "Same", "en", "a") for i in range(2)] + [(None, "y", "en", "a")]])
def test_small_tables(spark, rows):
    assert found(audit(documents(spark, rows), (2**62,))) == expected(rows, (2**62,))


SIZES = {"a": 1, "b": 15, "c": 16, "d": 17, "e": 256, "f": 257, "g": 900}


def many():
    rows = [(1000 * i + j, f"Text {j}", "en", s) for i, (s, n) in enumerate(SIZES.items()) for j in range(n)]
    return rows + [(10_000 + i, "Alone", None, f"one {i}") for i in range(20)]


@pytest.mark.parametrize("height", [1, 2, 3])  # low superblocks give small tables many levels
def test_sizes_around_a_run_and_a_superblock(spark, spread, height):
    rows = many()
    changed = [doc_id for doc_id, *_ in rows if doc_id % 5 == 0]
    assert found(audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(7), changed, height=height)) == expected(rows, changed)


def test_proofs_hold_alone(spark):
    rows = audit(spark.createDataFrame(many(), "doc_id long, text string, lang string, source string"), (6003,), proofs=True, height=1).collect()
    assert all(merkle.holds(r.leaf, r.places, r.siblings, r.root) for r in rows)
    assert [r.doc_id for r in rows if not r.verified] == [6003]
    assert {h("".join(r.siblings)) == r.proof_sha256 for r in rows} == {True}
    assert not merkle.holds(leaf("other"), rows[0].places, rows[0].siblings, rows[0].root)


def test_a_hot_group_is_spread(spark, spread):
    docs = spark.range(60_000).selectExpr("id AS doc_id", "'x' AS text", "'en' AS lang", "IF(id % 3 = 0, 'hot', concat('s', id % 100)) AS source")
    leaves, *_ = merkle.manifest(docs, fields=FIELDS)
    blocks = leaves.groupBy("grp", F.floor(F.col("at") / 4096)).count().agg(F.max("count")).first()[0]
    assert blocks == 4096
    largest = leaves.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 60_000 / 3


def test_rows_that_are_all_alike_lie_in_several_partitions(spark, spread):
    docs = spark.range(20_000).selectExpr("1 AS doc_id", "'x' AS text", "'en' AS lang", "'a' AS source")
    leaves, *_ = merkle.manifest(docs, fields=FIELDS)
    assert leaves.select(F.countDistinct("at"), F.min("at"), F.max("at")).first() == (20_000, 0, 19_999)
    assert leaves.groupBy(F.spark_partition_id()).count().count() > 2
