"""Exact deduplication against plain Python and SQL."""

import hashlib
import re

import pytest
from odd import CLASHING, ROWS, documents
from pyspark.sql import functions as F

from tillwise.llm import copies


def expected(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", "", text or "")
        groups.setdefault(norm, []).append((doc_id, len(text or "")))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep[0], len(members), (i, n) == keep, sha) for i, n in members]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("content_hash", [copies.md5_128, lambda text: F.lit(0)], ids=["md5", "all collide"])
def test_groups(spark, content_hash):
    assert found(copies.exact_copies(documents(spark), content_hash=content_hash)) == expected(ROWS)


def test_empty_table(spark):
    assert copies.exact_copies(documents(spark, [])).count() == 0
    assert copies.deduplicated(documents(spark, [])).count() == 0


def test_extreme_ids_and_ties(spark):
    rows = [(-(2**63), "a"), (2**63 - 1, "a"), (0, "b "), (5, "b"), (-5, "b ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(copies.exact_copies(docs)) == expected(rows)


def test_deduplicated_keeps_whole_rows_once(spark):
    docs = documents(spark)
    kept = copies.deduplicated(docs)
    assert kept.columns == docs.columns and set(CLASHING) < set(kept.columns)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 6, 7, 8, 9, None, 10], key=str)


def test_no_python_in_the_plan(spark):
    df = copies.exact_copies(documents(spark))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
