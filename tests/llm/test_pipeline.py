"""The pipeline, stage by stage, against plain Python, and the registered queries of the package."""

import re

import duckdb
import pytest
from compare import TABLES, differences

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tillwise.llm import crf, ngram_join
from tillwise.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = out[name] = spark.read.parquet(str(folder / name))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns_stay(stages):
    for name in ("quality", "exact_dedup", "near_dedup", "mixing"):
        assert stages[name].columns == stages["documents"].columns and stages[name].count()


def test_quality_keeps_what_scores(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = crf.fit_quality(stages["documents"], labels.filter(~crf.held_out("doc_id", 4, 2)))
    before = texts(stages["documents"])
    score = [crf.quality([(text or "").encode()], model)[0] for _, text in before]
    assert texts(stages["quality"]) == [row for row, s in zip(before, score) if s >= 0.7]


def test_exact_dedup(stages):
    groups = {}
    for doc_id, text in texts(stages["quality"]):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id, text))
    assert texts(stages["exact_dedup"]) == sorted((d, t) for _, d, t in map(min, groups.values()))


def test_near_dedup(stages):
    from test_ngram_join import expected

    rows = texts(stages["exact_dedup"])
    component = {doc_id: c for doc_id, _, c in expected(rows, ngram_join.Similarity(5, 80))}
    assert texts(stages["near_dedup"]) == [row for row in rows if component[row[0]] == row[0]]


def test_mixing_meets_its_targets(spark, stages):
    from test_mixing import plain_targets

    words = lambda t: len((t or "").encode().split())
    source = {r.doc_id: r.source for r in stages["near_dedup"].collect()}
    size, taken, largest = {}, {}, {}
    for doc_id, text in texts(stages["near_dedup"]):
        s = source[doc_id]
        size[s] = size.get(s, 0) + words(text)
        largest[s] = max(largest.get(s, 0), words(text))
    for doc_id, text in texts(stages["mixing"]):
        taken[source[doc_id]] = taken.get(source[doc_id], 0) + words(text)
    for s, target in plain_targets(size).items():
        assert abs(taken.get(s, 0) - target) <= max(1, largest[s] / 2)


def test_packing_holds_every_document(stages):
    from test_tokens import library

    wanted = sorted((d, len(library(t)) + 1) for d, t in texts(stages["mixing"]))
    pieces = stages["packing"].collect()
    assert sum(r.length for r in pieces) == sum(n for _, n in wanted)
    assert sorted(r.doc_id for r in pieces if r.piece == 0) == [d for d, _ in wanted]
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 2048 and len(filled) <= -(-sum(filled.values()) // 2048) + 1


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, stages["packing"].select(columns).collect()))


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) <= set(queries()) and "pipeline" in queries() and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{table}.parquet')")
    assert differences(QUERIES[name](spark, "/root/testdata/sf0.01"), con, ORACLES[name]) is None
