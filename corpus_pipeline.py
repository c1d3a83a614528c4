"""The corpus pipeline: from documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as the next
stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import copies, crf, mixing, ngram_join, slack
from tillwise.llm.shipping import let_go, ship
from tillwise.session import durable, tune

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 0


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labels of rows that are not held out, scores at 0.7 or more."""
    labels = ship(tune(spark)).read.parquet(f"{sf_dir}/labels.parquet")
    model = crf.fit_quality(docs, labels.filter(~crf.held_out("doc_id", 4, 2)))
    return crf.accepted(docs, model, threshold=0.7)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return copies.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a Jaccard similarity of 0.8 of five-word shingles."""
    ship(tune(spark))
    return ngram_join.one_of_each(docs, ngram_join.Similarity(words=5, percent=80))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in sequences of 2,048."""
    ship(tune(spark))
    # the stages before have grown the executors' heaps, so the workers keep fewer words
    return slack.packed(docs, TOKENIZER, END_ID, words=1 << 18)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
        let_go(spark)
    return STAGES[-1][1](spark, docs, sf_dir)


# A fitted classifier, sequences numbered by groups of pieces and token ids are beyond SQL; tests/llm check the stages.
ORACLE_SQL = None
