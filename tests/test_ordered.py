"""Distributed numbering against plain Python, with many partitions and heavy ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators.ordered import (
    edges_of_counts, exact_quantile, number_rows, rank_bin, running_sum, value_bin,
)


def frame(spark, n, ties, seed=0):
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(n) < 0.4, 7, rng.integers(0, max(1, n // ties), n))
    pdf = pd.DataFrame({"id": rng.permutation(n), "v": values})
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("n", [1, 2, 7, 1003])
def test_row_numbers(spread, n):
    pdf, df = frame(spread, n, 10)
    got = number_rows(df, ["v", "id"]).toPandas().sort_values("row_num")
    want = pdf.sort_values(["v", "id"])
    assert got["row_num"].tolist() == list(range(1, n + 1))
    assert got["id"].tolist() == want["id"].tolist()
    assert set(got["n_rows"]) == {n}


def test_rows_lie_in_several_partitions_although_one_value_is_frequent(spread):
    _, df = frame(spread, 5000, 1)
    sizes = [r["c"] for r in number_rows(df, ["v", "id"]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("c")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 5000 / 3


def test_running_sum_is_exact_and_descending(spread):
    pdf, df = frame(spread, 900, 3)
    money = df.withColumn("m", (F.col("v") + F.lit("0.01").cast("decimal(18,2)")).cast("decimal(18,2)"))
    got = running_sum(money, [F.desc("m"), "id"], "m").toPandas().sort_values("running")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist()
    cents = (want["v"] * 100 + 1).cumsum().tolist()
    assert [int(x * 100) for x in got["running"]] == cents
    assert int(got["total"].iloc[0] * 100) == cents[-1]


@pytest.mark.parametrize("n", [2, 5, 6, 7, 23, 100, 1003])
def test_rank_bins_equal_pandas(spark, n):
    df = spark.range(1, n + 1).select("id", rank_bin(F.col("id"), F.lit(n)).alias("bin"))
    got = [r["bin"] for r in df.orderBy("id").collect()]
    want = pd.qcut(pd.Series(range(1, n + 1), dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


def test_lone_row_has_bin_one(spark):
    assert spark.range(1, 2).select(rank_bin(F.col("id"), F.lit(1)).alias("b")).first()["b"] == 1


@pytest.mark.parametrize("seed", range(4))
def test_grouped_median_equals_pandas(spread, seed):
    pdf, df = frame(spread, 400 + seed, 2, seed)
    pdf["g"] = np.where(pdf["id"] % 3 == 0, "x", np.where(pdf["id"] % 7 == 0, "y", "z"))
    got = {r["g"]: r["q"] for r in exact_quantile(
        spread.createDataFrame(pdf), "v", "id", by=["g"], name="q").collect()}
    assert got == pytest.approx(pdf.groupby("g")["v"].median().to_dict())


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantile_interpolates(spread, p):
    pdf, df = frame(spread, 101, 1)
    assert exact_quantile(df, "v", "id", p).first()[0] == pytest.approx(np.quantile(pdf["v"], p))


def test_quantile_ignores_missing_and_knows_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 8.0)], "id int, v double")
    assert exact_quantile(df, "v", "id").first()[0] == 6.0
    assert exact_quantile(df.filter("id = 1"), "v", "id").first()[0] is None


@pytest.mark.parametrize("seed", range(3))
def test_value_bins_equal_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    days = pd.Series(rng.integers(0, 400, 503))
    df = spark.createDataFrame(pd.DataFrame({"d": days}))
    edges = edges_of_counts(df.groupBy("d").agg(F.count("*").alias("n")), "d", "n", (0.2, 0.4, 0.6, 0.8))
    got = df.crossJoin(edges).select("d", value_bin(F.col("d"), F.col("edges"), 4, reverse=True).alias("s")).toPandas()
    want = pd.DataFrame({"d": days, "s": pd.qcut(days, 5, labels=[5, 4, 3, 2, 1]).astype(int)})
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, want.values))


def test_tied_edges_leave_scores_unused(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(5,), (9,)], "d int")
    edges = edges_of_counts(df.groupBy("d").agg(F.count("*").alias("n")), "d", "n", (0.2, 0.4, 0.6, 0.8))
    got = df.crossJoin(edges).select("d", value_bin(F.col("d"), F.col("edges"), 4, reverse=True).alias("s")).distinct()
    assert {(r["d"], r["s"]) for r in got.collect()} == {(0, 5), (5, 1), (9, 1)}
