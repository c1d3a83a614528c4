"""Divided loads, bucketed sales and sketches of buyers."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from tillwise.operators import marts
from tillwise.operators.daily import DailyRollup
from tillwise.sources import bucketed, quarantine as Q, tables as T

RAW = [
    ("1", "2024-01-05", "1", "1", "2", "20.00", "N", "Online"),
    ("2", "soon", "1", "x", "2", "20.00", "N", "Online"),
    ("3", None, "1", "1", "0", "-1", "N", None),
    (None, None, None, None, None, None, None, None),
    ("4", "2024-01-06", "1", "1", "1", "0", "", "Store"),
]
WANTED = {
    "2": ["unreadable date", "unreadable customer_id"], "3": ["missing date", "missing channel", "quantity below 1", "revenue below 0"],
    None: [f"missing {name}" for name in T.SALES.fieldNames()],
}


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, ", ".join(f"{name} string" for name in T.SALES.fieldNames()))


def test_both_parts_add_up_and_say_why(spark, raw, tmp_path):
    parts = Q.load_checked({"sales": raw}, str(tmp_path))["sales"]
    assert (parts.accepted.rows, parts.rejected.rows) == (2, 3)
    bad = {json.loads(r.raw).get("id"): r.reasons for r in spark.read.parquet(parts.rejected.path).collect()}
    assert bad == WANTED
    good = spark.read.schema(T.SALES).parquet(parts.accepted.path).orderBy("id").collect()
    assert [(r.id, r.date, r.region) for r in good] == [(1, dt.date(2024, 1, 5), "N"), (4, dt.date(2024, 1, 6), "")]


def test_accepted_rows_are_the_table(spark, shop, raw, tmp_path):
    T.save_tables(shop, str(tmp_path))
    Q.load_checked({"sales": raw}, str(tmp_path))
    assert T.load_tables(spark, str(tmp_path)).sales.count() == 2 and T.load_tables(spark, str(tmp_path)).products.count() == 2


@pytest.mark.parametrize("where, rows", [("id = '1'", (1, 0)), ("id = '3'", (0, 1)), ("id = '9'", (0, 0))])
def test_a_part_may_be_empty(spark, raw, tmp_path, where, rows):
    parts = Q.load_checked({"sales": raw.filter(where)}, str(tmp_path))["sales"]
    assert (parts.accepted.rows, parts.rejected.rows) == rows
    assert spark.read.parquet(parts.rejected.path).count() == rows[1] and T.typed(spark.read.schema(T.SALES).parquet(parts.accepted.path), T.SALES).count() == rows[0]


def test_one_scan(spark, raw, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    counted = spark.createDataFrame(raw.rdd.map(lambda row: (seen.add(1), row)[1]), raw.schema)
    Q.load_checked({"sales": counted}, str(tmp_path))
    assert seen.value == len(RAW)


def test_bucketed_sales_are_not_shuffled(spark, tmp_path):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    customers = spark.range(50).selectExpr("id", "'A' AS segment", "'N' AS region", "'Store' AS acquisition_channel")
    sales = spark.range(3000).selectExpr(
        "id", "date_add(DATE'2024-01-01', CAST(id % 90 AS INT)) AS date", "id % 7 AS product_id", "id * 31 % 50 AS customer_id", "1 AS quantity",
        "CAST(id AS DECIMAL(18,2)) AS revenue", "'N' AS region", "'Store' AS channel",
    )
    bucketed.save_bucketed(sales, str(tmp_path / "sales"), "customer_id", 4)
    bucketed.save_bucketed(customers, str(tmp_path / "customers"), "id", 4)
    loaded = bucketed.load_bucketed(spark, str(tmp_path / "sales"), T.SALES, "customer_id", 4)
    people = bucketed.load_bucketed(spark, str(tmp_path / "customers"), customers.schema, "id", 4)
    assert len(list((tmp_path / "sales").glob("*.parquet"))) == 4
    try:
        spark.conf.set(key, "-1")
        out = marts.customer_lifetime_value(T.Tables(None, people, loaded), ordered=False)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SortMergeJoin" in text and re.search(r"SelectedBucketsCount: 4|Bucketed: true", text)
        plain = marts.customer_lifetime_value(T.Tables(None, customers, sales), ordered=False)
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set(key, before)


def test_sketches_are_near(spark, tmp_path):
    sales = spark.range(60_000).selectExpr(
        "id", "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS date", "1 AS product_id", "id * 7919 % 20011 AS customer_id", "1 AS quantity",
        "CAST(1 AS DECIMAL(18,2)) AS revenue", "IF(id % 3 = 0, 'N', 'S') AS region", "'Store' AS channel",
    )
    rollup = DailyRollup(spark, str(tmp_path), sketches=True)
    rollup.merge(sales.filter("date < '2024-01-03'"))
    rollup.merge(sales.filter("date >= '2024-01-03'"))
    for by in ([], [F.col("region")]):
        exact = {tuple(r)[:-1]: r[-1] for r in rollup.unique_buyers(*by, start="2024-01-02").collect()}
        near = {tuple(r)[:-1]: r[-1] for r in rollup.about_buyers(*by, start="2024-01-02").collect()}
        assert exact.keys() == near.keys() and all(abs(near[k] - n) < 0.03 * n for k, n in exact.items())
    with pytest.raises(ValueError):
        DailyRollup(spark, str(tmp_path)).about_buyers()
