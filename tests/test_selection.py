"""Positions found by counting against sorted lists."""

import math
import re
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tillwise.operators import customers, selection
from tillwise.operators.selection import at_positions, bin_ends, bin_of, quantiles
from tillwise.session import durable


def spots(rows, positions):
    ordered = sorted(r for r in rows if r[0] is not None and not (isinstance(r[0], float) and math.isnan(r[0])))
    return {p: ordered[p - 1] for p in positions(len(ordered))} if ordered else None


VALUES = {
    "double": st.one_of(st.none(), st.floats(allow_infinity=False), st.sampled_from([0.0, 1.0, 5e-324, 1e308, -1e308])),
    "bigint": st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1), st.integers(0, 3)),
    "decimal(28,2)": st.one_of(st.none(), st.integers(-(10**26), 10**26).map(lambda c: Decimal(c) / 100), st.integers(0, 3).map(Decimal)),
}


@pytest.mark.parametrize("kind", VALUES)
def test_any_values_and_ties(spark, kind):
    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(VALUES[kind], st.integers(0, 10**12) | st.integers(0, 2)), min_size=1, max_size=60))
    def check(rows):
        df = spark.createDataFrame(rows, f"v {kind}, id bigint").repartition(3)
        every = lambda n: range(1, n + 1)
        found = at_positions(df, {"v": F.col("v")}, "id", every)
        want = spots(rows, every)
        assert (found[("v", ())].spots if want else found) == (want or {})

    check()


@pytest.mark.parametrize("shape", ["even", "one value", "half one value", "powers"])
def test_many_rows_in_few_rounds(spark, monkeypatch, shape):
    n = 20_000
    value = {
        "even": "id * 7919 % 20011", "one value": "5", "half one value": "IF(id % 2 = 0, 7, id)", "powers": "CAST(pow(1.5, id % 100) AS BIGINT)",
    }[shape]
    df = spark.range(n).selectExpr("id", f"CAST({value} AS BIGINT) AS v").repartition(8)
    rounds = []
    monkeypatch.setattr(selection, "local_rows", lambda *a: rounds.append(1) or local(*a))
    found = at_positions(df, {"v": F.col("v"), "w": -F.col("v")}, "id", lambda n: bin_ends(n, 5))
    rows = [(r.v, r.id) for r in df.collect()]
    assert found["v", ()].spots == spots(rows, lambda n: bin_ends(n, 5)) and found["v", ()].rows == n
    assert found["w", ()].spots == spots([(-v, i) for v, i in rows], lambda n: bin_ends(n, 5))
    assert len(rounds) <= 6


local = selection.local_rows


def test_groups_with_a_null_one(spark):
    rows = [(g, float(i * i % 17), i) for i, g in enumerate("aabbbbcc" * 5)] + [(None, 3.0, 100), (None, 4.0, 101), ("d", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, id bigint")
    got = quantiles(df, {"m": F.col("v")}, "id", 0.3, ["g"])
    groups = {g for g, v, _ in rows if v is not None}
    assert {g for _, (g,) in got} == groups
    for g in groups:
        assert got["m", (g,)] == pytest.approx(np.quantile([v for h, v, _ in rows if h == g], 0.3))


def test_empty(spark):
    assert at_positions(spark.range(0), {"v": F.col("id")}, "id", lambda n: [1]) == {}
    assert spark.range(1).select(bin_of(F.lit(1), F.lit(1), None, 5)).first()[0] is None


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 7, 23, 100])
def test_bins_are_those_of_the_ranks(spark, n):
    from tillwise.operators.ordered import number_rows, rank_bin

    df = spark.range(n).selectExpr("id", "id * 3 % 7 AS v").repartition(4)
    order = at_positions(df, {"v": F.col("v")}, "id", lambda n: bin_ends(n, 5))["v", ()]
    got = {r.id: r.b for r in df.select("id", bin_of(F.col("v"), F.col("id"), order, 5).alias("b")).collect()}
    ranked = number_rows(df, ["v", "id"]).select("id", rank_bin(F.col("row_num"), F.col("n_rows")).alias("b"))
    assert got == {r.id: r.b for r in ranked.collect()}


def test_a_row_without_a_key_comes_first(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 6), (2, 1)], "v bigint, id bigint")
    order = at_positions(df, {"v": F.col("v")}, "id", lambda n: [1, 2])["v", ()]
    assert order.spots == {1: (1, -(2**63)), 2: (1, 5)}
    assert [r.b for r in df.select("id", bin_of(F.col("v"), F.col("id"), selection.Order(4, {1: order.spots[1]}), 1).alias("b")).collect()] == [1] * 4


def test_rfm_neither_sorts_nor_copies_its_rows(spark, monkeypatch):
    sums = durable(spark.range(5000).selectExpr(
        "id AS customer_id", "id * 31 % 50 AS total_orders", "CAST(id * 7919 % 100003 AS DECIMAL(28,2)) AS total_revenue",
        "date_add(DATE'2024-01-01', CAST(id % 300 AS INT)) AS last_purchase",
    ))
    monkeypatch.setattr(customers, "durable", None)
    out = customers.rfm_from_sums(sums)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"rangepartitioning|\bSort\b|RangeExchange", plan)
    assert {r.f_score for r in out.select("f_score").distinct().collect()} == {1, 2, 3, 4, 5} and out.count() == 5000
