"""Growth, rolling means and trend on made-up months."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tillwise.operators import timeseries as ts


def column(df, name):
    return [r[name] for r in df.collect()]


def test_growth_against_rows_before(months):
    g = ts.monthly_growth(months([100, 110, 0, 50] + [100] * 8 + [150, 220]))
    assert column(g, "mom_growth_pct")[:4] == [None, 10.0, -100.0, None]
    assert column(g, "yoy_growth_pct") == [None] * 12 + [50.0, 100.0]
    assert column(g, "quarter")[0] == "2023Q1" and column(g, "quarter")[-1] == "2024Q1"
    assert float(column(g, "cumulative_revenue")[3]) == 260


def test_short_series_has_no_yearly_growth(months):
    assert column(ts.monthly_growth(months([1, 2, 3])), "yoy_growth_pct") == [None] * 3


def test_missing_month_by_row_and_by_calendar(months):
    m = months(range(100, 114), skip=(4,))
    by_row, by_calendar = ts.monthly_growth(m), ts.monthly_growth(m, calendar=True)
    assert column(by_row, "mom_growth_pct")[4] == 1.94  # 105 against 103
    assert column(by_calendar, "mom_growth_pct")[4] is None
    assert column(by_row, "yoy_growth_pct")[-1] == 13.0  # twelve rows back is the first month
    assert column(by_calendar, "yoy_growth_pct")[-2:] == [12.0, 11.88]


def test_half_cents_round_up(months):
    assert column(ts.monthly_growth(months(["388006333.97", "388006333.98"])), "revenue_ma3")[1] == 388006333.98


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=30))
def test_rolling_means_equal_pandas(months, values):
    g = ts.monthly_growth(months(values)).toPandas()
    s = pd.Series(values, dtype=float)
    for width in (3, 6):
        want = s.rolling(width, min_periods=1).mean()
        assert np.allclose(g[f"revenue_ma{width}"], want, atol=0.005001)
    assert [float(x) for x in g["cumulative_revenue"]] == s.cumsum().tolist()


def test_series_keys_keep_series_apart(spark, months):
    from pyspark.sql import functions as F

    two = months([10, 20]).withColumn("shop", F.lit("a")).unionByName(months([5, 20]).withColumn("shop", F.lit("b")))
    assert column(ts.monthly_growth(two, ["shop"]), "mom_growth_pct") == [None, 100.0, None, 300.0]


def test_forecast_continues_the_line(months):
    rows = ts.trend_forecast(months([10, 20, 30]), ahead=3).collect()
    assert [(r["kind"], r["idx"], r["trend"]) for r in rows] == [
        ("fitted", 0, 10.0), ("fitted", 1, 20.0), ("fitted", 2, 30.0),
        ("forecast", 2, 30.0), ("forecast", 3, 40.0), ("forecast", 4, 50.0), ("forecast", 5, 60.0),
    ]
    assert rows[-1]["month"] == dt.date(2023, 6, 1) and rows[-1]["revenue"] is None


def test_bars_have_a_sign(months):
    rows = ts.mom_bars(ts.monthly_growth(months([100, 150, 75, 75]))).collect()
    assert [(r["mom_growth_pct"], r["not_negative"], r["mean_mom_pct"]) for r in rows] == [
        (50.0, True, 0.0), (-50.0, False, 0.0), (0.0, True, 0.0),
    ]


def test_years_meet_on_common_months(months):
    rows = ts.yoy_compare(months([1] * 12 + [2, 0]), 2024).collect()
    assert [(r["month_num"], r["grew"]) for r in rows] == [(1, True), (2, False)]


def test_quarters_and_their_change(months):
    rows = ts.quarter_change(ts.monthly_growth(months([1, 1, 1, 2, 2, 2, 0, 0, 0, 5]))).collect()
    assert [(r["quarter"], float(r["revenue"]), r["change_pct"]) for r in rows] == [
        ("2023Q1", 3, None), ("2023Q2", 6, 100.0), ("2023Q3", 0, -100.0), ("2023Q4", 5, None),
    ]


def test_november_peak_is_the_first_of_equals(months):
    m = months([1] * 10 + [9, 50] + [1] * 10 + [9, 60])
    assert column(ts.november_peak(m), "month") == [dt.date(2023, 11, 1)]
    assert ts.november_peak(months([1, 2])).collect() == []


def test_signals(months):
    values = [100, 110, 121, 100, 150, 160]
    r = ts.trend_signals(ts.monthly_growth(months(values, "2023-07-01"))).first()
    assert float(r["last_month_revenue"]) == 160
    assert r["mom_trend"] == "accelerating"  # 6.67 after -17.36
    assert (r["best_month"], r["worst_month"]) == ("2023-12", "2023-07")  # first of the two at 100
    assert r["volatility_pct"] == round(np.std(values, ddof=1) / np.mean(values) * 100, 1)
    assert r["q4_boost"] is False
    assert r["avg_mom_pct_last3m"] == pytest.approx(round((-17.36 + 50 + 6.67) / 3, 2))


def test_signals_of_a_short_series(months):
    r = ts.trend_signals(ts.monthly_growth(months([5]))).first()
    assert r["mom_trend"] == "slowing" and r["volatility_pct"] is None and r["q4_boost"] is False
    assert r["avg_mom_pct_last3m"] is None and not math.isnan(float(r["last_month_revenue"]))
