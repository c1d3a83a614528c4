"""Formats, rounding and safe division."""

import pytest
from pyspark.sql import functions as F

from tillwise.functions import dates, numbers, text


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("new, old, want", [
    (110.0, 100.0, 10.0), (50.0, -100.0, 150.0), (1.0, 0.0, None), (1.0, None, None), (None, 1.0, None), (2.0, 3.0, -33.33),
])
def test_safe_change(spark, new, old, want):
    assert value(spark, numbers.safe_pct_change(F.lit(new).cast("double"), F.lit(old).cast("double"))) == want


@pytest.mark.parametrize("x, digits, want", [(2.675, 2, 2.68), (-2.675, 2, -2.68), (0.5, 0, 1.0), (1.005, 2, 1.01)])
def test_halves_round_away_from_zero(spark, x, digits, want):
    assert value(spark, numbers.rounded(F.lit(x), digits)) == want


def test_division_by_zero_is_missing(spark):
    assert value(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, numbers.percent_of(F.lit(0), F.lit(0), 1)) is None


@pytest.mark.parametrize("x, want", [
    (17136417.63, "€17.136.417,63"), (1707.65, "€    1.707,65"), (0.0, "€        0,00"), (3024008734.24, "€3.024.008.734,24"), (None, "N/A"),
])
def test_euro(spark, x, want):
    assert value(spark, text.euro(F.lit(x).cast("double"))) == want


@pytest.mark.parametrize("x, signed, want", [(52.8, True, "+52.8%"), (-3.0, True, "-3.0%"), (0.0, True, "0.0%"), (63.3, False, "63.3%"), (None, True, "N/A")])
def test_percent(spark, x, signed, want):
    assert value(spark, text.percent(F.lit(x).cast("double"), signed)) == want


@pytest.mark.parametrize("x, want", [(8548, "8.548"), (500, "500"), (1234567, "1.234.567")])
def test_whole(spark, x, want):
    assert value(spark, text.whole(F.lit(x))) == want


@pytest.mark.parametrize("x, want", [(1_250_000.0, "€1.3M"), (-2e6, "€-2.0M"), (3499.0, "€3K"), (5.4, "€5"), (999.0, "€999")])
def test_magnitude(spark, x, want):
    assert value(spark, text.magnitude(F.lit(x))) == want


@pytest.mark.parametrize("x, want", [("x" * 18, "x" * 18), ("x" * 19, "x" * 18 + "…"), ("", "")])
def test_shorten(spark, x, want):
    assert value(spark, text.shorten(F.lit(x))) == want


@pytest.mark.parametrize("day, quarter, label, month", [
    ("2024-01-01", "Q1", "2024Q1", "January 2024"), ("2024-06-30", "Q2", "2024Q2", "June 2024"),
    ("2024-09-30", "Q3", "2024Q3", "September 2024"), ("2023-12-31", "Q4", "2023Q4", "December 2023"),
])
def test_dates(spark, day, quarter, label, month):
    d = F.lit(day).cast("date")
    assert value(spark, dates.quarter_of_year(d)) == quarter
    assert value(spark, dates.quarter_label(d)) == label
    assert value(spark, dates.long_month(d)) == month
    assert value(spark, dates.month_label(dates.month_start(d))) == day[:7]
    assert value(spark, dates.is_fourth_quarter(d)) == (quarter == "Q4")


def test_headings(spark):
    assert text.titled(spark.range(1).select(F.lit(1).alias("abc_class"))).columns == ["Abc Class"]
