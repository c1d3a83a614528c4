"""Calendar helpers. A month is the DATE of its first day and becomes text only on output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(date: Column | str) -> Column:
    return F.trunc(_col(date), "MM").cast("date")


def month_label(date: Column | str) -> Column:
    """2024-03"""
    return F.date_format(_col(date), "yyyy-MM")


def short_month(date: Column | str) -> Column:
    """Mar 24"""
    return F.date_format(_col(date), "MMM yy")


def axis_month(date: Column | str) -> Column:
    """Mar 2024"""
    return F.date_format(_col(date), "MMM yyyy")


def long_month(date: Column | str) -> Column:
    """March 2024"""
    return F.date_format(_col(date), "MMMM yyyy")


def quarter_of_year(date: Column | str) -> Column:
    """Q1 to Q4, from the month number."""
    number = F.month(_col(date))
    return (
        F.when(number.between(1, 3), "Q1")
        .when(number.between(4, 6), "Q2")
        .when(number.between(7, 9), "Q3")
        .otherwise("Q4")
    )


def quarter_label(date: Column | str) -> Column:
    """2024Q1"""
    d = _col(date)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def month_index(date: Column | str) -> Column:
    """Months counted through, so that neighbours differ by one."""
    d = _col(date)
    return F.year(d) * 12 + F.month(d)


def is_fourth_quarter(date: Column | str) -> Column:
    return F.month(_col(date)).isin(10, 11, 12)


def in_period(date: Column | str, start: dt.date | str | None = None, end: dt.date | str | None = None) -> Column:
    """Inclusive date range, open at a side that is not given, in a form that reaches the Parquet scan."""
    inside = F.lit(True)
    if start is not None:
        inside = _col(date) >= F.lit(str(start)).cast("date")
    if end is not None:
        before_end = _col(date) <= F.lit(str(end)).cast("date")
        inside = before_end if start is None else inside & before_end
    return inside
