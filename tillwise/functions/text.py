"""Display formats and the shape in which results leave the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwise.functions.numbers import rounded


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _european(x: Column, digits: int) -> Column:
    """1.234,50 from 1234.5"""
    return F.translate(F.format_number(x, digits), ",.", ".,")


def euro(x: Column | str) -> Column:
    """Euro amount, right-aligned in 12 places; N/A if missing."""
    shown = F.format_string("€%12s", _european(rounded(x, 2), 2))
    return F.when(_col(x).isNull(), "N/A").otherwise(shown)


def percent(x: Column | str, signed: bool = False) -> Column:
    """12.3%, with a plus before positive values if ``signed``; N/A if missing."""
    value = rounded(x, 1)
    shown = F.format_string("%.1f%%", value)
    if signed:
        shown = F.concat(F.when(value > 0, "+").otherwise(""), shown)
    return F.when(_col(x).isNull(), "N/A").otherwise(shown)


def whole(x: Column | str) -> Column:
    """Integer with points between thousands; N/A if missing."""
    return F.when(_col(x).isNull(), "N/A").otherwise(_european(_col(x), 0))


def magnitude(x: Column | str) -> Column:
    """€1.2M, €3K or €5 by size."""
    value = _col(x).cast("double")
    return (
        F.when(F.abs(value) >= 1e6, F.format_string("€%.1fM", rounded(value / 1e6, 1)))
        .when(F.abs(value) >= 1e3, F.format_string("€%.0fK", rounded(value / 1e3, 0)))
        .when(value.isNotNull(), F.format_string("€%.0f", rounded(value, 0)))
    )


def shorten(x: Column | str, width: int = 18) -> Column:
    """The text, cut to ``width`` characters and an ellipsis if longer."""
    text = _col(x)
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("…"))).otherwise(text)


def titled(df: DataFrame) -> DataFrame:
    """Headings from column names: total_revenue becomes Total Revenue."""
    return df.toDF(*[name.replace("_", " ").title() for name in df.columns])


def as_reported(df: DataFrame) -> DataFrame:
    """Money as doubles, months as 2024-03, other dates as 2024-03-31."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM" if field.name == "month" else "yyyy-MM-dd")
        columns.append(value.alias(field.name))
    return df.select(*columns)
