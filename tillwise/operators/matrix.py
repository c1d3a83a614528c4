"""Pivots with totals. Their input is a mart with one row per cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.dates import is_fourth_quarter, short_month
from tillwise.functions.numbers import double

MISSING = "(none)"  # heading of the column of cells without a column value


def column_values(df: DataFrame, column: str, limit: int | None = None) -> list[str | None]:
    """Distinct values that are to become columns, null last; more than ``limit`` (the session's pivot limit) are an error."""
    limit = limit or int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [row[0] for row in df.select(column).distinct().orderBy(F.col(column).asc_nulls_last()).limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values and cannot become columns")
    return found


def _headings(values: Sequence[str | None], column: str, taken: Sequence[str]) -> list[str]:
    """A heading for each value; one that reads like another heading says which column it is a value of."""
    used, out = {name.lower() for name in taken}, []
    for value in values:
        name = MISSING if value is None else str(value)
        while name.lower() in used:
            name = f"{name} ({column})"
        used.add(name.lower())
        out.append(name)
    return out


def _cell_sums(column: str, values: Sequence[str | None]) -> list[Column]:
    return [F.sum(F.when(F.col(column).eqNullSafe(F.lit(value)), F.col("revenue"))).alias(f"_{i}") for i, value in enumerate(values)]


def revenue_matrix(
    cells: DataFrame,
    rows: str = "region",
    columns: str = "channel",
    values: Sequence[str | None] | None = None,
    row_total: str = "total",
    column_total: str = "Total",
    by_total: bool = True,
) -> DataFrame:
    """Pivot of revenue with 0 for missing cells, a total column and a total row at the end.

    The columns are the values there are; with ``values`` given, the total still counts all cells. The total is a sum of
    its own, so no value can be taken for it. Rows are sorted by their total, or by name if not ``by_total``.
    """
    values = column_values(cells, columns) if values is None else list(values)
    names = _headings(values, columns, [rows, row_total])
    wide = cells.rollup(rows).agg(F.grouping(rows).alias("_all"), F.sum("revenue").alias("_total"), *_cell_sums(columns, values))
    nothing = F.lit(0).cast(wide.schema["_total"].dataType)
    order = [F.col("_all"), F.desc("_total"), F.col(rows)] if by_total else [F.col("_all"), F.col(rows)]
    return wide.orderBy(*order).select(
        F.when(F.col("_all") == 1, column_total).otherwise(F.col(rows)).alias(rows),
        *[F.coalesce(f"_{i}", nothing).alias(name) for i, name in enumerate(names)],
        F.coalesce("_total", nothing).alias(row_total),
    )


def region_month_heatmap(cells: DataFrame, values: Sequence[str | None] | None = None) -> DataFrame:
    """Month by region in thousands, with the month label and a mark for the fourth quarter."""
    values = column_values(cells, "region") if values is None else list(values)
    names = _headings(values, "region", ["month", "label", "fourth_quarter"])
    wide = cells.groupBy("month").agg(*_cell_sums("region", values))
    return wide.orderBy("month").select(
        "month",
        short_month("month").alias("label"),
        is_fourth_quarter("month").alias("fourth_quarter"),
        *[(double(F.col(f"_{i}")) / 1000.0).alias(name) for i, name in enumerate(names)],
    )
