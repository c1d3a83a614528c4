"""Tables of the written report and the workbook."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillwise.functions.dates import long_month
from tillwise.functions.text import magnitude, titled

# fixed values: the columns of the product export, in its order
PRODUCT_COLUMNS = (
    "name", "category", "price", "margin_pct", "total_revenue", "total_units", "total_orders", "abc_class",
)


def top_bottom_months(growth: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` months with the most and the ``k`` with the least revenue, best first in both."""
    up = F.row_number().over(Window.orderBy(F.desc("revenue"), "month"))
    down = F.row_number().over(Window.orderBy("revenue", F.desc("month")))
    parts = F.array_compact(F.array(F.when(F.col("_up") <= k, "top"), F.when(F.col("_down") <= k, "flop")))
    return (
        growth.withColumns({"_up": up, "_down": down})
        .select("*", F.explode(parts).alias("part"))
        .select(
            "part", "month", long_month("month").alias("label"), "revenue",
            magnitude("revenue").alias("revenue_short"), "mom_growth_pct",
        )
        .orderBy(F.desc("part"), F.desc("revenue"), "month")
    )


def top_products(products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the most revenue and their class."""
    return (
        products.orderBy(F.desc("total_revenue"), "id")
        .limit(k)
        .select("id", "name", "category", "total_revenue", "margin_pct", "abc_class")
    )


def product_export(products: DataFrame) -> DataFrame:
    """Those of the export columns that are there, under headings."""
    return titled(products.select(*[c for c in PRODUCT_COLUMNS if c in products.columns]))


def upper_titles(region_channel: DataFrame) -> DataFrame:
    """Region headings in capitals with the revenue beneath."""
    return region_channel.groupBy(F.upper("region").alias("heading")).agg(F.sum("revenue").alias("revenue")).orderBy("heading")


def distinct_dimension_values(region_channel: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Every value of the categorical columns, in long form."""

    def values(df: DataFrame, *names: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("value")) for n in names])
        return df.select(F.inline(pairs)).distinct()

    return (
        values(region_channel, "region", "channel")
        .unionByName(values(products, "category"))
        .unionByName(values(customers, "segment", "acquisition_channel"))
        .orderBy("dimension", "value")
    )
