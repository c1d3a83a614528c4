"""ABC classes and the growth/revenue matrix of products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.dates import in_period
from tillwise.functions.numbers import double, growth_pct, percent_of, ratio, rounded
from tillwise.functions.text import shorten
from tillwise.operators.ordered import running_sum
from tillwise.operators.selection import quantiles
from tillwise.session import durable
from tillwise.sources.tables import Tables


def abc_analysis(products: DataFrame, a_limit: float = 0.80, b_limit: float = 0.95, ordered: bool = True) -> DataFrame:
    """Revenue share, cumulative share from the best product down, and class A, B or C.

    The class is read off the cumulative share after rounding to four digits; the product that
    crosses a limit belongs to the class below it.
    """
    share = F.col("cumulative_revenue_pct")
    out = (
        running_sum(products, [F.desc("total_revenue"), "id"], "total_revenue")
        .withColumns({
            "revenue_share_pct": percent_of("total_revenue", "total", 2),
            "cumulative_revenue_pct": rounded(ratio("running", "total"), 4),
        })
        .withColumn("abc_class", F.when(share <= a_limit, "A").when(share <= b_limit, "B").otherwise("C"))
        .drop("running", "total", "n_rows")
    )
    return out.orderBy(F.desc("total_revenue"), "id") if ordered else out


def abc_summary(classified: DataFrame) -> DataFrame:
    """Products, revenue and share of revenue per class."""
    per_class = classified.groupBy("abc_class").agg(
        F.count("*").alias("products"), F.sum("total_revenue").alias("revenue")
    )
    everything = F.sum("revenue").over(Window.partitionBy())  # of three rows
    return per_class.select(
        "abc_class", "products", "revenue", percent_of("revenue", everything, 2).alias("revenue_share_pct")
    ).orderBy("abc_class")


def half_year_sums(sales: DataFrame, year: int) -> DataFrame:
    """Per product: revenue of both halves of ``year`` and of the whole, in one pass."""
    first = F.month("date") <= 6
    return (
        sales.filter(in_period("date", f"{year}-01-01", f"{year}-12-31"))
        .groupBy("product_id")
        .agg(
            F.coalesce(F.sum(F.when(first, F.col("revenue"))), F.lit(0)).alias("h1_revenue"),
            F.coalesce(F.sum(F.when(~first, F.col("revenue"))), F.lit(0)).alias("h2_revenue"),
            F.sum("revenue").alias("total_revenue_year"),
        )
    )


def quadrant(high_revenue: Column, high_growth: Column) -> Column:
    """Star, Cash Cow, Question Mark or Dog; a missing comparison counts as low."""
    revenue = F.coalesce(high_revenue, F.lit(False))
    growth = F.coalesce(high_growth, F.lit(False))
    return (
        F.when(revenue & growth, "Star")
        .when(revenue, "Cash Cow")
        .when(growth, "Question Mark")
        .otherwise("Dog")
    )


def growth_matrix(tables: Tables, year: int) -> DataFrame:
    """Products sold in ``year`` with the growth between its halves, the medians and the quadrant."""
    return growth_of(tables.sales, tables.products, year)


def growth_of(sales: DataFrame, products: DataFrame, year: int) -> DataFrame:
    """The same from any sums of revenue by product and a date of the month or finer."""
    described = products.select("id", "name", "category", "price", "cost")
    base = durable(
        half_year_sums(sales, year)
        .join(described, F.col("product_id") == F.col("id"))
        .withColumn("growth_h1_to_h2", growth_pct("h2_revenue", F.nullif("h1_revenue", F.lit(0))))
        .drop("product_id")
    )
    high_revenue = double("total_revenue_year") >= F.col("revenue_median")
    high_growth = F.col("growth_h1_to_h2") >= F.col("growth_median")
    measures = {"revenue_median": double("total_revenue_year"), "growth_median": F.col("growth_h1_to_h2")}
    medians = quantiles(base, measures, "id")
    rows = base.withColumns({name: F.lit(medians.get((name, ()))).cast("double") for name in measures})
    return rows.withColumn("bcg_quadrant", quadrant(high_revenue, high_growth))


def bcg_matrix(matrix: DataFrame) -> DataFrame:
    """Revenue, growth and quadrant per product."""
    return matrix.select(
        "id", "name", "category", "h1_revenue", "h2_revenue", "growth_h1_to_h2", "total_revenue_year", "bcg_quadrant"
    )


def product_matrix_points(matrix: DataFrame) -> DataFrame:
    """The points of the matrix chart: those with a growth rate, margin as size, label if large."""
    margin = percent_of(F.col("price") - F.col("cost"), "price", 1)
    large = double("total_revenue_year") > F.col("revenue_median")
    return matrix.filter(F.col("growth_h1_to_h2").isNotNull()).select(
        "id", "category", "total_revenue_year", "growth_h1_to_h2",
        margin.alias("margin_pct"),
        rounded("revenue_median", 2).alias("revenue_median"),
        rounded("growth_median", 2).alias("growth_median"),
        F.when(large, shorten("name")).alias("label"),
    )
