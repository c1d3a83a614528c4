"""The eleven marts over products, customers and sales.

Sales are summed per join key before they meet a dimension: the partial sums on the map side take
the weight out of a hot product or customer, and only one row per key is left to join. Which side
of a join is broadcast is left to the planner, which knows the sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.dates import month_start, quarter_of_year
from tillwise.functions.numbers import double, mean_of_sum, percent_of, ratio, rounded
from tillwise.operators.joins import sorted_small, split_join
from tillwise.sources.tables import Tables


def _revenue() -> Column:
    return F.sum("revenue").alias("revenue")


def _orders() -> Column:
    return F.count("*").alias("orders")


def _buyers() -> Column:
    return F.countDistinct("customer_id").alias("unique_customers")


def _sorted(df: DataFrame, ordered: bool, *keys: str | Column) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def monthly_revenue(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue, orders, buyers and mean order value per month."""
    return months_table(sales.groupBy(month_start("date").alias("month")).agg(_revenue(), _orders(), _buyers()), ordered)


def months_of(by_month_and_customer: DataFrame) -> DataFrame:
    """The same from sums per month and customer."""
    return months_table(by_month_and_customer.groupBy("month").agg(_revenue(), F.sum("orders").alias("orders"), F.count("customer_id").alias("unique_customers")), True)


def months_table(sums: DataFrame, ordered: bool) -> DataFrame:
    out = (
        sums.select(
            "month",
            F.year("month").alias("year"),
            F.month("month").alias("month_num"),
            "revenue",
            "orders",
            "unique_customers",
            mean_of_sum("revenue", "orders").alias("avg_order_value"),
        )
    )
    return sorted_small(out, "month") if ordered else out


def quarterly_revenue(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue, orders and buyers per year and quarter."""
    out = sales.groupBy(F.year("date").alias("year"), quarter_of_year("date").alias("quarter")).agg(
        _revenue(), _orders(), _buyers()
    )
    return sorted_small(out, "year", "quarter") if ordered else out


def quarters_of(by_month_and_customer: DataFrame) -> DataFrame:
    """The same from sums per month and customer."""
    out = by_month_and_customer.groupBy(F.year("month").alias("year"), quarter_of_year("month").alias("quarter")).agg(
        _revenue(), F.sum("orders").alias("orders"), _buyers()
    )
    return sorted_small(out, "year", "quarter")


def revenue_by_region_channel(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Cross table of region and channel in long form."""
    return places_table(sales.groupBy("region", "channel").agg(_revenue(), _orders(), _buyers()), ordered)


def places_of(by_place_and_customer: DataFrame) -> DataFrame:
    """The same from sums per region, channel and customer."""
    counts = [F.sum("orders").alias("orders"), F.count("customer_id").alias("unique_customers")]
    return places_table(by_place_and_customer.groupBy("region", "channel").agg(_revenue(), *counts), True)


def places_table(sums: DataFrame, ordered: bool) -> DataFrame:
    out = sums.select(
        "region", "channel", "revenue", "orders", mean_of_sum("revenue", "orders").alias("avg_order_value"), "unique_customers"
    )
    return _sorted(out, ordered, F.desc("revenue"), "region", "channel")


def revenue_by_region_month(sales: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue per month and region."""
    out = sales.groupBy(month_start("date").alias("month"), "region").agg(_revenue())
    return _sorted(out, ordered, "month", "region")


def sums_by_product(sales: DataFrame) -> DataFrame:
    """One row per product sold, before any join."""
    return sales.groupBy("product_id").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_units"),
        F.count("*").alias("total_orders"),
    )


def describe_products(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Product sums with the product's columns, unit profit and list-price margin."""
    unit_profit = F.col("price") - F.col("cost")
    return by_product.join(products, F.col("product_id") == F.col("id")).select(
        "id", "name", "category", "price", "cost",
        unit_profit.alias("gross_profit_per_unit"),
        percent_of(unit_profit, "price", 1).alias("margin_pct"),
        "total_revenue", "total_units", "total_orders",
        mean_of_sum("total_revenue", "total_orders").alias("avg_order_revenue"),
    )


def top_products_revenue_margin(tables: Tables, ordered: bool = True) -> DataFrame:
    """Every sold product with revenue, units, orders and margin, best first."""
    out = describe_products(sums_by_product(tables.sales), tables.products)
    return _sorted(out, ordered, F.desc("total_revenue"), "id")


def product_monthly_revenue(tables: Tables, ordered: bool = True) -> DataFrame:
    """Revenue and units per month, category and product name."""
    per_product = tables.sales.groupBy(month_start("date").alias("month"), "product_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units")
    )
    return named_months(per_product, tables.products, ordered)


def named_months(per_product: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """The same from sums per month and product."""
    out = (
        per_product.join(products, F.col("product_id") == F.col("id"))
        .groupBy("month", "category", "name")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
    )
    return _sorted(out, ordered, "month", "category", "name")


def category_revenue_share(tables: Tables, ordered: bool = True) -> DataFrame:
    """Revenue per category and its share of all sales, those of unknown products included."""
    return category_shares(sums_by_product(tables.sales), tables.products, ordered)


def category_shares(by_product: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """Shares of the categories, from product sums.

    The left join keeps unknown products as one extra row, so the total needs no second pass over
    the sales.
    """
    known = products.select("id", "category", F.lit(True).alias("known"))
    per_category = (
        by_product.join(known, F.col("product_id") == F.col("id"), "left")
        .groupBy("category", "known")
        .agg(F.sum("total_revenue").alias("revenue"), F.sum("total_orders").alias("orders"))
        .withColumn("everything", F.sum("revenue").over(Window.partitionBy()))  # of the few categories
    )
    out = per_category.filter("known").select(
        "category", "revenue", "orders",
        rounded(ratio(double("revenue") * F.lit(100.0), "everything"), 2).alias("revenue_share_pct"),
    )
    return _sorted(out, ordered, F.desc("revenue"), "category")


def sums_by_customer(sales: DataFrame) -> DataFrame:
    """One row per buying customer, before any join."""
    return sales.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        F.min("date").alias("first_purchase"),
        F.max("date").alias("last_purchase"),
    )


def describe_customers(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer sums with the customer's columns, mean order value and lifespan in days."""
    return by_customer.join(customers, F.col("customer_id") == F.col("id")).select(
        "customer_id", "segment", "region", "acquisition_channel",
        "total_orders", "total_revenue",
        mean_of_sum("total_revenue", "total_orders").alias("avg_order_value"),
        "first_purchase", "last_purchase",
        F.datediff("last_purchase", "first_purchase").alias("customer_lifespan_days"),
    )


def customer_lifetime_value(tables: Tables, ordered: bool = True) -> DataFrame:
    """Every buying customer with orders, revenue and first and last purchase, best first."""
    out = describe_customers(sums_by_customer(tables.sales), tables.customers)
    return _sorted(out, ordered, F.desc("total_revenue"), "customer_id")


def acquisition_channel_efficiency(tables: Tables, ordered: bool = True) -> DataFrame:
    """Customers, mean revenue and mean orders per acquisition channel."""
    return channel_efficiency(sums_by_customer(tables.sales), tables.customers, ordered)


def channel_efficiency(by_customer: DataFrame, customers: DataFrame, ordered: bool = True) -> DataFrame:
    """Means per acquisition channel, from customer sums."""
    out = (
        by_customer.join(customers, F.col("customer_id") == F.col("id"))
        .groupBy("acquisition_channel")
        # one row per customer is left, so rows are customers
        .agg(
            F.count("*").alias("total_customers"),
            F.sum("total_revenue").alias("revenue"),
            F.sum("total_orders").alias("orders"),
        )
        .select(
            "acquisition_channel",
            "total_customers",
            mean_of_sum("revenue", "total_customers").alias("avg_clv"),
            mean_of_sum("orders", "total_customers").alias("avg_orders_per_customer"),
            F.col("revenue").alias("total_revenue_from_channel"),
        )
    )
    return _sorted(out, ordered, F.desc("avg_clv"), "acquisition_channel")


def raw_sales(tables: Tables, ordered: bool = False, split: bool = False) -> DataFrame:
    """Every sale with its product and customer columns.

    With ``split`` the products and customers that have too many sales for one task are measured, in a pass of its own for
    each, and their sales are dealt to several tasks; otherwise hot keys are left to the adaptive planner.

    Sorting the whole fact table by date is a full shuffle for its own sake, so it is off unless
    the caller writes the rows out in that order.
    """
    products = tables.products.select(
        F.col("id").alias("product_id"), "category", F.col("name").alias("product_name"), "price", "cost"
    )
    customers = tables.customers.select(F.col("id").alias("customer_id"), "segment", "acquisition_channel")
    join = split_join if split else DataFrame.join
    out = (
        join(join(tables.sales, products, "product_id"), customers, "customer_id")
        .select(
            "id", "date", "customer_id", "product_id", "quantity", "revenue", "region", "channel",
            "category", "product_name", "price", "cost", "segment", "acquisition_channel",
        )
    )
    return _sorted(out, ordered, "date")


def sums_by_buyer(sales: DataFrame) -> DataFrame:
    """One row per product and customer that bought it, before any join."""
    return sales.groupBy("product_id", "customer_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"), F.count("*").alias("orders")
    )


def kpi_overview(tables: Tables) -> DataFrame:
    """One row of totals, with the margin realised on the sales. Sales of unknown products count nowhere."""
    return overview(sums_by_buyer(tables.sales), tables.products)


def overview(by_buyer: DataFrame, products: DataFrame) -> DataFrame:
    """The totals, from sums per product and customer."""
    profit = F.col("revenue") - F.col("units") * F.col("cost")
    totals = by_buyer.join(products.select(F.col("id").alias("product_id"), "cost"), "product_id").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("total_orders"),
        F.countDistinct("customer_id").alias("active_customers"),
        F.sum("units").alias("units"),
        F.sum(profit).alias("profit"),
    )
    return totals.select(
        double("revenue").alias("total_revenue"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "active_customers",
        rounded(mean_of_sum("revenue", "total_orders"), 2).alias("avg_order_value"),
        F.col("units").alias("total_units_sold"),
        double("profit").alias("gross_profit"),
        percent_of("profit", "revenue", 1).alias("gross_margin_pct"),
    )
