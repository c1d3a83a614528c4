"""All base sums of the sales in one pass.

The KPI record, the marts and the reports need sums by month, by product, by customer, by region and
channel, and by some pairs of these. One grouping-sets aggregation reads and shuffles the sales once for all of them; the
result is kept in one partition per level, so what follows works on rows per month, product or
customer instead of rows per sale, and reads no other level.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.dates import month_start
from tillwise.session import durable

_LEVELS = {
    "month": ["month"],
    "product": ["product_id"],
    "customer": ["customer_id"],
    "place": ["region", "channel"],
    # what counts distinct buyers counts rows of a level that has the customer as a key
    "month_region": ["month", "region"],
    "month_product": ["month", "product_id"],
    "month_customer": ["month", "customer_id"],
    "place_customer": ["region", "channel", "customer_id"],
    "buyer": ["product_id", "customer_id"],
}
_KEYS = ["month", "product_id", "customer_id", "region", "channel"]


def _mark(level: str) -> int:
    """The grouping id of a level: a bit is set for every key that is rolled away."""
    return sum(1 << (len(_KEYS) - 1 - i) for i, key in enumerate(_KEYS) if key not in _LEVELS[level])


def missing_values(columns: Sequence[str]) -> Column:
    """How many of a row's columns are null."""
    return sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0))


class SalesRollup:
    """The sales summed at each level that is wanted, all by default, materialised once.

    Every sale is expanded once per level before the partial sums, and those with the customer in their key reduce little; so
    whoever needs few levels should name them.
    """

    def __init__(self, sales: DataFrame, levels: Collection[str] = tuple(_LEVELS)):
        self.levels = frozenset(levels)
        sets = [[F.col(key) for key in keys] for level, keys in _LEVELS.items() if level in self.levels]
        rows = sales.select(
            month_start("date").alias("month"), "product_id", "customer_id", "region", "channel",
            "date", "quantity", "revenue", missing_values(sales.columns).alias("gaps"),
        )
        self._rows = durable(
            rows.groupingSets(sets, *[F.col(key) for key in _KEYS]).agg(
                F.grouping_id().alias("level"),
                F.sum("revenue").alias("revenue"),
                F.sum("quantity").alias("units"),
                F.count("*").alias("orders"),
                F.min("date").alias("first_date"),
                F.max("date").alias("last_date"),
                F.sum("gaps").alias("gaps"),
            ),
            by="level",
        )

    def _level(self, name: str) -> DataFrame:
        if name not in self.levels:
            raise KeyError(f"this rollup has no level {name}")
        return self._rows.filter(F.col("level") == _mark(name))

    def by_month(self) -> DataFrame:
        return self._level("month").select("month", "revenue", "orders")

    def by_product(self) -> DataFrame:
        return self._level("product").select(
            "product_id",
            F.col("revenue").alias("total_revenue"),
            F.col("units").alias("total_units"),
            F.col("orders").alias("total_orders"),
        )

    def by_customer(self) -> DataFrame:
        return self._level("customer").select(
            "customer_id",
            F.col("orders").alias("total_orders"),
            F.col("revenue").alias("total_revenue"),
            F.col("first_date").alias("first_purchase"),
            F.col("last_date").alias("last_purchase"),
        )

    def by_place(self) -> DataFrame:
        return self._level("place").select("region", "channel", "revenue", "orders")

    def by_month_and_region(self) -> DataFrame:
        return self._level("month_region").select("month", "region", "revenue")

    def by_month_and_product(self) -> DataFrame:
        """Revenue and units per month (as ``date``, too) and product."""
        return self._level("month_product").select("month", F.col("month").alias("date"), "product_id", "revenue", "units")

    def by_month_and_customer(self) -> DataFrame:
        return self._level("month_customer").select("month", "customer_id", "revenue", "orders")

    def by_place_and_customer(self) -> DataFrame:
        return self._level("place_customer").select("region", "channel", "customer_id", "revenue", "orders")

    def by_buyer(self) -> DataFrame:
        return self._level("buyer").select("product_id", "customer_id", "revenue", "units", "orders")

    def used_keys(self) -> DataFrame:
        """kind, key, n, gaps: how often sales name each product and customer, and how many values those sales lack."""
        sides = [
            self._level(kind).select(F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("key"), F.col("orders").alias("n"), "gaps")
            for kind in ("product", "customer")
        ]
        return sides[0].unionByName(sides[1])
