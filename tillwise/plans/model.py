"""Analyses that share their base sums."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Collection
from functools import wraps

from pyspark.sql import DataFrame

from tillwise.operators import customers, kpis, marts, products, timeseries
from tillwise.operators.rollup import SalesRollup
from tillwise.session import durable, in_threads
from tillwise.sources.tables import Tables


def _once(build: Callable) -> property:
    """A property built by the first thread that asks; the others wait for it."""
    name = build.__name__

    @wraps(build)
    def guarded(self):
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = build(self)
        return self._built[name]

    return property(guarded)


KPI_LEVELS = ("month", "product", "customer", "place")  # what the KPI record is made of


class SalesModel:
    """Everything that follows from one pass over the sales.

    The properties are built on first use and stay: the rollup reads the sales once, and the
    tables that several results start from are made durable. With ``levels`` the rollup has only these, and what
    would be read by a report only is not stored.
    """

    def __init__(
        self, tables: Tables, year: int | None = None, reference_date: dt.date | str | None = None, levels: Collection[str] | None = None
    ):
        self.tables = tables
        self.levels = levels
        self.year = year
        self.reference_date = reference_date
        self._built: dict[str, object] = {}
        self._locks = {name: threading.Lock() for name, p in vars(SalesModel).items() if isinstance(p, property)}

    @_once
    def rollup(self) -> SalesRollup:
        return SalesRollup(self.tables.sales) if self.levels is None else SalesRollup(self.tables.sales, self.levels)

    @_once
    def growth(self) -> DataFrame:
        return timeseries.monthly_growth(self.rollup.by_month())

    @_once
    def region_channel(self) -> DataFrame:
        return self.rollup.by_place()

    @_once
    def product_stats(self) -> DataFrame:
        return marts.describe_products(self.rollup.by_product(), self.tables.products)

    @_once
    def classified_products(self) -> DataFrame:
        return products.abc_analysis(self.product_stats, ordered=False)

    @_once
    def growth_matrix(self) -> DataFrame:
        return products.growth_of(self.rollup.by_month_and_product(), self.tables.products, self.year)

    @_once
    def customer_stats(self) -> DataFrame:
        stats = marts.describe_customers(self.rollup.by_customer(), self.tables.customers)
        return durable(stats) if self.levels is None else stats

    @_once
    def segments(self) -> DataFrame:
        return customers.rfm_from_sums(self.rollup.by_customer(), self.reference_date)

    @_once
    def kpis(self) -> DataFrame:
        """The KPI record; one row, kept because five reports are projections of it."""
        # chains of jobs that do not depend on each other
        in_threads(lambda name: getattr(self, name), ("classified_products", "customer_stats", "segments"))
        return durable(
            kpis.kpis(
                self.growth, self.classified_products, self.region_channel, self.customer_stats, self.segments,
                self.reference_date,
            )
        )
