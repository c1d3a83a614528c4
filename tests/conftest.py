from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tillwise.session import local_session
from tillwise.sources import tables as T


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", "6g")
    yield session
    session.stop()


@pytest.fixture
def spread(spark):
    """Keep small data in many partitions, as large data would be."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, "true")


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture
def make_tables(spark):
    """Tables from short rows: products (id, name, category, price, cost), customers (id, segment, region,
    acquisition channel), sales (date, product, customer, quantity, revenue, channel)."""

    def make(products, customers, sales) -> T.Tables:
        regions = {c[0]: c[2] for c in customers}
        p = [(i, n, c, Decimal(price), Decimal(cost)) for i, n, c, price, cost in products]
        s = [
            (i, day(d), prod, cust, q, Decimal(str(rev)), regions.get(cust, "?"), ch)
            for i, (d, prod, cust, q, rev, ch) in enumerate(sales, 1)
        ]
        return T.Tables(
            spark.createDataFrame(p, T.PRODUCTS),
            spark.createDataFrame(customers, T.CUSTOMERS),
            spark.createDataFrame(s, T.SALES),
        )

    return make


@pytest.fixture
def shop(make_tables):
    """Two products, three customers, and one sale (the last) of a product nobody knows."""
    return make_tables(
        [(1, "Lamp", "Light", "10.00", "4.00"), (2, "Desk", "Wood", "200.00", "150.00")],
        [(1, "A", "North", "Online"), (2, "A", "South", "Store"), (3, "B", "North", "Online")],
        [
            ("2024-01-05", 1, 1, 2, "20.00", "Online"),
            ("2024-01-20", 2, 1, 1, "190.00", "Store"),
            ("2024-02-03", 1, 2, 1, "10.00", "Online"),
            ("2024-05-01", 2, 3, 1, "200.00", "Store"),
            ("2024-05-02", 99, 2, 3, "80.00", "Online"),
        ],
    )


@pytest.fixture
def months(spark):
    """A month table from revenues, starting at a month."""

    def make(revenues, start="2023-01-01", skip=()):
        first = day(start)
        rows = []
        for i, r in enumerate(revenues):
            if i in skip:
                continue
            y, m = divmod(first.month - 1 + i, 12)
            rows.append((dt.date(first.year + y, m + 1, 1), Decimal(str(r)), i + 1))
        return spark.createDataFrame(rows, "month date, revenue decimal(28,2), orders bigint")

    return make
