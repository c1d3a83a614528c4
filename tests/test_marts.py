"""Marts on a handful of rows, with one sale whose product is unknown."""

import datetime as dt
from decimal import Decimal as D

from tillwise.operators import marts


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_months_count_the_unknown_product(shop):
    got = rows(marts.monthly_revenue(shop.sales), "month", "year", "month_num", "revenue", "orders", "unique_customers", "avg_order_value")
    assert got == [
        (dt.date(2024, 1, 1), 2024, 1, D("210.00"), 2, 1, 105.0),
        (dt.date(2024, 2, 1), 2024, 2, D("10.00"), 1, 1, 10.0),
        (dt.date(2024, 5, 1), 2024, 5, D("280.00"), 2, 2, 140.0),
    ]


def test_quarters(shop):
    assert rows(marts.quarterly_revenue(shop.sales), "year", "quarter", "revenue", "orders", "unique_customers") == [
        (2024, "Q1", D("220.00"), 3, 2), (2024, "Q2", D("280.00"), 2, 2),
    ]


def test_regions_and_channels_best_first(shop):
    assert rows(marts.revenue_by_region_channel(shop.sales), "region", "channel", "revenue", "orders") == [
        ("North", "Store", D("390.00"), 2), ("South", "Online", D("90.00"), 2), ("North", "Online", D("20.00"), 1),
    ]


def test_products_drop_the_unknown_one(shop):
    got = rows(marts.top_products_revenue_margin(shop), "id", "gross_profit_per_unit", "margin_pct", "total_revenue", "total_units", "total_orders")
    assert got == [(2, D("50.00"), 25.0, D("390.00"), 2, 2), (1, D("6.00"), 60.0, D("30.00"), 3, 2)]


def test_price_zero_has_no_margin(make_tables):
    t = make_tables([(1, "Gift", "Free", "0.00", "1.00")], [(1, "A", "North", "B2B")], [("2024-01-01", 1, 1, 1, "5.00", "B2B")])
    assert rows(marts.top_products_revenue_margin(t), "margin_pct") == [(None,)]


def test_category_share_is_of_all_sales(shop):
    got = rows(marts.category_revenue_share(shop), "category", "revenue", "orders", "revenue_share_pct")
    assert got == [("Wood", D("390.00"), 2, 78.0), ("Light", D("30.00"), 2, 6.0)]


def test_product_months_merge_equal_names(make_tables):
    t = make_tables(
        [(1, "Lamp", "Light", "1.00", "1.00"), (2, "Lamp", "Light", "1.00", "1.00")],
        [(1, "A", "North", "B2B")],
        [("2024-01-01", 1, 1, 1, "5.00", "B2B"), ("2024-01-09", 2, 1, 4, "6.00", "B2B")],
    )
    assert rows(marts.product_monthly_revenue(t), "category", "name", "revenue", "units") == [("Light", "Lamp", D("11.00"), 5)]


def test_customers(shop):
    got = rows(marts.customer_lifetime_value(shop), "customer_id", "total_orders", "total_revenue", "first_purchase", "customer_lifespan_days")
    assert got == [
        (1, 2, D("210.00"), dt.date(2024, 1, 5), 15),
        (3, 1, D("200.00"), dt.date(2024, 5, 1), 0),
        (2, 2, D("90.00"), dt.date(2024, 2, 3), 89),
    ]


def test_acquisition_channels(shop):
    got = rows(marts.acquisition_channel_efficiency(shop), "acquisition_channel", "total_customers", "avg_clv", "avg_orders_per_customer", "total_revenue_from_channel")
    assert got == [("Online", 2, 205.0, 1.5, D("410.00")), ("Store", 1, 90.0, 2.0, D("90.00"))]


def test_raw_sales_keep_every_known_sale(shop):
    df = marts.raw_sales(shop, ordered=True)
    assert df.columns == [
        "id", "date", "customer_id", "product_id", "quantity", "revenue", "region", "channel", "category",
        "product_name", "price", "cost", "segment", "acquisition_channel",
    ]
    assert [r["id"] for r in df.collect()] == [1, 2, 3, 4]


def test_overview(shop):
    r = marts.kpi_overview(shop).first()
    assert (r["total_revenue"], r["total_orders"], r["active_customers"], r["total_units_sold"]) == (420.0, 4, 3, 5)
    assert (r["gross_profit"], r["gross_margin_pct"], r["avg_order_value"]) == (108.0, 25.7, 105.0)
