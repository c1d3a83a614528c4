"""ABC and product matrix at their limits."""

from decimal import Decimal as D

import pytest

from tillwise.operators import products


def classed(spark, revenues):
    rows = [(i, f"p{i}", D(str(r)), 10.0) for i, r in enumerate(revenues, 1)]
    df = spark.createDataFrame(rows, "id bigint, name string, total_revenue decimal(28,2), margin_pct double")
    return products.abc_analysis(df).collect()


@pytest.mark.parametrize("revenues, want", [
    ([80, 15, 5], "ABC"),           # exactly on both limits
    ([90, 6, 4], "BCC"),            # the one that crosses 80% is B already
    ([79.996, 20.004], "AC"),       # rounded to 0.8000 first
    ([50, 50], "AC"),
    ([100], "C"),
])
def test_classes(spark, revenues, want):
    assert "".join(r["abc_class"] for r in classed(spark, revenues)) == want


def test_ties_go_by_id(spark):
    rows = classed(spark, [10, 20, 20, 10])
    assert [r["id"] for r in rows] == [2, 3, 1, 4]
    assert [r["cumulative_revenue_pct"] for r in rows] == [0.3333, 0.6667, 0.8333, 1.0]


def test_class_shares_sum_to_all(spark):
    rows = [(i, D(i * i)) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "id bigint, total_revenue decimal(28,2)")
    summary = products.abc_summary(products.abc_analysis(df)).collect()
    assert sum(r["products"] for r in summary) == 199
    assert abs(sum(r["revenue_share_pct"] for r in summary) - 100) < 0.02


@pytest.fixture
def catalogue(make_tables):
    products_ = [(i, f"A product with a long name {i}" if i == 1 else f"P{i}", "Cat", "10.00", "5.00") for i in range(1, 6)]
    sales = [
        ("2000-01-01", 1, 1, 1, "100.00", "B2B"), ("2000-12-31", 1, 1, 1, "200.00", "B2B"),  # +100, 300
        ("2000-06-30", 2, 1, 1, "200.00", "B2B"), ("2000-07-01", 2, 1, 1, "100.00", "B2B"),  # -50, 300
        ("2000-02-01", 3, 1, 1, "10.00", "B2B"), ("2000-08-01", 3, 1, 1, "15.00", "B2B"),    # +50, 25
        ("2000-09-01", 4, 1, 1, "20.00", "B2B"),                                             # no first half
        ("1999-12-31", 5, 1, 1, "999.00", "B2B"),                                            # other year
        ("2000-03-01", 77, 1, 1, "500.00", "B2B"),                                           # unknown
    ]
    return make_tables(products_, [(1, "S", "North", "B2B")], sales)


def test_quadrants(catalogue):
    got = {r["id"]: (r["growth_h1_to_h2"], float(r["total_revenue_year"]), r["bcg_quadrant"])
           for r in products.bcg_matrix(products.growth_matrix(catalogue, 2000)).collect()}
    assert got == {  # medians: revenue 162.5, growth 50; equal counts as high, missing as low
        1: (100.0, 300.0, "Star"),
        2: (-50.0, 300.0, "Cash Cow"),
        3: (50.0, 25.0, "Question Mark"),
        4: (None, 20.0, "Dog"),
    }


def test_points_have_margin_and_short_labels(catalogue):
    got = {r["id"]: r for r in products.product_matrix_points(products.growth_matrix(catalogue, 2000)).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["label"] == "A product with a l…" and got[2]["label"] == "P2" and got[3]["label"] is None
    assert (got[1]["margin_pct"], got[1]["revenue_median"], got[1]["growth_median"]) == (50.0, 162.5, 50.0)
