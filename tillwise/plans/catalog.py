"""The registered queries: every mart, analysis and report table over a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.functions.text import as_reported
from tillwise.operators import customers, kpis, marts, matrix, products, reports, timeseries
from tillwise.operators.daily import DailyRollup
from tillwise.plans.model import KPI_LEVELS, SalesModel
from tillwise.session import durable, shared_folder
from tillwise.sources.checks import contract_report
from tillwise.sources.quarantine import load_checked
from tillwise.sources.retail import retail_tables
from tillwise.sources.sinks import write_datasets
from tillwise.sources.tables import Tables, load_tables, run_query, save_tables

YEAR = 2000  # the last full year of the data
PERIOD = ("1998-01-01", "1999-12-31")
DAYS = ("1997-03-10", "1999-10-21")
SINCE = "2000-06-15"  # of the period that is open at its end

Query = Callable[[SparkSession, str], DataFrame]


def _over_tables(build: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return as_reported(build(retail_tables(spark, folder)))

    return run


def _over_model(build: Callable[[SalesModel], DataFrame]) -> Query:
    return _over_tables(lambda tables: build(SalesModel(tables, levels=KPI_LEVELS)))


def _products_abc(t: Tables) -> DataFrame:
    return products.abc_analysis(marts.top_products_revenue_margin(t, ordered=False), ordered=False)


def _growth(t: Tables) -> DataFrame:
    return timeseries.monthly_growth(marts.monthly_revenue(t.sales, ordered=False))


def _month_sums(t: Tables) -> DataFrame:
    """The month table without distinct buyers, for what needs only revenue and orders."""
    month = F.trunc("date", "MM").alias("month")
    return t.sales.groupBy(month).agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))


def _lean_growth(t: Tables) -> DataFrame:
    return timeseries.monthly_growth(_month_sums(t))


def _cells(t: Tables) -> DataFrame:
    return t.sales.groupBy("region", "channel").agg(F.sum("revenue").alias("revenue"))


def _growth_by_region(t: Tables, calendar: bool) -> DataFrame:
    return timeseries.monthly_growth(marts.revenue_by_region_month(t.sales, ordered=False), ["region"], calendar)


def _period_sql(t: Tables) -> DataFrame:
    return run_query(
        t,
        """
        SELECT region, channel, SUM(revenue) AS revenue, COUNT(*) AS orders
        FROM {sales}
        WHERE date BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
        GROUP BY 1, 2
        ORDER BY 1, 2
        """,
        {"first": PERIOD[0], "last": PERIOD[1]},
    )


def _loaded(t: Tables) -> DataFrame:
    """The tables saved, saved again (which keeps them) and read back: sales per channel with their dimension columns."""
    spark = t.sales.sparkSession
    folder = f"{shared_folder(spark)}/loaded-{uuid.uuid4().hex}"
    save_tables(t, folder)
    save_tables(t._replace(sales=t.sales.limit(0)), folder)
    loaded = marts.raw_sales(load_tables(spark, folder))
    return loaded.groupBy("channel", "segment", "category").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"), F.count("*").alias("orders"), F.min("date").alias("first_date")
    )


def _quarantined(t: Tables) -> DataFrame:
    """Sales that came as text with some values spoilt, divided while they are loaded: rows and quantity of both parts by reason."""
    spark = t.sales.sparkSession
    folder = f"{shared_folder(spark)}/checked-{uuid.uuid4().hex}"
    raw = t.sales.select(*[F.col(name).cast("string").alias(name) for name in t.sales.columns]).withColumns({
        "date": F.when(F.col("id").cast("long") % 97 == 0, "soon").otherwise(F.col("date")),
        "quantity": F.when(F.col("product_id").cast("long") % 89 == 0, "0").otherwise(F.col("quantity")),
        "region": F.when(F.col("customer_id").cast("long") % 101 != 0, F.col("region")),
    })
    parts = load_checked({"sales": raw}, folder)["sales"]
    accepted = spark.read.parquet(parts.accepted.path).select("quantity", F.lit("").alias("reasons"))
    rejected = spark.read.parquet(parts.rejected.path).select("quantity", F.array_join("reasons", ", ").alias("reasons"))
    counted = accepted.unionByName(rejected).groupBy("reasons").agg(F.count("*").alias("sales"), F.sum("quantity").alias("units"))
    written = F.when(F.col("reasons") == "", parts.accepted.rows).otherwise(parts.rejected.rows)
    return counted.withColumn("rows_of_part", written.cast("long"))


def _written(t: Tables) -> DataFrame:
    """The growth table as the report writes it, read back with its types."""
    spark = t.sales.sparkSession
    folder = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    written = write_datasets({"monthly_growth": lambda: _growth(t)}, folder)
    return spark.read.parquet(written["monthly_growth"])


def _rollup(t: Tables) -> DailyRollup:
    """A daily rollup that was loaded with a day missing and another one wrong, and then mended by merging these two."""
    spark = t.sales.sparkSession
    rollup = DailyRollup(spark, f"{shared_folder(spark)}/daily-{uuid.uuid4().hex}")
    first, last = t.sales.agg(F.min("date"), F.max("date")).first()
    rollup.merge(t.sales.filter(F.col("date") < last).withColumn("revenue", F.when(F.col("date") == first, 0).otherwise(F.col("revenue")).cast("decimal(18,2)")))
    rollup.merge(t.sales, [first, last])
    return rollup


def _buyers_of_days(t: Tables) -> DataFrame:
    """Distinct buyers per region and channel in a period that follows no month, from bitmaps."""
    place = [F.col("region"), F.col("channel")]
    return _rollup(t).unique_buyers(*place, start=DAYS[0], end=DAYS[1]).toDF("region", "channel", "unique_customers")


def _stats(t: Tables) -> DataFrame:
    """Customer stats, stored once for the analyses that read them several times."""
    return durable(marts.customer_lifetime_value(t, ordered=False))


TABLE_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # marts
    "monthly_revenue": lambda t: marts.monthly_revenue(t.sales),
    "quarterly_revenue": lambda t: marts.quarterly_revenue(t.sales),
    "revenue_by_region_channel": lambda t: marts.revenue_by_region_channel(t.sales),
    "revenue_by_region_month": lambda t: marts.revenue_by_region_month(t.sales),
    "top_products_revenue_margin": marts.top_products_revenue_margin,
    "product_monthly_revenue": marts.product_monthly_revenue,
    "category_revenue_share": marts.category_revenue_share,
    "customer_lifetime_value": marts.customer_lifetime_value,
    "acquisition_channel_efficiency": marts.acquisition_channel_efficiency,
    "raw_sales": marts.raw_sales,
    "kpi_overview": marts.kpi_overview,
    # analyses
    "monthly_growth": _growth,
    "monthly_growth_by_region": lambda t: _growth_by_region(t, calendar=False),
    "monthly_growth_calendar": lambda t: _growth_by_region(t, calendar=True),
    "monthly_revenue_in_period": lambda t: marts.monthly_revenue(t.during(*PERIOD).sales),
    "monthly_revenue_since": lambda t: marts.monthly_revenue(t.during(start=SINCE).sales),
    "region_channel_in_period": _period_sql,
    "revenue_matrix": lambda t: matrix.revenue_matrix(_cells(t)),
    "abc_analysis": lambda t: products.abc_analysis(marts.top_products_revenue_margin(t, ordered=False)),
    "abc_summary": lambda t: products.abc_summary(_products_abc(t)),
    "bcg_matrix": lambda t: products.bcg_matrix(products.growth_matrix(t, YEAR)),
    "rfm": lambda t: customers.rfm(t.sales),
    "clv_by_segment": lambda t: customers.clv_by_segment(_stats(t)),
    "churn_risk": lambda t: customers.churn_risk(_stats(t)),
    "churn_distribution": lambda t: customers.churn_distribution(customers.churn_risk(_stats(t), ordered=False)),
    "trend_signals": lambda t: timeseries.trend_signals(_lean_growth(t)),
    # report tables and chart data
    "top_bottom_months": lambda t: reports.top_bottom_months(_lean_growth(t)),
    "top10_products": lambda t: reports.top_products(_products_abc(t), 10),
    "rfm_segment_share": lambda t: customers.rfm_segment_share(customers.rfm(t.sales)),
    "monthly_export": _growth,
    "product_export": lambda t: reports.product_export(products.abc_analysis(marts.top_products_revenue_margin(t, ordered=False))),
    "region_matrix_export": lambda t: matrix.revenue_matrix(
        _cells(t), row_total="Gesamt", column_total="GESAMT", by_total=False
    ),
    "rfm_segment_summary": lambda t: customers.rfm_segment_summary(customers.rfm(t.sales)),
    "revenue_trend_forecast": lambda t: timeseries.trend_forecast(_month_sums(t)),
    "region_month_heatmap": lambda t: matrix.region_month_heatmap(marts.revenue_by_region_month(t.sales, ordered=False)),
    "product_matrix_points": lambda t: products.product_matrix_points(products.growth_matrix(t, YEAR)),
    "rfm_scatter_points": lambda t: customers.rfm_scatter_points(customers.rfm(t.sales)),
    "dashboard_months": lambda t: timeseries.dashboard_months(_lean_growth(t)),
    "mom_bars": lambda t: timeseries.mom_bars(_lean_growth(t)),
    "yoy_compare": lambda t: timeseries.yoy_compare(_month_sums(t.during(f"{YEAR - 1}-01-01", f"{YEAR}-12-31")), YEAR),
    "quarter_totals": lambda t: timeseries.quarter_totals(_lean_growth(t)),
    "november_peak": lambda t: timeseries.november_peak(_month_sums(t)),
    "prompt_top5_products": lambda t: reports.top_products(_products_abc(t), 5),
    # tables and results written and read back
    "loaded_tables": _loaded,
    "written_growth": _written,
    "daily_rollup_months": lambda t: _rollup(t).monthly_revenue(),
    "daily_rollup_buyers": _buyers_of_days,
    "quarantined_sales": _quarantined,
    # building blocks not reached above
    "table_contract_check": contract_report,
    "safe_pct_change": lambda t: timeseries.quarter_change(_lean_growth(t)),
    "upper_titles": lambda t: reports.upper_titles(_cells(t)),
    "distinct_dimension_values": lambda t: reports.distinct_dimension_values(_cells(t), t.products, t.customers),
}

MODEL_QUERIES: dict[str, Callable[[SalesModel], DataFrame]] = {
    "kpis": lambda m: kpis.flat(m.kpis),
    "kpi_display": lambda m: kpis.kpi_display(m.kpis),
    "kpi_table": lambda m: kpis.kpi_table(m.kpis),
    "dashboard_cards": lambda m: kpis.dashboard_cards(m.kpis),
    "insight_facts": lambda m: kpis.insight_facts(m.kpis),
}


def registered() -> dict[str, Query]:
    out = {name: _over_tables(build) for name, build in TABLE_QUERIES.items()}
    out.update({name: _over_model(build) for name, build in MODEL_QUERIES.items()})
    return out
