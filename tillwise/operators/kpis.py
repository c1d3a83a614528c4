"""The KPI record, its display form, dashboard cards and rule-based facts.

Every section is a one-row aggregate of its input; the sections are put side by side, so the
record stays a lazy DataFrame of one row with one struct per section. Money stays DECIMAL in it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.dates import month_label
from tillwise.functions.numbers import double, exact_avg, growth_pct, percent_of, ratio, rounded
from tillwise.functions.text import euro, percent, whole
from tillwise.operators.joins import beside, sorted_small

SECTIONS = ("period", "revenue", "growth", "products", "customers", "top_performers")


def _months(growth: DataFrame, reference_date: dt.date | str | None) -> DataFrame:
    """Period, revenue sums and growth from the month table (bounded by the calendar)."""
    everything = Window.partitionBy()
    given = F.lit(None if reference_date is None else str(reference_date)).cast("date")
    reference = F.coalesce(given, F.max("month").over(everything))

    def latest(column: str) -> Column:
        known = Window.orderBy(F.col(column).isNull(), F.desc("month"))
        return F.when(F.col(column).isNotNull(), F.row_number().over(known))

    rows = growth.select("month", "revenue", "orders", "mom_growth_pct", "yoy_growth_pct").withColumns({
        "_reference": reference,
        "_mom_rank": latest("mom_growth_pct"),
        "_yoy_rank": latest("yoy_growth_pct"),
    })
    month = F.col("month")
    year_ago = F.add_months("_reference", -12)
    two_years_ago = F.add_months("_reference", -24)
    none = F.lit(0).cast("decimal(28,2)")
    sums = rows.agg(
        F.min("month").alias("start"),
        F.max("month").alias("end"),
        F.count("*").alias("total_months"),
        F.max("_reference").alias("reference_date"),
        F.sum("revenue").alias("total"),
        F.sum("orders").alias("orders"),
        F.coalesce(F.sum(F.when(month > year_ago, F.col("revenue"))), none).alias("last_12"),
        F.coalesce(
            F.sum(F.when((month > two_years_ago) & (month <= year_ago), F.col("revenue"))), none
        ).alias("prev_12"),
        rounded(exact_avg(F.when(F.col("_mom_rank") <= 6, F.col("mom_growth_pct"))), 1).alias("mom6"),
        rounded(exact_avg(F.when(F.col("_yoy_rank") <= 3, F.col("yoy_growth_pct"))), 1).alias("yoy3"),
    )
    return sums.select(
        F.struct(
            month_label("start").alias("start"),
            month_label("end").alias("end"),
            "total_months",
            F.date_format("reference_date", "yyyy-MM-dd").alias("reference_date"),
        ).alias("period"),
        F.col("total").alias("_total"),
        F.col("last_12").alias("_last_12"),
        F.col("prev_12").alias("_prev_12"),
        F.col("orders").alias("_orders"),
        F.struct(
            F.when(F.col("prev_12") > 0, growth_pct("last_12", "prev_12", 1)).alias("yoy_pct"),
            F.col("mom6").alias("avg_mom_pct_last6m"),
            F.col("yoy3").alias("avg_yoy_pct_last3m"),
        ).alias("growth"),
    )


def _products(products: DataFrame) -> DataFrame:
    """Counts, list-price margin weighted by revenue, first and last product by revenue."""
    facts = F.struct("name", "total_revenue", "margin_pct")
    best_first = F.struct(-F.col("total_revenue"), F.col("id"))
    margin = F.col("margin_pct").cast("decimal(10,1)")
    sums = products.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("abc_class") == "A").alias("a"),
        F.sum(F.col("total_revenue").cast("decimal(24,2)") * margin).alias("weighted"),
        F.sum("total_revenue").alias("revenue"),
        F.min_by(facts, best_first).alias("top"),
        F.max_by(facts, best_first).alias("worst"),
    )
    return sums.select(
        rounded(ratio("weighted", "revenue"), 1).alias("_margin"),
        F.struct(
            F.col("n").alias("total_products"),
            F.col("a").alias("a_class_count"),
            F.col("top.name").alias("top_product_name"),
            F.col("top.total_revenue").alias("top_product_revenue"),
            F.col("top.margin_pct").alias("top_product_margin"),
            F.col("worst.name").alias("worst_product_name"),
        ).alias("products"),
    )


def _customers(customer_stats: DataFrame, segments: DataFrame) -> DataFrame:
    """Customer counts and means; the order value is the mean of the customers' means."""
    stats = customer_stats.agg(
        F.count("*").alias("n"),
        rounded(exact_avg("total_revenue"), 2).alias("clv"),
        rounded(exact_avg("avg_order_value"), 2).alias("_order_value"),
    )
    counts = segments.agg(
        F.count_if(F.col("rfm_segment") == "Champions").alias("champions"),
        F.count_if(F.col("rfm_segment") == "At Risk").alias("at_risk"),
    )
    return beside(stats, counts).select(
        "_order_value",
        F.struct(
            F.col("n").alias("active_total"),
            F.col("clv").alias("avg_clv"),
            F.col("champions").alias("champions_count"),
            F.col("at_risk").alias("at_risk_count"),
            percent_of("champions", "n", 1).alias("champions_pct"),
        ).alias("customers"),
    )


def _places(region_channel: DataFrame) -> DataFrame:
    """Best and worst region and best channel; ties go to the first name."""
    revenue = F.col("revenue")
    regions = region_channel.groupBy("region").agg(F.sum("revenue").alias("revenue")).agg(
        F.min_by("region", F.struct(-revenue, F.col("region"))).alias("best_region"),
        F.min_by("region", F.struct(revenue, F.col("region"))).alias("worst_region"),
        F.max("revenue").alias("best_region_revenue"),
        F.min("revenue").alias("worst_region_revenue"),
    )
    channels = region_channel.groupBy("channel").agg(F.sum("revenue").alias("revenue")).agg(
        F.min_by("channel", F.struct(-revenue, F.col("channel"))).alias("best_channel")
    )
    return beside(regions, channels).select(
        F.struct(
            "best_region", "worst_region", "best_channel", "best_region_revenue", "worst_region_revenue"
        ).alias("top_performers")
    )


def kpis(
    growth: DataFrame,
    products: DataFrame,
    region_channel: DataFrame,
    customer_stats: DataFrame,
    segments: DataFrame,
    reference_date: dt.date | str | None = None,
) -> DataFrame:
    """The KPI record.

    ``growth`` is the month table with growth rates, ``products`` the classified products,
    ``segments`` the RFM table. The reference date defaults to the last month.
    """
    record = _months(growth, reference_date)
    for part in (_products(products), _customers(customer_stats, segments), _places(region_channel)):
        record = beside(record, part)
    return record.select(
        "period",
        F.struct(
            F.col("_total").alias("total"),
            F.col("_last_12").alias("last_12_months"),
            F.col("_prev_12").alias("prev_12_months"),
            F.col("_orders").alias("total_orders"),
            F.col("_margin").alias("gross_margin_pct"),
            F.col("_order_value").alias("avg_order_value"),
        ).alias("revenue"),
        "growth", "products", "customers", "top_performers",
    )


def flat(record: DataFrame) -> DataFrame:
    """The record with one column per field, named section_field."""
    columns = [
        F.col(f"{section}.{field}").alias(f"{section}_{field}")
        for section in SECTIONS
        for field in record.schema[section].dataType.fieldNames()
    ]
    return record.select(*columns)


def kpi_display(record: DataFrame) -> DataFrame:
    """Twelve formatted strings."""
    return record.select(
        euro("revenue.total").alias("total_revenue"),
        euro("revenue.last_12_months").alias("revenue_12m"),
        percent("growth.yoy_pct", signed=True).alias("yoy_growth"),
        percent("growth.avg_mom_pct_last6m", signed=True).alias("mom_growth_avg"),
        percent("revenue.gross_margin_pct").alias("gross_margin"),
        euro("revenue.avg_order_value").alias("avg_order_value"),
        whole("customers.active_total").alias("active_customers"),
        percent("customers.champions_pct").alias("champions_pct"),
        F.col("top_performers.best_region").alias("best_region"),
        F.col("top_performers.worst_region").alias("worst_region"),
        F.col("top_performers.best_channel").alias("best_channel"),
        F.col("products.top_product_name").alias("top_product"),
    )


def dashboard_cards(record: DataFrame) -> DataFrame:
    """Four cards: title, value, line below, and whether it is good news."""
    yoy, mom = F.col("growth.yoy_pct"), F.col("growth.avg_mom_pct_last6m")
    millions = F.format_string("€%.2fM", F.round(F.col("revenue.total") / F.lit(1_000_000).cast("decimal(7,0)"), 2).cast("double"))
    signed = F.format_string("%+.1f%%", mom)

    def card(number: int, title: str, value: Column, below: Column, positive: Column) -> Column:
        return F.struct(
            F.lit(number).alias("card"), F.lit(title).alias("title"), value.alias("value"),
            below.alias("sub"), positive.alias("positive"),
        )

    def rising(x: Column) -> Column:
        return F.coalesce(x > 0, F.lit(False))

    cards = F.array(
        card(1, "TOTAL REVENUE", millions,
             F.when(yoy.isNull(), "").otherwise(F.concat(percent(yoy, signed=True), F.lit(" YoY"))), rising(yoy)),
        card(2, "Ø MOM GROWTH", F.when(mom.isNull(), "N/A").otherwise(signed), F.lit("Last 6 months"), rising(mom)),
        card(3, "GROSS MARGIN", percent("revenue.gross_margin_pct"), F.lit("Weighted mean margin"), F.lit(True)),
        card(4, "ACTIVE CUSTOMERS", whole("customers.active_total"),
             F.concat(percent("customers.champions_pct"), F.lit(" Champions")), F.lit(True)),
    )
    return sorted_small(record.select(F.inline(cards)), "card")


def kpi_table(record: DataFrame) -> DataFrame:
    """Fifteen rows: KPI, number or text, unit, period."""
    span = F.concat_ws(" – ", "period.start", "period.end")

    def row(position: int, kpi: str, unit: str, period: str | Column, number: str = "", text: str = "") -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(kpi).alias("kpi"),
            (double(number) if number else F.lit(None).cast("double")).alias("value"),
            (F.col(text) if text else F.lit(None).cast("string")).alias("text"),
            F.lit(unit).alias("unit"),
            (F.lit(period) if isinstance(period, str) else period).alias("period"),
        )

    # fixed values: the rows of the KPI table with their labels, units and periods, in its order
    rows = [
        row(1, "Total revenue", "€", span, "revenue.total"),
        row(2, "Revenue (last 12 months)", "€", "last 12 months", "revenue.last_12_months"),
        row(3, "Revenue (12 months before)", "€", "12 months before", "revenue.prev_12_months"),
        row(4, "YoY growth", "%", "YoY", "growth.yoy_pct"),
        row(5, "Mean MoM growth", "%", "last 6 months", "growth.avg_mom_pct_last6m"),
        row(6, "Gross margin", "%", "weighted", "revenue.gross_margin_pct"),
        row(7, "Orders", "orders", "total", "revenue.total_orders"),
        row(8, "Active customers", "customers", "total", "customers.active_total"),
        row(9, "Mean order value", "€", "mean", "revenue.avg_order_value"),
        row(10, "Champions", "customers", "current", "customers.champions_count"),
        row(11, "At risk", "customers", "current", "customers.at_risk_count"),
        row(12, "Best region", "", "", text="top_performers.best_region"),
        row(13, "Worst region", "", "", text="top_performers.worst_region"),
        row(14, "Best channel", "", "", text="top_performers.best_channel"),
        row(15, "Top product", "", "", text="products.top_product_name"),
    ]
    return sorted_small(record.select(F.inline(F.array(*rows))), "position")


def insight_facts(record: DataFrame) -> DataFrame:
    """Ratings, the gap between regions, revenue that could be won back, and next year's outlook."""
    yoy = F.coalesce(F.col("growth.yoy_pct"), F.lit(0.0))
    margin = F.coalesce(F.col("revenue.gross_margin_pct"), F.lit(0.0))
    best, worst = F.col("top_performers.best_region_revenue"), F.col("top_performers.worst_region_revenue")
    lost = F.col("customers.at_risk_count") * F.coalesce(F.col("revenue.avg_order_value"), F.lit(100.0)) * 0.2
    return record.select(
        F.when(yoy > 10, "strong").when(yoy > 0, "moderate").otherwise("declining").alias("growth_rating"),
        F.when(margin > 30, "healthy").otherwise("pressured").alias("margin_rating"),
        (best - worst).alias("region_gap"),
        percent_of(best - worst, F.greatest(worst, F.lit(1).cast("decimal(28,2)")), 0).alias("region_gap_pct"),
        rounded(lost, 2).alias("recovery_potential"),
        F.round(F.col("revenue.total") * F.lit("1.1").cast("decimal(2,1)"), 2).alias("outlook_revenue"),
    )
