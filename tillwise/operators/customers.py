"""RFM segments, customer lifetime value and churn risk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.numbers import double, exact_avg, percent_of, ratio, rounded
from tillwise.operators.joins import beside, sorted_small
from tillwise.operators.marts import sums_by_customer
from tillwise.operators.ordered import edges_of_counts, exact_quantile, value_bin
from tillwise.operators.selection import at_positions, bin_ends, bin_of
from tillwise.session import durable

_FIFTHS = (0.2, 0.4, 0.6, 0.8)


def _reference(rows: DataFrame, last: str, date: dt.date | str | None) -> DataFrame:
    """One row with the reference date: the one given, or the last date there is."""
    if date is None:
        return rows.agg(F.max(last).alias("reference_date"))
    return rows.sparkSession.range(1).select(F.lit(str(date)).cast("date").alias("reference_date"))


def rfm_segment(score: Column, r: Column, f: Column) -> Column:
    """Segment from the score sum and the recency and frequency scores; the first rule wins."""
    # fixed values: labels and limits of the segments, in order of precedence; the rule before the last cannot be
    # reached, since "At Risk" covers it, and stays as part of the definition
    return (
        F.when(score >= 13, "Champions")
        .when((score >= 10) & (r >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when(score >= 9, "Potential Loyalists")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f >= 3), "Lost Champions")
        .otherwise("Needs Attention")
    )


def rfm(sales: DataFrame, reference_date: dt.date | str | None = None) -> DataFrame:
    """Recency, frequency and monetary value per customer, scored 1 to 5, and the segment."""
    return rfm_from_sums(durable(sums_by_customer(sales)), reference_date)


def rfm_from_sums(by_customer: DataFrame, reference_date: dt.date | str | None = None) -> DataFrame:
    """RFM from one row per customer, a stored table.

    Frequency and monetary scores are fifths of a global rank, ties broken by customer: the last customer of each fifth is
    found by counting, the others are compared with it. Recency is cut at quantiles of the days themselves. The days form a
    small domain and are counted first.
    """
    base = by_customer.select(
        "customer_id",
        F.col("last_purchase").alias("last"),
        F.col("total_orders").alias("frequency"),
        F.col("total_revenue").alias("monetary"),
    )
    money = base.schema["monetary"].dataType
    fifths = len(_FIFTHS) + 1
    orders = at_positions(
        base, {"frequency": F.col("frequency").cast(money), "monetary": F.col("monetary")}, "customer_id", lambda n: bin_ends(n, fifths)
    )

    def score(value: str) -> Column:
        return bin_of(F.col(value), F.col("customer_id"), orders.get((value, ())), fifths).alias(f"{value[0]}_score")

    reference = _reference(base, "last", reference_date)
    recency = F.datediff("reference_date", "last").alias("recency")
    days = beside(base.groupBy("last").agg(F.count("*").alias("customers")), reference)
    edges = edges_of_counts(days.select(recency, "customers"), "recency", "customers", _FIFTHS)
    rows = beside(base, beside(reference, edges)).select(
        "customer_id", recency, "frequency", "monetary", "edges", score("frequency"), score("monetary")
    )
    r, f = F.col("r_score"), F.col("f_score")
    return (
        rows.withColumn("r_score", value_bin(F.col("recency"), F.col("edges"), len(_FIFTHS), reverse=True))
        .withColumn("rfm_score", r + f + F.col("m_score"))
        .select(
            "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score",
            rfm_segment(F.col("rfm_score"), r, f).alias("rfm_segment"),
        )
    )


def rfm_segment_share(segments: DataFrame) -> DataFrame:
    """Customers, their share and their revenue per segment, largest first."""
    per_segment = segments.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"), F.sum("monetary").alias("revenue")
    )
    everyone = F.sum("customers").over(Window.partitionBy())  # of the few segments
    return per_segment.select(
        "rfm_segment", "customers", percent_of("customers", everyone, 1).alias("share_pct"), "revenue"
    ).orderBy(F.desc("customers"), "rfm_segment")


def rfm_segment_summary(segments: DataFrame) -> DataFrame:
    """Customers, mean and total revenue, mean orders and mean recency per segment."""
    summary = segments.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"),
        rounded(exact_avg("monetary"), 2).alias("avg_revenue"),
        rounded(exact_avg("frequency"), 2).alias("avg_orders"),
        rounded(exact_avg("recency"), 2).alias("avg_recency_days"),
        F.sum("monetary").alias("total_revenue"),
    )
    return sorted_small(summary, "rfm_segment")


def rfm_scatter_points(segments: DataFrame) -> DataFrame:
    """What the scatter chart of the segments shows."""
    return segments.select("customer_id", "recency", "monetary", "frequency", "rfm_segment")


def clv_by_segment(customer_stats: DataFrame, min_orders: int = 2) -> DataFrame:
    """Lifetime value per segment over customers with at least ``min_orders`` orders.

    A lifespan counts at least a tenth of a year. The values are rounded to cents per customer and
    summed as decimals; the median is looked up by position, not gathered. The stats are read
    twice, so they should be a stored table.
    """
    years = F.greatest(F.col("customer_lifespan_days") / F.lit(365.0), F.lit(0.1))
    per_customer = (
        customer_stats.filter(F.col("total_orders") >= min_orders)
        .withColumn("lifespan_years", years)
        .withColumn("annual_purchase_freq", F.col("total_orders") / F.col("lifespan_years"))
        .withColumn(
            "clv_estimate",
            rounded(F.col("avg_order_value") * F.col("annual_purchase_freq") * F.col("lifespan_years"), 2),
        )
        .withColumn("clv_annualized", rounded(F.col("clv_estimate") / F.col("lifespan_years"), 2))
        .select("customer_id", "segment", "total_orders", "avg_order_value", "clv_estimate", "clv_annualized")
    )
    means = per_customer.groupBy("segment").agg(
        rounded(exact_avg("clv_estimate"), 2).alias("avg_clv"),
        rounded(exact_avg("clv_annualized"), 2).alias("avg_annual_clv"),
        rounded(exact_avg("total_orders"), 2).alias("avg_orders"),
        rounded(exact_avg("avg_order_value"), 2).alias("avg_order_value"),
        F.count("*").alias("customer_count"),
    )
    medians = exact_quantile(per_customer, "clv_estimate", "customer_id", by=["segment"])
    return (
        means.join(medians, "segment")
        .select(
            "segment", "avg_clv", rounded("quantile", 2).alias("median_clv"), "avg_annual_clv", "avg_orders",
            "avg_order_value", "customer_count",
        )
        .orderBy(F.desc("avg_clv"), "segment")
    )


def churn_risk(
    customer_stats: DataFrame, reference_date: dt.date | str | None = None, ordered: bool = True
) -> DataFrame:
    """Risk label per customer from days since the last purchase, value and relative frequency.

    Without a reference date the last purchase of all counts as today. The segment means come from
    an aggregate that is joined back, so a large segment is not gathered in one window partition.
    A customer without a segment stays; there is no mean to be seldom against, so that rule does not hold.
    The stats are read several times, so they should be a stored table.
    """
    stats = customer_stats.select("customer_id", "segment", "total_revenue", "total_orders", "last_purchase")
    segment_means = stats.groupBy("segment").agg(exact_avg("total_orders").alias("segment_orders"))
    facts = beside(
        stats.agg(exact_avg("total_revenue").alias("mean_revenue")),
        _reference(stats, "last_purchase", reference_date),
    )
    days = F.col("days_since_last_purchase")
    high_value = double("total_revenue") > F.col("mean_revenue")
    seldom = ratio("total_orders", "segment_orders") < 0.5
    # fixed values: day limits and labels
    risk = (
        F.when(days > 180, F.when(high_value, "critical").otherwise("high"))
        .when(days > 90, F.when(high_value, "high").otherwise("medium"))
        .when((days > 60) & seldom, "medium")
        .otherwise("low")
    )
    out = (
        beside(stats.join(segment_means, "segment", "left"), facts)
        .withColumn("days_since_last_purchase", F.datediff("reference_date", "last_purchase"))
        .select(
            "customer_id", "segment", "total_revenue", "total_orders", "days_since_last_purchase",
            risk.alias("churn_risk"),
        )
    )
    return out.orderBy("churn_risk", F.desc("total_revenue"), "customer_id") if ordered else out


def churn_distribution(risks: DataFrame) -> DataFrame:
    """Customers per risk label."""
    counts = risks.groupBy("churn_risk").agg(F.count("*").alias("customers"))
    return sorted_small(counts, F.desc("customers"), "churn_risk")
