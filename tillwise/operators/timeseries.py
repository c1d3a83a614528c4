"""Growth, rolling means, trend and comparisons over months.

The input is a month table: one row per month, or per month and series. Its length is bounded by
the calendar, so windows over all months of one series are small; series keys partition them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.dates import axis_month, is_fourth_quarter, month_index, quarter_label
from tillwise.functions.numbers import double, exact_avg, growth_pct, ratio, rounded, rounded_mean, safe_pct_change
from tillwise.operators.joins import sorted_small


def monthly_growth(monthly: DataFrame, series: Sequence[str] = (), calendar: bool = False) -> DataFrame:
    """Month-over-month and year-over-year growth, 3- and 6-row means, running revenue, quarter.

    The previous values are those one and twelve rows before. ``calendar`` looks for the month one
    and twelve months before instead, which differs where a month has no row.
    """
    in_order = Window.partitionBy(*series).orderBy("month")

    def earlier(steps: int) -> Column:
        if not calendar:
            return F.lag("revenue", steps).over(in_order)
        by_index = Window.partitionBy(*series).orderBy(month_index("month"))
        return F.max("revenue").over(by_index.rangeBetween(-steps, -steps))

    def trailing_mean(rows: int) -> Column:
        frame = in_order.rowsBetween(1 - rows, 0)
        return rounded_mean(F.sum("revenue").over(frame), F.count("revenue").over(frame))

    return (
        monthly.withColumns({"_month_ago": earlier(1), "_year_ago": earlier(12)})
        .withColumns({
            "mom_growth_pct": growth_pct("revenue", "_month_ago"),
            "yoy_growth_pct": growth_pct("revenue", "_year_ago"),
            "revenue_ma3": trailing_mean(3),
            "revenue_ma6": trailing_mean(6),
            "cumulative_revenue": F.sum("revenue").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
            "quarter": quarter_label("month"),
        })
        .drop("_month_ago", "_year_ago")
        .orderBy(*series, "month")
    )


def trend_forecast(monthly: DataFrame, ahead: int = 3) -> DataFrame:
    """Least-squares line over the month index, at every month and ``ahead`` months beyond.

    The forecast starts at the last known month, so that the two lines meet: that month yields its
    own row and those of the forecast.
    """
    everything = Window.partitionBy()
    x, y = double("idx"), double("revenue")
    indexed = monthly.select("month", "revenue").withColumn("idx", F.row_number().over(Window.orderBy("month")) - 1)
    lined = indexed.withColumns({
        "slope": F.regr_slope(y, x).over(everything),
        "intercept": F.regr_intercept(y, x).over(everything),
        "last_idx": F.max("idx").over(everything),
    })
    step = F.explode(F.when(F.col("idx") == F.col("last_idx"), F.sequence(F.lit(-1), F.lit(ahead))).otherwise(F.array(F.lit(-1))))
    fitted = F.col("step") < 0
    return (
        lined.select("*", step.alias("step"))
        .select(
            F.when(fitted, "fitted").otherwise("forecast").alias("kind"),
            (F.col("idx") + F.greatest(F.col("step"), F.lit(0))).alias("idx"),
            F.add_months("month", F.greatest(F.col("step"), F.lit(0))).alias("month"),
            F.when(fitted, F.col("revenue")).alias("revenue"),
            "slope", "intercept",
        )
        .withColumn("trend", rounded(F.col("intercept") + F.col("slope") * F.col("idx"), 2))
        .drop("slope", "intercept")
        .orderBy("idx", "kind")
    )


def dashboard_months(growth: DataFrame) -> DataFrame:
    """What the main chart shows per month: revenue, both rolling means, the line, the Q4 mark."""
    everything = Window.partitionBy()
    x = double(F.row_number().over(Window.orderBy("month")) - 1)
    return (
        growth.withColumn("idx", x)
        .withColumn("trend", rounded(
            F.regr_intercept(double("revenue"), F.col("idx")).over(everything)
            + F.regr_slope(double("revenue"), F.col("idx")).over(everything) * F.col("idx"), 2,
        ))
        .select(
            "month", axis_month("month").alias("label"), "revenue", is_fourth_quarter("month").alias("fourth_quarter"),
            "revenue_ma3", "revenue_ma6", "trend",
        )
        .orderBy("month")
    )


def mom_bars(growth: DataFrame) -> DataFrame:
    """Months with a growth rate, whether it is not negative, and the mean rate."""
    everything = Window.partitionBy()
    rate = F.col("mom_growth_pct").cast("decimal(28,8)")
    mean = ratio(F.sum(rate).over(everything), F.count(rate).over(everything))
    return (
        growth.select("month", "mom_growth_pct")
        .na.drop(subset=["mom_growth_pct"])
        .select(
            "month", "mom_growth_pct", (F.col("mom_growth_pct") >= 0).alias("not_negative"),
            rounded(mean, 2).alias("mean_mom_pct"),
        )
        .orderBy("month")
    )


def yoy_compare(monthly: DataFrame, year: int) -> DataFrame:
    """Months that both ``year`` and the year before have, side by side, in one pass."""
    which = F.year("month")

    def of(y: int) -> Column:
        return F.max(F.when(which == y, F.col("revenue")))

    pairs = (
        monthly.filter(which.isin(year - 1, year))
        .groupBy(F.month("month").alias("month_num"))
        .agg(of(year - 1).alias("revenue_before"), of(year).alias("revenue"))
        .na.drop()
    )
    return sorted_small(pairs.withColumn("grew", F.col("revenue") >= F.col("revenue_before")), "month_num")


def quarter_totals(growth: DataFrame) -> DataFrame:
    """Revenue per quarter label."""
    return sorted_small(growth.groupBy("quarter").agg(F.sum("revenue").alias("revenue")), "quarter")


def quarter_change(growth: DataFrame) -> DataFrame:
    """Quarter totals with the change against the quarter before, safe against 0."""
    before = F.lag("revenue").over(Window.orderBy("quarter"))
    return quarter_totals(growth).withColumn("change_pct", safe_pct_change(F.col("revenue"), before)).orderBy("quarter")


def november_peak(monthly: DataFrame) -> DataFrame:
    """The November with the highest revenue; the earliest if several reach it."""
    best_first = F.struct(-F.col("revenue"), F.col("month"))
    peak = monthly.filter(F.month("month") == 11).agg(F.min_by(F.struct("month", "revenue"), best_first).alias("peak"))
    return peak.filter("peak IS NOT NULL").select("peak.*")


def trend_signals(growth: DataFrame) -> DataFrame:
    """One row of signals: last month, recent growth, direction, extremes, volatility, Q4 boost."""
    known = F.col("mom_growth_pct").isNotNull()
    latest = Window.orderBy(F.desc("month"))
    latest_known = Window.orderBy(F.when(known, 0).otherwise(1), F.desc("month"))
    ranked = growth.withColumns({
        "_from_end": F.row_number().over(latest),
        "_known_from_end": F.row_number().over(latest_known),
    })

    def known_at(position: int) -> Column:
        return F.max(F.when(known & (F.col("_known_from_end") == position), F.col("mom_growth_pct")))

    label = F.date_format("month", "yyyy-MM")
    q4 = F.when(is_fourth_quarter("month"), F.col("revenue"))
    mean = ratio(F.sum("revenue"), F.count("revenue"))
    return ranked.agg(
        F.max(F.when(F.col("_from_end") == 1, F.col("revenue"))).alias("last_month_revenue"),
        rounded(exact_avg(F.when(F.col("_from_end") <= 3, F.col("mom_growth_pct"))), 2).alias("avg_mom_pct_last3m"),
        F.when(known_at(1) > known_at(3), "accelerating").otherwise("slowing").alias("mom_trend"),
        F.min_by(label, F.struct(-F.col("revenue"), F.col("month"))).alias("best_month"),
        F.min_by(label, F.struct(F.col("revenue"), F.col("month"))).alias("worst_month"),
        rounded(ratio(F.stddev_samp(double("revenue")), F.avg(double("revenue"))) * 100, 1).alias("volatility_pct"),
        F.coalesce(ratio(F.sum(q4), F.count(q4)) > mean * 1.2, F.lit(False)).alias("q4_boost"),
    )
