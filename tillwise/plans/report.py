"""The whole report: check the tables, run every mart and analysis, write each result as a dataset."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.text import as_reported
from tillwise.operators import customers, kpis, marts, matrix, products, reports, timeseries
from tillwise.plans.model import SalesModel
from tillwise.session import scratch
from tillwise.sources.checks import breaches, contract_of, validate
from tillwise.sources.sinks import publish_datasets
from tillwise.sources.tables import SCHEMAS, Tables

logger = logging.getLogger(__name__)


@dataclass
class ReportResult:
    success: bool
    datasets: dict[str, str | None] = field(default_factory=dict)
    seconds: float = 0.0
    error: str | None = None
    warnings: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)


def mart_datasets(model: SalesModel) -> dict[str, Callable[[], DataFrame]]:
    """The marts by name, all from the rollup; the denormalised fact is left out, it is as large as the sales."""
    tables, m = model.tables, model
    return {
        "monthly_revenue": lambda: marts.months_of(m.rollup.by_month_and_customer()),
        "quarterly_revenue": lambda: marts.quarters_of(m.rollup.by_month_and_customer()),
        "revenue_by_region_channel": lambda: marts.places_of(m.rollup.by_place_and_customer()),
        "revenue_by_region_month": lambda: m.rollup.by_month_and_region().orderBy("month", "region"),
        "top_products_revenue_margin": lambda: m.product_stats.orderBy(F.desc("total_revenue"), "id"),
        "product_monthly_revenue": lambda: marts.named_months(m.rollup.by_month_and_product(), tables.products),
        "category_revenue_share": lambda: marts.category_shares(m.rollup.by_product(), tables.products),
        "customer_lifetime_value": lambda: m.customer_stats.orderBy(F.desc("total_revenue"), "customer_id"),
        "acquisition_channel_efficiency": lambda: marts.channel_efficiency(m.rollup.by_customer(), tables.customers),
        "kpi_overview": lambda: marts.overview(m.rollup.by_buyer(), tables.products),
    }


def report_datasets(model: SalesModel, min_orders: int = 2) -> dict[str, Callable[[], DataFrame]]:
    """Analyses, report tables and chart data by name, all from one model."""
    m = model
    return {
        "kpis": lambda: kpis.flat(m.kpis),
        "kpi_display": lambda: kpis.kpi_display(m.kpis),
        "kpi_table": lambda: kpis.kpi_table(m.kpis),
        "dashboard_cards": lambda: kpis.dashboard_cards(m.kpis),
        "insight_facts": lambda: kpis.insight_facts(m.kpis),
        "monthly_growth": lambda: m.growth,
        "trend_signals": lambda: timeseries.trend_signals(m.growth),
        "top_bottom_months": lambda: reports.top_bottom_months(m.growth),
        "revenue_trend_forecast": lambda: timeseries.trend_forecast(m.rollup.by_month()),
        "dashboard_months": lambda: timeseries.dashboard_months(m.growth),
        "mom_bars": lambda: timeseries.mom_bars(m.growth),
        "yoy_compare": lambda: timeseries.yoy_compare(m.rollup.by_month(), m.year),
        "quarter_totals": lambda: timeseries.quarter_totals(m.growth),
        "november_peak": lambda: timeseries.november_peak(m.rollup.by_month()),
        "region_month_heatmap": lambda: matrix.region_month_heatmap(
            m.rollup.by_month_and_region(), matrix.column_values(m.region_channel, "region")
        ),
        "revenue_matrix": lambda: matrix.revenue_matrix(m.region_channel),
        "region_matrix_export": lambda: matrix.revenue_matrix(
            m.region_channel, row_total="Gesamt", column_total="GESAMT", by_total=False
        ),
        "abc_analysis": lambda: m.classified_products.orderBy(F.desc("total_revenue"), "id"),
        "abc_summary": lambda: products.abc_summary(m.classified_products),
        "top10_products": lambda: reports.top_products(m.classified_products, 10),
        "product_export": lambda: reports.product_export(m.classified_products),
        "bcg_matrix": lambda: products.bcg_matrix(m.growth_matrix),
        "product_matrix_points": lambda: products.product_matrix_points(m.growth_matrix),
        "rfm": lambda: m.segments,
        "rfm_segment_share": lambda: customers.rfm_segment_share(m.segments),
        "rfm_segment_summary": lambda: customers.rfm_segment_summary(m.segments),
        "clv_by_segment": lambda: customers.clv_by_segment(m.customer_stats, min_orders),
        "churn_risk": lambda: customers.churn_risk(m.customer_stats, m.reference_date),
        "churn_distribution": lambda: customers.churn_distribution(
            customers.churn_risk(m.customer_stats, m.reference_date, ordered=False)
        ),
        "rfm_scatter_points": lambda: customers.rfm_scatter_points(m.segments),
        "prompt_top5_products": lambda: reports.top_products(m.classified_products, 5),
    }


def run_report(
    tables: Tables,
    folder: str,
    year: int,
    fmt: str = "parquet",
    start: str | None = None,
    end: str | None = None,
    reference_date: str | None = None,
    min_orders: int = 2,
) -> ReportResult:
    """Write all results under ``folder`` and publish them together; the result has their paths and row counts.

    A table without its columns or rows, or a dimension that breaks its contract, ends the run; sales that lack values or
    a dimension row are a warning. After that every dataset stands alone: one that fails is logged and reported as
    None, and the others are still written. The sales are read once, by the rollup, from which the check starts, too.
    Parquet keeps decimals and dates; CSV gets them as they are reported. A period may be open at either side.
    """
    began = time.monotonic()
    for name, schema in SCHEMAS.items():
        if not validate(getattr(tables, name), name, schema.fieldNames()):
            return ReportResult(False, seconds=time.monotonic() - began, error=f"table {name} failed its check")
    tables = tables.during(start, end)
    with scratch(tables.sales.sparkSession):
        model = SalesModel(tables, year, reference_date)
        errors, warnings = breaches(contract_of(model.rollup.used_keys(), tables.products, tables.customers).collect())
        for warning in warnings:
            logger.warning(warning)
        if errors:
            return ReportResult(False, seconds=time.monotonic() - began, error="; ".join(errors), warnings=warnings)
        builders = {**mart_datasets(model), **report_datasets(model, min_orders)}
        if fmt == "csv":
            builders = {name: (lambda build=build: as_reported(build())) for name, build in builders.items()}
        written = publish_datasets(builders, folder, fmt)
    paths = {name: entry and entry.path for name, entry in written.items()}
    rows = {name: entry.rows for name, entry in written.items() if entry}
    logger.info("%d of %d datasets written, %d rows", len(rows), len(written), sum(rows.values()))
    return ReportResult(paths["monthly_growth"] is not None, paths, time.monotonic() - began, warnings=warnings, rows=rows)
