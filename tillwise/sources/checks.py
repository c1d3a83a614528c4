"""Contract checks at the border between tables and analyses."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from tillwise.operators.rollup import missing_values
from tillwise.sources.tables import SCHEMAS, Tables

logger = logging.getLogger(__name__)


def validate(df: DataFrame | None, name: str, required: Sequence[str], min_rows: int = 1) -> bool:
    """Whether ``df`` has the required columns and at least ``min_rows`` rows; reads no more rows."""
    if df is None:
        logger.error("%s: no table", name)
        return False
    missing = [c for c in required if c not in df.columns]
    if missing:
        logger.error("%s: missing columns %s", name, missing)
        return False
    found = df.limit(max(min_rows, 1)).count()
    if found == 0:
        logger.error("%s: empty", name)
        return False
    if found < min_rows:
        logger.warning("%s: only %d rows, %d wanted", name, found, min_rows)
        return False
    return True


def _base(df: DataFrame, name: str) -> DataFrame:
    columns = [f.name for f in SCHEMAS[name].fields]
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(missing_values(columns)), F.lit(0)).alias("missing_values"),
        F.countDistinct("id").alias("ids"),
    ).select(
        F.lit(name).alias("table_name"), "row_count", "missing_values", (F.col("row_count") - F.col("ids")).alias("repeated_ids")
    )


def used_keys(sales: DataFrame) -> DataFrame:
    """kind, key, n, gaps: how often sales name each product and customer, and how many values those sales lack.

    Both keys of a sale are counted together, per kind and key, so a hot key is one row in what follows.
    """
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_id").alias("key")) for k in ("product", "customer")])
    rows = sales.select(F.inline(keys), missing_values(sales.columns).alias("gaps"))
    return rows.groupBy("kind", "key").agg(F.count("*").alias("n"), F.sum("gaps").alias("gaps"))


def contract_report(tables: Tables) -> DataFrame:
    """Per table: rows, missing values, repeated ids, and facts without their dimension row, in one pass over each.

    Ids of sales are not counted: a sale bears the number of its order, which has several lines.
    """
    return contract_of(used_keys(tables.sales), tables.products, tables.customers)


def contract_of(used: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from ``used_keys``."""
    none = F.lit(0).cast("long")
    dimensions = _base(products, "products").unionByName(_base(customers, "customers"))
    known = [df.select(F.lit(kind).alias("kind"), F.col("id").alias("key")).distinct() for kind, df in (("product", products), ("customer", customers))]
    marked = used.join(known[0].unionByName(known[1]).withColumn("known", F.lit(True)), ["kind", "key"], "left")

    def total(value: str, *where: Column) -> Column:
        held = F.lit(True)
        for condition in where:
            held = held & condition
        return F.coalesce(F.sum(F.when(held, F.col(value))), none)

    product, customer, unknown = F.col("kind") == "product", F.col("kind") == "customer", F.col("known").isNull()
    facts = marked.agg(
        total("n", product).alias("row_count"),
        total("gaps", product).alias("missing_values"),
        total("n", product, unknown).alias("unknown_products"),
        total("n", customer, unknown).alias("unknown_customers"),
    ).select(F.lit("sales").alias("table_name"), "row_count", "missing_values", F.lit(None).cast("long").alias("repeated_ids"), "unknown_products", "unknown_customers")
    return dimensions.withColumns({"unknown_products": none, "unknown_customers": none}).unionByName(facts).orderBy("table_name")


def breaches(report: list[Row]) -> tuple[list[str], list[str]]:
    """(errors, warnings) of a collected contract report.

    A dimension with missing values or repeated ids would change every join and is an error; sales that lack values or a
    dimension row are left out where they do not fit, so they are a warning.
    """
    errors, warnings = [], []
    for row in report:
        (warnings if row.table_name == "sales" else errors).extend(
            f"{row.table_name}: {row[name]} {name.replace('_', ' ')}"
            for name in ("missing_values", "repeated_ids", "unknown_products", "unknown_customers") if row[name]
        )
    return errors, warnings
