"""The three input tables: definition, load, read, and SQL over them."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from pathlib import PurePosixPath
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwise.functions.dates import in_period
from tillwise.session import exists
from tillwise.sources.publish import discard, name_tables, new_run, published, written

logger = logging.getLogger(__name__)

_MONEY = T.DecimalType(18, 2)

PRODUCTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("price", _MONEY, False),
    T.StructField("cost", _MONEY, False),
])
CUSTOMERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("segment", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("acquisition_channel", T.StringType(), False),
])
SALES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("revenue", _MONEY, False),
    T.StructField("region", T.StringType(), False),
    T.StructField("channel", T.StringType(), False),
])
SCHEMAS = {"products": PRODUCTS, "customers": CUSTOMERS, "sales": SALES}


class Tables(NamedTuple):
    """The input of every mart."""

    products: DataFrame
    customers: DataFrame
    sales: DataFrame

    def during(self, start: str | None = None, end: str | None = None) -> "Tables":
        """The same tables with the sales of one inclusive date range; a side that is not given is open."""
        return self._replace(sales=self.sales.filter(in_period("date", start, end)))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; text dates and double money are converted."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def save_tables(tables: Tables, folder: str, force: bool = False) -> None:
    """Load the three tables into ``folder`` as Parquet.

    A table that has been loaded is kept unless ``force``. All tables of a load are published at once, when the last one has been
    written; until then, and after a load that failed, readers get the tables of the load before. Sales are clustered by date, with the
    other keys behind it so that one busy day spreads over several files; the row-group
    statistics then let a date filter skip most of the table.
    """
    spark = tables.sales.sparkSession
    there = set() if force else set(published(spark, folder)) | {name for name in SCHEMAS if exists(spark, f"{_plain(folder, name)}/_SUCCESS")}
    run, entries = new_run(folder), {}
    try:
        for name, schema in SCHEMAS.items():
            if name in there:
                continue
            df = typed(getattr(tables, name), schema)
            if name == "sales":
                df = df.repartitionByRange("date", "id", "product_id").sortWithinPartitions("date")
            entries[name] = written(df, f"{run}/{name}")
            logger.info("%s: %d rows", name, entries[name].rows)
    except BaseException:
        discard(spark, run)
        raise
    if entries:
        name_tables(spark, folder, entries, keep_others=True)


def _plain(folder: str, name: str) -> str:
    """Where a table lies that was put there without a manifest."""
    return str(PurePosixPath(folder) / name)


def load_tables(spark: SparkSession, folder: str) -> Tables:
    """Read what ``save_tables`` wrote, or plain folders of the tables' names; a missing table is an error."""
    named = published(spark, folder)
    paths = [named[name].path if name in named else _plain(folder, name) for name in Tables._fields]
    return Tables(*[spark.read.schema(SCHEMAS[name]).parquet(path) for name, path in zip(Tables._fields, paths)])


def jdbc_tables(spark: SparkSession, url: str, partitions: int, **options: str) -> Tables:
    """Read the three tables from a database, each split over its id range into parallel reads."""

    def table(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).options(**options)
        low, high = reader.option("query", f"SELECT MIN(id), MAX(id) FROM {name}").load().first()
        split = {} if low is None else {
            "partitionColumn": "id", "lowerBound": low, "upperBound": high, "numPartitions": partitions,
        }
        return typed(
            spark.read.format("jdbc").option("url", url).options(**options).options(**split)
            .option("dbtable", name).load(),
            SCHEMAS[name],
        )

    return Tables(*[table(name) for name in Tables._fields])


def run_query(tables: Tables, query: str, params: Mapping[str, object] | list | None = None) -> DataFrame:
    """Run SQL over the tables, which it names ``{products}``, ``{customers}`` and ``{sales}``.

    The frames are bound to this query alone, so no view of the session is replaced. Parameters are bound by
    name (``:start``) or by position (``?``), never spliced into the text.
    """
    named = {name: getattr(tables, name) for name in Tables._fields if f"{{{name}}}" in query}
    return tables.sales.sparkSession.sql(query, args=params, **named)
