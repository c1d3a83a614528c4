"""Products, customers and sales out of the order-entry tables of a wholesale schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.sources.tables import Tables


# the columns used here; naming them saves a job per table that would look them up
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_discount double",
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def retail_tables(spark: SparkSession, folder: str) -> Tables:
    """The three input tables over ``folder``.

    Orders meet their customers first: that join moves only orders. The line items, the one table
    of full size, are then shuffled at most once, on the order key. No join is hinted: over the whole
    history both sides are large and merge, and over a narrow period the adaptive planner sees the few orders
    that are left and broadcasts them. A hot order or customer is split by the adaptive skew rule, and
    the other side holds one row per key.
    """
    products = _read(spark, folder, "part").selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "p_type AS category",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS price",
        """CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(40 + p_size AS DECIMAL(4,0))
                * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost""",
    )

    nation, region = _read(spark, folder, "nation"), _read(spark, folder, "region")
    places = nation.join(region, F.expr("n_regionkey = r_regionkey"))
    customers = _read(spark, folder, "customer").join(places, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS id",
        "c_mktsegment AS segment",
        "r_name AS region",
        "CASE c_custkey % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'Store' ELSE 'B2B' END AS acquisition_channel",
    )

    buyers = customers.selectExpr("id AS customer_id", "region")
    headers = _read(spark, folder, "orders").join(buyers, F.expr("o_custkey = customer_id")).selectExpr(
        "o_orderkey AS id",
        "CAST(o_orderdate AS DATE) AS date",
        "customer_id",
        "region",
        "CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'Store' ELSE 'B2B' END AS channel",
    )
    sales = _read(spark, folder, "lineitem").join(headers, F.expr("l_orderkey = id")).selectExpr(
        "id",
        "date",
        "l_partkey AS product_id",
        "customer_id",
        "CAST(l_quantity AS INT) AS quantity",
        """CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                AS DECIMAL(18,2)) AS revenue""",
        "region",
        "channel",
    )
    return Tables(products, customers, sales)
