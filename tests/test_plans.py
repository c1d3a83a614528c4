"""Physical plans: what reaches the scan, what is shuffled, and what never runs in one task."""

import pytest
from pyspark.sql import Window, functions as F

from tillwise.operators import joins, marts, ordered
from tillwise.plans.catalog import registered
from tillwise.sources.retail import retail_tables
from tillwise.sources.tables import Tables, load_tables, save_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return retail_tables(spark, FOLDER)


def scan_of(text: str, column: str) -> str:
    return next(line for line in text.splitlines() if "FileScan" in line and column in line)


def test_scan_reads_only_what_is_used(tables):
    text = plan(tables.sales.groupBy("channel").agg(F.sum("revenue")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "p_partkey" not in text


def test_date_filter_reaches_the_scan(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(marts.monthly_revenue(tables.during("2000-01-01", "2000-12-31").sales))
    pushed = scan_of(text, "o_orderdate")
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in pushed and "LessThan(o_orderdate,2001-01-01T00:00)" in pushed


@pytest.fixture
def below_line_items(spark):
    """A broadcast limit below the size of the line items, as it is for any real table; orders of a day stay under it."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for key in keys:
        spark.conf.set(key, "16KB")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def final_plan(df) -> str:
    """The plan as the adaptive planner left it; run by way of the frame itself, so that it is the one executed."""
    df.collect()
    text = plan(df)
    return text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


def build_side_has(text: str, column: str) -> bool:
    """Whether a broadcast holds rows read with the column."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line or "BroadcastQueryStage" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1 :]:
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
                if "FileScan" in below and column in below:
                    return True
    return False


def test_narrow_period_ends_in_a_broadcast_of_the_orders(below_line_items):
    tables = retail_tables(below_line_items, FOLDER)
    text = final_plan(marts.quarterly_revenue(tables.during("1998-03-01", "1998-03-07").sales))
    assert build_side_has(text, "o_orderkey") and not build_side_has(text, "l_orderkey")


def test_whole_history_merges(below_line_items):
    tables = retail_tables(below_line_items, FOLDER)
    text = final_plan(marts.quarterly_revenue(tables.sales))
    assert "SortMergeJoin" in text and not build_side_has(text, "l_orderkey")


def test_period_over_loaded_tables_needs_no_join(spark, tables, tmp_path):
    save_tables(tables, str(tmp_path))
    text = plan(marts.quarterly_revenue(load_tables(spark, str(tmp_path)).during("1998-03-02", "1998-03-02").sales))
    assert "Join" not in text and "GreaterThanOrEqual(date,1998-03-02)" in text


def test_overview_moves_no_single_sale_to_its_product(large_plans):
    text = plan(marts.kpi_overview(hot_tables(large_plans)))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(product_id" in line:
            assert "HashAggregate" in lines[i + 1] or "Project" in lines[i + 1] or "*(" in lines[i + 1]
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert any("HashAggregate(keys=[product_id" in line for line in lines[join:])


@pytest.mark.parametrize("name", ["top_products_revenue_margin", "customer_lifetime_value"])
def test_facts_are_summed_before_the_dimension_join(spark, name):
    lines = plan(registered()[name](spark, FOLDER)).splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    first_sum = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert first_join < first_sum  # the join sits above the aggregate


def test_numbering_has_no_single_partition_exchange_of_rows(spread):
    df = spread.range(1000).select("id", (F.col("id") % 7).alias("v"))
    text = plan(ordered.running_sum(df, ["v", "id"], "v"))
    # the one single-partition step is the prefix over one row per partition
    rows_side = text[: text.index("BroadcastExchange")]
    assert "SinglePartition" not in rows_side
    single = plan(df.withColumn("r", F.sum("v").over(Window.orderBy("v", "id"))))
    assert "SinglePartition" in single


def test_hot_product_is_one_row_in_the_join(spark, make_tables):
    """A third of the sales on one product: the join sees one row of it."""
    t = make_tables([(1, "Hot", "C", "1.00", "1.00"), (2, "Cold", "C", "1.00", "1.00")], [(1, "A", "N", "B2B")],
                    [("2024-01-01", 1 if i % 3 == 0 else 2, 1, 1, "1.00", "B2B") for i in range(90)])
    assert marts.sums_by_product(t.sales).count() == 2
    got = {r["name"]: r["total_orders"] for r in marts.top_products_revenue_margin(t).collect()}
    assert got == {"Hot": 30, "Cold": 60}


@pytest.fixture
def large_plans(spark):
    """Shuffled joins and small skew limits, so that small data is planned as large data would be."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_tables(spark, rows=60_000):
    """Sales of which a third are of one product by one customer, spread over several files' worth of tasks."""
    hot = F.col("n") % 3 == 0
    sales = spark.range(0, rows, 1, 8).toDF("n").select(
        F.col("n").alias("id"), F.expr("date_add(date'2024-01-01', int(n % 300))").alias("date"),
        F.when(hot, 1).otherwise(F.col("n") % 997).cast("long").alias("product_id"),
        F.when(hot, 1).otherwise(F.col("n") % 499).cast("long").alias("customer_id"),
        F.lit(1).alias("quantity"), (F.xxhash64("n") % 100_000 / 100 + 2_000).cast("decimal(18,2)").alias("revenue"),
        F.lit("N").alias("region"), F.lit("B2B").alias("channel"),
    )
    products = spark.range(1000).select(
        "id", F.concat(F.lit("p"), "id").alias("name"), F.lit("c").alias("category"),
        F.lit("3.00").cast("decimal(18,2)").alias("price"), F.lit("1.00").cast("decimal(18,2)").alias("cost"),
    )
    customers = spark.range(500).select(
        "id", F.lit("A").alias("segment"), F.lit("N").alias("region"), F.lit("B2B").alias("acquisition_channel")
    )
    return Tables(products, customers, sales)


@pytest.mark.parametrize("mart, rows", [(marts.raw_sales, 60_000)])
def test_hot_key_is_split_in_a_join_of_single_sales(large_plans, mart, rows):
    df = mart(hot_tables(large_plans))
    assert len(df.collect()) == rows
    assert "SortMergeJoin(skew=true)" in plan(df)


@pytest.fixture
def no_help(spark):
    """Shuffled joins without the adaptive rules."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_keys_are_measured_and_split(no_help, how):
    """Half the sales are of one product: with neither broadcast nor the adaptive rule no task gets three times the median."""
    n = 80_000
    sales = no_help.range(0, n, 1, 8).selectExpr("id", "IF(id % 2 = 0, 7, id % 997) AS product_id", "id % 5 AS quantity")
    products = no_help.range(900).selectExpr("id AS product_id", "concat('p', id) AS name")
    assert joins.heavy_keys(sales, "product_id", piece=500)[0][0] == 7
    plain, split = sales.join(products, "product_id", how), joins.split_join(sales, products, "product_id", how, piece=500)
    assert sorted(map(tuple, split.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)

    def sizes(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    before, after = sizes(plain), sizes(split)
    assert before[-1] > 10 * before[len(before) // 2] and after[-1] < 3 * after[len(after) // 2]


def test_raw_sales_with_split_joins_are_the_same(no_help, monkeypatch):
    monkeypatch.setattr(joins, "PIECE", 500)
    monkeypatch.setattr(joins.split_join, "__defaults__", ("inner", 500, None))
    tables = hot_tables(no_help, 20_000)
    plain, split = marts.raw_sales(tables), marts.raw_sales(tables, split=True)
    assert "_number" in plan(split) and sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_without_heavy_keys_the_join_is_plain(spark):
    assert joins.heavy_keys(spark.range(1000), "id") == [] and joins.heavy_keys(spark.range(0), "id") == []
    assert "_number" not in plan(joins.split_join(spark.range(1000), spark.range(10), "id"))


def test_hot_key_needs_no_split_where_sales_are_summed_first(large_plans):
    df = marts.top_products_revenue_margin(hot_tables(large_plans))
    got = {r["id"]: r["total_orders"] for r in df.collect()}
    assert "skew=true" not in plan(df)
    assert sum(got.values()) == 60_000 and got[1] > 20_000
