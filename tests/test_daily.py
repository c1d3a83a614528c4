"""The daily rollup: load, add and replace days, and what is read for it."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tillwise.operators import daily, marts
from tillwise.operators.daily import DailyRollup

DAY = dt.date(2024, 1, 1)


def sales_of(spark, rows):
    """rows (day number, product, customer, revenue, region, channel)"""
    data = [(i, None if d is None else DAY + dt.timedelta(d), p, c, 1 + i % 3, r, g, h) for i, (d, p, c, r, g, h) in enumerate(rows)]
    schema = "id long, date date, product_id long, customer_id long, quantity int, revenue double, region string, channel string"
    return spark.createDataFrame(data, schema).withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(i * 7 % 70, i % 5, i * i % 40_000, i / 4, "NS"[i % 2], ("Online", "Store", None)[i % 3]) for i in range(600)]
    rows += [(3, None, None, 5.0, None, "Online"), (None, 1, 1, 9.0, "N", "Store"), (80, 1, 2**40, 9.0, "N", "Store"), (80, 1, 2**40, 9.0, "N", "Store")]
    return sales_of(spark, rows)


def same(a, b):
    def key(row):
        return str(tuple(row[c] for c in sorted(row.asDict())))

    assert sorted(a.columns) == sorted(b.columns)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def check(rollup, sales):
    """Everything the rollup gives is what the sales give."""
    dated = sales.filter("date IS NOT NULL")
    same(rollup.monthly_revenue(), marts.monthly_revenue(dated))
    same(rollup.quarterly_revenue(), marts.quarterly_revenue(dated))
    same(rollup.revenue_by_region_channel(), marts.revenue_by_region_channel(dated))
    same(rollup.revenue_by_region_month(), marts.revenue_by_region_month(dated))
    same(rollup.by_product(), marts.sums_by_product(dated))
    same(rollup.by_customer(), marts.sums_by_customer(dated))


def test_load_add_and_replace(spark, sales, tmp_path):
    rollup = DailyRollup(spark, str(tmp_path))
    early = sales.filter("date < '2024-02-20'").withColumn("revenue", F.expr("CAST(revenue * IF(date = '2024-01-15', 2, 1) AS DECIMAL(18,2))"))
    rollup.merge(early)
    check(rollup, early)
    assert rollup.merge(sales.filter("date >= '2024-02-20'"))[0] >= dt.date(2024, 2, 20)
    assert rollup.merge(sales, [dt.date(2024, 1, 15)]) == [dt.date(2024, 1, 15)]
    check(rollup, sales)
    # a day without sales any more, and one that never had any
    rollup.merge(sales.filter("date != '2024-01-08'"), [dt.date(2024, 1, 8), dt.date(2030, 1, 1)])
    check(rollup, sales.filter("date != '2024-01-08'"))
    assert rollup.merge(sales.limit(0)) == []


def test_a_merge_reads_and_rewrites_its_own_day_only(spark, sales, tmp_path, monkeypatch):
    rollup = DailyRollup(spark, str(tmp_path / "rollup"))
    rollup.merge(sales)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "rollup" / "parts").rglob("*.parquet")}
    sales.withColumn("day", F.col("date")).write.partitionBy("day").parquet(str(tmp_path / "sales"))
    one = spark.read.parquet(str(tmp_path / "sales")).filter("day = DATE'2024-01-15'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan)  # the sales' own files of that day
    monkeypatch.setattr(DailyRollup, "rows", None)  # nothing that is stored is read
    rollup.merge(one.drop("day"), [dt.date(2024, 1, 15)])
    monkeypatch.undo()
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "rollup" / "parts").rglob("*.parquet")}
    new = set(after) - set(before)
    assert all(after[p] == t for p, t in before.items()) and {p.parent.name for p in new} == {"day=2024-01-15"}
    check(rollup, sales)


def test_a_period_lists_its_days_only(spark, sales, tmp_path):
    rollup = DailyRollup(spark, str(tmp_path))
    rollup.merge(sales)
    files = rollup.rows("place", "2024-01-10", "2024-01-16").inputFiles()
    days = {re.search(r"day=([\d-]+)", f)[1] for f in files}
    assert days == {d for d in rollup.days() if "2024-01-10" <= d <= "2024-01-16"} and len(days) < len(rollup.days()) / 5


@pytest.mark.parametrize("start, end", [(None, None), ("2024-01-10", "2024-02-03"), ("2024-03-01", None), ("2031-01-01", "2031-02-01")])
def test_buyers_of_any_period_from_bitmaps(spark, sales, tmp_path, start, end):
    rollup = DailyRollup(spark, str(tmp_path))
    rollup.merge(sales)
    part = sales.filter(F.col("date").between(start or "0001-01-01", end or "9999-01-01"))
    assert rollup.unique_buyers(start=start, end=end).first()[0] == part.select(F.countDistinct("customer_id")).first()[0]
    got = {r[0]: r[1] for r in rollup.unique_buyers(F.col("region"), start=start, end=end).collect() if r[1]}
    want = part.groupBy("region").agg(F.countDistinct("customer_id").alias("n")).filter("n > 0")
    assert got == {r.region: r.n for r in want.collect()}


def test_a_merge_that_ends_midway_changes_nothing(spark, sales, tmp_path, monkeypatch):
    rollup = DailyRollup(spark, str(tmp_path))
    rollup.merge(sales.filter("date < '2024-02-01'"))
    monkeypatch.setattr(daily, "name_tables", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        rollup.merge(sales)
    check(rollup, sales.filter("date < '2024-02-01'"))


def test_one_pass_over_the_sales(spark, sales):
    rows = daily._day_sums(sales)
    assert {r.level for r in rows.select("level").distinct().collect()} == {"product", "customer", "place", "buyers"}
    assert rows.filter("level = 'buyers'").agg(F.sum(F.bitmap_count("buyers"))).first()[0] == sales.filter("date IS NOT NULL").select(
        F.count_distinct("date", F.coalesce("region", F.lit("")), F.coalesce("channel", F.lit("")), "customer_id")
    ).first()[0]


def test_a_bitmap_takes_room_for_its_buyers_only(spark, tmp_path):
    far = [(d, 1, 1 + 5_003 * i, 1.0, "N", "Store") for d in range(2) for i in range(100)]
    rows = daily._day_sums(sales_of(spark, far)).filter("level = 'buyers'")
    room = rows.agg(F.sum(F.octet_length("buyers")), F.sum(F.size("at")), F.sum(F.bitmap_count("buyers"))).first()
    assert tuple(room) == (4 * 200, 200, 200)  # 4,096 bytes for each of the 32 bitmaps before


def test_full_bitmaps_and_bitmaps_stored_whole(spark, tmp_path):
    ids = spark.range(1, 2 * 32_768 + 1).filter("id <= 32768 OR id % 3 = 0")
    sales = ids.selectExpr(
        "id", "DATE'2024-01-01' AS date", "1L AS product_id", "id AS customer_id", "1 AS quantity", "CAST(1 AS DECIMAL(18,2)) AS revenue", "'N' AS region", "'Store' AS channel"
    )
    rollup = DailyRollup(spark, str(tmp_path))
    rollup.merge(sales)
    rollup.merge(sales.filter("id % 2 = 0").withColumn("date", F.lit(DAY + dt.timedelta(1))))
    assert rollup.unique_buyers().first()[0] == ids.count()
    assert rollup.unique_buyers(start="2024-01-02").first()[0] == ids.filter("id % 2 = 0").count()
    # a full one is the plain bitmap, and plain ones with words of zeros, as they were stored before, are read as such
    bucket, bit = F.bitmap_bucket_number("customer_id"), F.bitmap_bit_position("customer_id")
    plain = sales.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("plain"))
    stored = rollup.rows("buyers", end="2024-01-01").join(plain, "bucket")
    assert [r.at is None and bytes(r.buyers) == bytes(r.plain) for r in stored.collect()] == [True, True]
    few = spark.createDataFrame([(c,) for c in (1, 32, 33, 8_001, 32_768)], "customer_id long").agg(F.bitmap_construct_agg(bit).alias("buyers"))
    read = few.select(F.lit(None).cast("array<smallint>").alias("at"), "buyers").select(F.inline(daily._words("at", "buyers"))).filter("bits != 0")
    assert {(r.word, r.bits) for r in read.collect()} == {(0, 1 << 24 | 1 << 7), (1, 1 << 24), (250, 1 << 24), (1023, 1 << 7)}
