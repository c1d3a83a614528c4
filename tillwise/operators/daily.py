"""A rollup of the sales by day that is stored and kept up to date by merging.

Every day is a partition of its own with the day's partial sums by product, by place and by customer, and the day's buyers of each
place as bitmaps of customer ids, 32,768 to a bitmap. A day has few of a place's customers, so of a bitmap only the words of 32 bits
that are not zero are kept, and their places (``at``; null: all words): six bytes a buyer at most, however many customers there are. New days are added and late days replaced by reading their own sales
only; nothing that is stored is read. A merge is published in one step, so readers see it whole. Sums of any period are sums of its
days' sums; its distinct buyers are the bits of its days' bitmaps combined with OR, which is exact and needs no sale.

Sales without a date belong to no day and are left out, as they are of any period. A null product, customer or place is a key like
any other in the sums; a null customer is no buyer, as in COUNT(DISTINCT). Customer ids are whole numbers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwise.functions.dates import month_start, quarter_of_year
from tillwise.operators import marts
from tillwise.operators.joins import sorted_small
from tillwise.session import durable, scratch
from tillwise.sources.publish import Entry, discard, name_tables, new_run, published

ROWS = (
    "level string, date date, product_id long, customer_id long, region string, channel string, bucket long, "
    "revenue decimal(28,2), units long, orders long, buyers binary, at array<smallint>, sketch binary"
)
LISTING, FOLDERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 256  # and the folders that a task lists
# what a task of a merge gets of the joined sales: the partial sums of all levels take some 17 times as much of its memory
SHUFFLED, SHUFFLED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"
WORDS, WORD_BITS = 1024, 32  # of a bitmap
BUYERS = 1 << 18  # buyers of days that one task puts into bitmaps
SKETCH = 12  # binary logarithm of a sketch's slots
_LEVELS = {"product": ["product_id"], "customer": ["customer_id"], "place": ["region", "channel"], "buyer": ["region", "channel", "customer_id"]}
_KEYS = ["product_id", "customer_id", "region", "channel"]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _bitmaps(buyers: DataFrame, tasks: int) -> DataFrame:
    """The buyers (date, region, channel, customer_id) as bitmaps, in their words that are not zero.

    Only rows of one word are dealt out and sorted: a whole bitmap takes 4 KB of memory for a handful of buyers.
    """
    keys = ["date", "region", "channel", "bucket"]
    bit = F.bitmap_bit_position("customer_id")
    of_word = bit % WORD_BITS
    # the bytes of a word in their order in the bitmap, each with its lowest bit first
    shift = (24 - F.floor(of_word / 8) * 8 + of_word % 8).cast("int")
    words = (
        buyers.select("date", "region", "channel", F.bitmap_bucket_number("customer_id").alias("bucket"), bit.alias("bit"), shift.alias("shift"))
        .select(*keys, F.floor(F.col("bit") / WORD_BITS).cast("smallint").alias("word"), F.expr("shiftleft(1L, shift)").alias("bits"))
        .repartition(tasks, *keys)
        .groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )
    at = F.when(F.size("words") < WORDS, F.col("words.word"))
    whole = F.unhex(F.array_join(F.transform("words", lambda w: F.lpad(F.hex(w["bits"]), WORD_BITS // 4, "0")), ""))
    return words.select(*keys, at.alias("at"), whole.alias("buyers"))


def _words(at: str, buyers: str) -> Column:
    """The words of a bitmap as an array of (word, bits)."""
    size = WORD_BITS // 8
    places = f"coalesce({at}, CAST(sequence(0, {WORDS - 1}) AS array<smallint>))"
    return F.expr(f"transform({places}, (word, i) -> struct(word, CAST(conv(hex(substring({buyers}, i * {size} + 1, {size})), 16, 10) AS BIGINT) AS bits))")


def _day_sums(sales: DataFrame, sketches: bool = False) -> DataFrame:
    """The rows of every day, from one pass over its sales; a written table."""
    sets = [[F.col("date"), *map(F.col, keys)] for keys in _LEVELS.values()]
    marks = {sum(1 << (len(_KEYS) - 1 - i) for i, key in enumerate(_KEYS) if key not in keys): name for name, keys in _LEVELS.items()}
    level = F.coalesce(*[F.when(F.col("mark") == mark, name) for mark, name in marks.items()])
    seen = Observation()
    sums = durable(
        sales.filter("date IS NOT NULL").select("date", *_KEYS, "quantity", "revenue")
        .groupingSets(sets, "date", *_KEYS)
        .agg(F.grouping_id().alias("mark"), F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"), F.count("*").alias("orders"))
        .withColumn("level", level).drop("mark")
        .observe(seen, F.count_if(F.col("level") == "buyer").alias("buyers"))
    )
    found = sums.filter("level = 'buyer' AND customer_id IS NOT NULL")
    buyers = _bitmaps(found, seen.get["buyers"] // BUYERS + 1).withColumn("level", F.lit("buyers"))
    rows = sums.filter("level != 'buyer'").unionByName(buyers, allowMissingColumns=True)
    if sketches:
        each = found.groupBy("date", "region", "channel")
        rows = rows.unionByName(each.agg(F.hll_sketch_agg("customer_id", F.lit(SKETCH)).alias("sketch")).withColumn("level", F.lit("sketches")), allowMissingColumns=True)
    return durable(rows.to(StructType.fromDDL(ROWS)))


class DailyRollup:
    """The rollup in a folder. With ``sketches`` each day's places have a sketch of their buyers as well, for ``about_buyers``."""

    def __init__(self, spark: SparkSession, folder: str, sketches: bool = False):
        self.spark = spark
        self.sketches = sketches
        self.folder = folder.rstrip("/")

    def merge(self, sales: DataFrame, days: Iterable[dt.date] | None = None) -> list[dt.date]:
        """Add the days of ``sales``, or replace those that are there. With ``days`` only these are taken, and a day of them without
        sales is removed. Returns the days that now have other rows."""
        wanted = None if days is None else sorted(set(days))
        if wanted is not None:
            sales = sales.filter(F.col("date").isin(wanted))
        run = new_run(self.folder)
        try:
            with scratch(self.spark), _setting(self.spark, SHUFFLED, SHUFFLED_BYTES):
                rows = _day_sums(sales, self.sketches)
                found = [row[0] for row in rows.select("date").distinct().orderBy("date").collect()]  # as many as the calendar has
                if found:
                    # partitions of a fair size, whatever the days' sizes: small days share a task, a large one has several
                    dealt = rows.withColumn("day", F.date_format("date", "yyyy-MM-dd")).hint("rebalance", "day")
                    dealt.sortWithinPartitions("day", "level").write.partitionBy("day").parquet(run)
            entries = {str(day): Entry(f"{run}/day={day}") for day in found}
            gone = [str(day) for day in wanted or () if str(day) not in entries]
            name_tables(self.spark, self.folder, entries, keep_others=True, without=gone)
        except BaseException:
            discard(self.spark, run)
            raise
        return sorted({*found, *(wanted or ())})

    def days(self) -> list[str]:
        return sorted(published(self.spark, self.folder))

    def rows(self, level: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """The rows of a level in an inclusive period; only its days are listed and read."""
        found = published(self.spark, self.folder)
        paths = [found[day].path for day in sorted(found) if (start is None or day >= start) and (end is None or day <= end)]
        rows = self._read(paths) if paths else self.spark.createDataFrame([], ROWS)
        return rows.filter(F.col("level") == level)

    def _read(self, paths: list[str]) -> DataFrame:
        """The files of some folders; by default Spark would list each folder in a task of its own."""
        with _setting(self.spark, LISTING, str(max(8, len(paths) // FOLDERS))):
            return self.spark.read.schema(ROWS).parquet(*paths)

    def unique_buyers(self, *by: Column, start: str | None = None, end: str | None = None) -> DataFrame:
        """unique_customers per ``by`` (columns made from date, region and channel), or one row, from bitmaps alone."""
        names = [f"_{i}" for i in range(len(by))]
        rows = self.rows("buyers", start, end).select(*[column.alias(name) for column, name in zip(by, names)], "bucket", F.inline(_words("at", "buyers")))
        either = rows.groupBy(*names, "bucket", "word").agg(F.bit_or("bits").alias("bits"))
        return either.groupBy(*names).agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("unique_customers"))

    def about_buyers(self, *by: Column, start: str | None = None, end: str | None = None) -> DataFrame:
        """``unique_buyers`` within about 2 %, from sketches of 4 KB a place and day at most, whatever the number of customers."""
        if not self.sketches:
            raise ValueError("this rollup keeps no sketches")
        names = [f"_{i}" for i in range(len(by))]
        rows = self.rows("sketches", start, end).select(*[column.alias(name) for column, name in zip(by, names)], "sketch")
        merged = rows.groupBy(*names).agg(F.hll_union_agg("sketch").alias("sketch"))
        return merged.select(*names, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("about_customers"))

    def _with_buyers(self, sums: DataFrame, keys: dict[str, Column], start: str | None, end: str | None) -> DataFrame:
        buyers = self.unique_buyers(*keys.values(), start=start, end=end)
        same = F.lit(True)
        for i, key in enumerate(keys):
            same = same & F.col(key).eqNullSafe(F.col(f"_{i}"))
        return sums.join(buyers, same, "left").select(*sums.columns, F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"))

    def _sums(self, level: str, keys: dict[str, Column], start: str | None, end: str | None) -> DataFrame:
        rows = self.rows(level, start, end).groupBy(*[column.alias(name) for name, column in keys.items()])
        return rows.agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.sum("orders").alias("orders"))

    def monthly_revenue(self, start: str | None = None, end: str | None = None) -> DataFrame:
        keys = {"month": month_start("date")}
        return marts.months_table(self._with_buyers(self._sums("place", keys, start, end), keys, start, end), True)

    def quarterly_revenue(self, start: str | None = None, end: str | None = None) -> DataFrame:
        keys = {"year": F.year("date"), "quarter": quarter_of_year("date")}
        out = self._with_buyers(self._sums("place", keys, start, end).drop("units"), keys, start, end)
        return sorted_small(out, "year", "quarter")

    def revenue_by_region_channel(self, start: str | None = None, end: str | None = None) -> DataFrame:
        keys = {"region": F.col("region"), "channel": F.col("channel")}
        return marts.places_table(self._with_buyers(self._sums("place", keys, start, end), keys, start, end), True)

    def revenue_by_region_month(self, start: str | None = None, end: str | None = None) -> DataFrame:
        keys = {"month": month_start("date"), "region": F.col("region")}
        return self._sums("place", keys, start, end).select("month", "region", "revenue").orderBy("month", "region")

    def by_product(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """As ``marts.sums_by_product``: what the product marts and the ABC classes start from."""
        sums = self._sums("product", {"product_id": F.col("product_id")}, start, end)
        return sums.toDF("product_id", "total_revenue", "total_units", "total_orders")

    def by_month_and_product(self, start: str | None = None, end: str | None = None) -> DataFrame:
        sums = self._sums("product", {"month": month_start("date"), "product_id": F.col("product_id")}, start, end)
        return sums.select("month", F.col("month").alias("date"), "product_id", "revenue", "units")

    def by_customer(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """As ``marts.sums_by_customer``: what lifetime value, RFM and churn start from."""
        return self.rows("customer", start, end).groupBy("customer_id").agg(
            F.sum("orders").alias("total_orders"), F.sum("revenue").alias("total_revenue"),
            F.min("date").alias("first_purchase"), F.max("date").alias("last_purchase"),
        )
