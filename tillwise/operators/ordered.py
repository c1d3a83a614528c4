"""Global order without a single-task window: row numbers, running sums, bins (``selection`` finds single positions).

A window without partition keys sends every row to one task. Here the rows are range-partitioned
by a unique order and sorted inside their partitions; ``monotonically_increasing_id`` then holds
the partition number and the position in it. That table is made durable, so the numbers are plain
data that no retry can change. What one partition has to know of those before it (rows, sums) is
a prefix over one row per partition, which is as many rows as there are shuffle partitions.
The order must be unique (end it with a key): then no value, however frequent, ties a partition
together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillwise.operators.selection import local_rows, quantiles
from tillwise.session import durable

_POSITION_BITS = 33  # of monotonically_increasing_id


def _staged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    kept = durable(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    )
    return kept.withColumns({
        "_part": F.shiftright("_id", _POSITION_BITS),
        "_place": F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
    }).drop("_id")


def _offsets(staged: DataFrame, value: str | None = None) -> DataFrame:
    """Per partition: rows (and sum of ``value``) in the partitions before it and in all."""
    sums = [F.count("*").alias("_rows")] + ([F.sum(value).alias("_sum")] if value else [])
    per_part = staged.groupBy("_part").agg(*sums)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    columns = [
        F.col("_part"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(everything).alias("n_rows"),
    ]
    if value:
        nothing = F.lit(0).cast(staged.schema[value].dataType)
        columns += [
            F.coalesce(F.sum("_sum").over(before), nothing).alias("_sum_before"),
            F.sum("_sum").over(everything).alias("total"),
        ]
    return F.broadcast(per_part.select(*columns))


def number_rows(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Add ``row_num`` (1 for the first row in ``order``) and ``n_rows``."""
    staged = _staged(df, order)
    return (
        staged.join(_offsets(staged), "_part")
        .withColumn("row_num", F.col("_rows_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_rows_before")
    )


def running_sum(df: DataFrame, order: Sequence[str | Column], value: str) -> DataFrame:
    """Add ``running`` (the sum of ``value`` up to and with this row), ``total`` and ``n_rows``."""
    staged = _staged(df, order)
    so_far = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        staged.withColumn("_within", F.sum(value).over(so_far))
        .join(_offsets(staged, value), "_part")
        .withColumn("running", F.col("_within") + F.col("_sum_before"))
        .drop("_part", "_place", "_within", "_rows_before", "_sum_before")
    )


def rank_bin(row_num: Column, n_rows: Column, bins: int = 5) -> Column:
    """Bin 1 to ``bins`` of a rank among ``n_rows`` by equally spaced, linearly interpolated edges.

    That is the first bin whose upper edge ``1 + (n - 1) * bin / bins`` reaches the rank; a lone
    row falls into bin 1.
    """
    return F.greatest(F.lit(1), F.ceil(F.try_divide((row_num - 1) * bins, n_rows - 1))).cast("int")


def exact_quantile(
    df: DataFrame, value: str, key: str, probability: float = 0.5, by: Sequence[str] = (), name: str = "quantile"
) -> DataFrame:
    """Interpolated quantile of ``value`` for each group of ``by`` (few groups), or one row without groups.

    ``key`` makes the order unique. The two values around the wanted position are found by counting; rows are neither sorted nor
    gathered. ``df`` is read a few times.
    """
    found = quantiles(df, {name: F.col(value).cast("double")}, key, probability, by)
    rows = [(*group, number) for (_, group), number in found.items()]
    if not by and not rows:
        rows = [(None,)]
    schema = StructType([*[df.schema[c] for c in by], StructField(name, DoubleType())])
    return local_rows(df.sparkSession, rows, schema)


def edges_of_counts(counts: DataFrame, value: str, count: str, probabilities: Sequence[float]) -> DataFrame:
    """One row ``edges`` with interpolated quantiles of a value given as (value, rows).

    For values from a small fixed domain, such as days; the rows have been counted before.
    """
    wanted = ", ".join(str(p) for p in probabilities)
    return counts.agg(F.expr(f"percentile({value}, array({wanted}), {count})").alias("edges"))


def value_bin(value: Column, edges: Column, n_edges: int, reverse: bool = False) -> Column:
    """Bin 1 to ``n_edges + 1`` of a raw value: the first whose upper edge is not below it."""
    labels = list(range(1, n_edges + 2))
    if reverse:
        labels.reverse()
    chain = F.when(value <= edges[0], labels[0])
    for i in range(1, n_edges):
        chain = chain.when(value <= edges[i], labels[i])
    return chain.otherwise(labels[-1])
