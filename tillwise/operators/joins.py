"""Joins with one-row facts, joins split by measured heavy hitters, and sorts of results that are small by nature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillwise.operators.selection import local_rows

HEAVY = 1024  # heaviest keys of a join that are looked at
TRACKED = 16384  # keys that their sketch keeps, a power of two
PIECE = 100_000  # rows that are not worth splitting


def beside(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row aggregate on every row, as a scalar subquery: no join at all."""
    facts = one_row.select(F.struct("*")).scalar()
    return rows.withColumn("_facts", facts).select(*rows.columns, "_facts.*")


Heavy = list[tuple[object, int]]  # keys and over how many tasks they are dealt


def heavy_keys(rows: DataFrame, key: str, piece: int = PIECE) -> Heavy:
    """The keys that have too many rows for one task, ``HEAVY`` at most; see ``measured``."""
    return measured(rows, [key], piece)[key]


def measured(rows: DataFrame, keys: Sequence[str], piece: int = PIECE) -> dict[str, Heavy]:
    """For each of some columns (key, number of tasks) of the keys that have too many rows for one task.

    One pass fills a frequent-items sketch of ``TRACKED`` keys per column and task and merges them in two steps, so only sketches are sent. It misses
    no key with more than a few ``TRACKED``-ths of all rows; a key it names too large is split more than need be. A task is to
    get ``piece`` rows, or half of what it would get if all were dealt evenly, if that is more.
    """
    names = {f"sketch{i}": key for i, key in enumerate(keys)}
    parts = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(64)))
    sketches = parts.agg(F.count("*").alias("n"), *[F.expr(f"approx_top_k_accumulate(`{key}`, {TRACKED})").alias(name) for name, key in names.items()])
    # grouped, so that no rows give no row
    merged = sketches.groupBy(F.lit(1)).agg(F.sum("n").alias("n"), *[F.expr(f"approx_top_k_combine({name}, {TRACKED})").alias(name) for name in names])
    found = merged.select("n", *[F.expr(f"approx_top_k_estimate({name}, {HEAVY})").alias(name) for name in names]).first()
    if found is None:
        return {key: [] for key in keys}
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(piece, found.n // (2 * tasks))
    return {
        key: [(item.item, -(-item["count"] // most)) for item in found[name] or () if item["count"] > most and item.item is not None]
        for name, key in names.items()
    }


def split_join(
    rows: DataFrame, table: DataFrame, key: str, how: str = "inner", piece: int = PIECE, heavy: Heavy | None = None
) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per ``key``; heavy keys of ``rows`` are dealt to several tasks.

    Rows of a heavy key get one of as many numbers as it takes tasks, by the hash of all their columns; the one row of the
    table is repeated for each number, and key and number are joined. Other keys join plainly, in the same plan. ``rows`` are read
    once more for the sketch, so they should be a table, unless the heavy keys are given. ``how`` is inner or left.
    """
    heavy = heavy_keys(rows, key, piece) if heavy is None else heavy
    if not heavy:
        return rows.join(table, key, how)
    schema = StructType([StructField("_key", rows.schema[key].dataType), StructField("_tasks", IntegerType())])
    tasks = F.broadcast(local_rows(rows.sparkSession, heavy, schema))  # HEAVY rows at most
    names = rows.columns
    dealt = rows.join(tasks, F.col(key) == F.col("_key"), "left")
    dealt = dealt.select(*names, F.coalesce(F.pmod(F.xxhash64(*names), "_tasks"), F.lit(0)).cast("int").alias("_number"))
    repeated = table.join(tasks, F.col(key) == F.col("_key"), "left")
    repeated = repeated.select(*table.columns, F.explode(F.sequence(F.lit(0), F.coalesce("_tasks", F.lit(1)) - 1)).alias("_number"))
    return dealt.join(repeated, [key, "_number"], how).drop("_number")


def sorted_small(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Sort a result whose rows are few by nature: months, quarters, classes, segments, KPI rows.

    They go to one partition and are sorted there; a global sort would first run the whole plan
    once more to sample ranges.
    """
    return rows.repartition(1).sortWithinPartitions(*keys)
