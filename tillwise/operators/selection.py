"""Exact order statistics by counting: the rows at given positions of an order, without sorting the rows.

All wanted positions of all measures are narrowed down together. A bracket is a range of the order that holds wanted
positions, known by its first and last row, its number of rows and the rows before it. Each round cuts every bracket into
``BUCKETS`` equal ranges of the value, or of the key where all its values are the same, and counts: rows and the first
and last row per bucket. A position that is the first or last of a bucket is found; buckets that hold others are the brackets
of the next round. First and last row never share a bucket, so each round gets nearer.

A round reads the rows once and shuffles at most ``BUCKETS`` counts per bracket and task. What comes to the driver is one row per
wanted position and group; so groups are to be few, such as segments. The rows should be a stored table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

BUCKETS = 1024

Group = tuple[Any, ...]
Spot = tuple[Any, Any]  # value and key


@dataclass
class _Bracket:
    measure: str
    group: Group
    low: Spot
    high: Spot
    before: int
    rows: int
    wanted: list[int]

    def settle(self, found: dict[int, Spot]) -> bool:
        """Take the positions that are known now; whether any are left."""
        left = []
        for position in self.wanted:
            if position == self.before + 1 or self.low == self.high:
                found[position] = self.low
            elif position == self.before + self.rows:
                found[position] = self.high
            else:
                left.append(position)
        self.wanted = left
        return bool(left)


@dataclass
class Order:
    """One measure of one group: its number of rows and the spots that were looked for, by position from 1."""

    rows: int
    spots: dict[int, Spot] = field(default_factory=dict)


def _key(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(-(1 << 63)))  # a missing key comes first


def _lit(value: Any, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def local_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType) -> DataFrame:
    """A few rows as literals of the plan."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [F.struct(*[_lit(x, f.dataType).alias(f.name) for x, f in zip(row, schema.fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _span(x: Column, low: Column, kind: T.DataType) -> Column:
    """How far a value is from the first, as a double: never less for a greater value."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return x * F.lit(0.5) - low * F.lit(0.5)  # the whole span may be too large a number
    wide = "decimal(20,0)" if not isinstance(kind, T.DecimalType) else kind
    return (x.cast(wide) - low.cast(wide)).cast("double")


def _width(low: Any, high: Any) -> float:
    if isinstance(low, float):
        return high * 0.5 - low * 0.5
    return float(Decimal(high) - Decimal(low))


def _bucket(x: Column, low: Column, width: Column, kind: T.DataType) -> Column:
    equal = F.least(F.floor(_span(x, low, kind) / width * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    return F.when(width > 0, equal).otherwise((x > low).cast("int"))


def at_positions(
    rows: DataFrame, measures: Mapping[str, Column], key: str, wanted: Callable[[int], Sequence[int]], by: Sequence[str] = ()
) -> dict[tuple[str, Group], Order]:
    """For each measure and group: its number of rows and the (value, key) at the positions ``wanted`` names for that number.

    ``measures`` have one type; the order is by value, then by ``key`` (an integer column; rows that share both are alike). Rows
    without a value take no part; a null group is a group.
    """
    named = F.array(*[F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in measures.items()])
    groups = [f"_g{i}" for i in range(len(by))]
    stacked = rows.select(*[F.col(c).alias(g) for c, g in zip(by, groups)], _key(F.col(key)).alias("key"), F.inline(named))
    kind = stacked.schema["value"].dataType
    known = F.col("value").isNotNull() & ~F.isnan("value") if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col("value").isNotNull()
    stacked = stacked.filter(known)
    spot = F.struct("value", "key")
    ends = [F.count("*").alias("rows"), F.min(spot).alias("low"), F.max(spot).alias("high")]

    orders: dict[tuple[str, Group], Order] = {}
    brackets = []
    for row in stacked.groupBy("measure", *groups).agg(*ends).collect():
        group = tuple(row[g] for g in groups)
        orders[row.measure, group] = Order(row.rows)
        brackets.append(_Bracket(row.measure, group, tuple(row.low), tuple(row.high), 0, row.rows, sorted(set(wanted(row.rows)))))
    schema = T.StructType([
        T.StructField("of", T.StringType()),
        *[T.StructField(f"_b{i}", stacked.schema[g].dataType) for i, g in enumerate(groups)],
        T.StructField("bracket", T.IntegerType()), T.StructField("by_value", T.BooleanType()),
        T.StructField("low", kind), T.StructField("high", kind), T.StructField("width", T.DoubleType()),
        T.StructField("low_key", T.LongType()), T.StructField("high_key", T.LongType()), T.StructField("key_width", T.DoubleType()),
        T.StructField("before", T.LongType()), T.StructField("wanted", T.ArrayType(T.LongType())),
    ])
    while brackets := [b for b in brackets if b.settle(orders[b.measure, b.group].spots)]:
        table = local_rows(rows.sparkSession, [
            (b.measure, *b.group, i, b.low[0] < b.high[0], b.low[0], b.high[0], _width(b.low[0], b.high[0]),
             b.low[1] if b.low[0] == b.high[0] else None, b.high[1] if b.low[0] == b.high[0] else None,
             _width(b.low[1] or 0, b.high[1] or 0), b.before, b.wanted)
            for i, b in enumerate(brackets)
        ], schema)
        same = F.col("measure") == F.col("of")
        for i, g in enumerate(groups):
            same = same & F.col(g).eqNullSafe(F.col(f"_b{i}"))
        inside = F.col("value").between(F.col("low"), F.col("high")) & (F.col("by_value") | F.col("key").between(F.col("low_key"), F.col("high_key")))
        bucket = F.when(F.col("by_value"), _bucket(F.col("value"), F.col("low"), F.col("width"), kind)).otherwise(
            _bucket(F.col("key"), F.col("low_key"), F.col("key_width"), T.LongType())
        )
        counts = (
            stacked.join(table, same).filter(inside)
            .groupBy("bracket", "before", "wanted", bucket.alias("bucket")).agg(*ends)
        )
        so_far = F.sum("rows").over(Window.partitionBy("bracket").orderBy("bucket")) - F.col("rows")  # of BUCKETS rows
        held = F.col("before") + F.col("below")
        parts = counts.withColumn("below", so_far).withColumn(
            "wanted", F.filter("wanted", lambda p: (p > held) & (p <= held + F.col("rows")))
        ).filter(F.size("wanted") > 0)
        brackets = [_part(brackets[row.bracket], row) for row in parts.collect()]
    return orders


def _part(whole: _Bracket, row: Row) -> _Bracket:
    return _Bracket(whole.measure, whole.group, tuple(row.low), tuple(row.high), row.before + row.below, row.rows, list(row.wanted))


def bin_ends(n_rows: int, bins: int) -> list[int]:
    """The last positions of all bins but the highest, where a rank falls into the first bin whose edge 1 + (n - 1) * bin / bins reaches it."""
    return [1 + (n_rows - 1) * i // bins for i in range(1, bins)]


def bin_of(value: Column, key: Column, order: Order | None, bins: int) -> Column:
    """The bin, from 1, of the rank of (value, key) in an order whose ``bin_ends`` were looked for."""
    if order is None:
        return F.lit(None).cast("int")
    out = F.lit(bins)
    for number, position in reversed(list(enumerate(bin_ends(order.rows, bins), 1))):
        last_value, last_key = order.spots[position]
        out = F.when((value < F.lit(last_value)) | ((value == F.lit(last_value)) & (_key(key) <= F.lit(last_key))), number).otherwise(out)
    return out.cast("int")


def around(n_rows: int, probability: float) -> tuple[int, int, float]:
    """The two positions that a linearly interpolated quantile lies between, and how far it is from the first."""
    spot = (n_rows - 1) * probability
    low = int(spot)
    return low + 1, low + 1 + (spot > low), spot - low


def quantiles(
    rows: DataFrame, measures: Mapping[str, Column], key: str, probability: float = 0.5, by: Sequence[str] = ()
) -> dict[tuple[str, Group], float]:
    """The interpolated quantile of each measure (doubles) in each group."""
    found = at_positions(rows, measures, key, lambda n: around(n, probability)[:2], by)
    out = {}
    for name, order in found.items():
        first, second, way = around(order.rows, probability)
        low, high = (float(order.spots[p][0]) for p in (first, second))
        out[name] = low + (high - low) * way
    return out
