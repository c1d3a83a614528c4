"""Mixing sources to target weights by hash thresholds, without sorting the documents.

Every document gets a 60-bit hash of its id. A source takes each document a whole number of times (0, 1, ...) and
once more those whose hash is below the source's threshold. Thresholds are found by histograms: sizes are summed by
source and the top 12 bits of the hash, the bucket in which the budget ends is found by a running sum over at most
4,096 rows of a source, and only the documents of that bucket are summed again by the next 12 bits, up to five times.
Because one hash serves every budget, a smaller budget takes a subset of what a larger one takes.

Nulls: a null text has size 0; a null source is a source of its own, last in order; a null id hashes like the text "null".
Rows of one id share a hash and are taken together. Sources without words have target 0. An empty table gives an empty
result. Reruns agree, because nothing depends on partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.column import Column

from tillwise.llm.shipping import WORD, whole
from tillwise.session import durable, tune

BITS, LEVELS = 12, 5


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code point order; ``share`` of all sizes is handed out, ``most`` times a source at most."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2


def words(text: str = "text") -> Column:
    """The number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(whole(text), F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: str) -> Column:
    """60 bits of the id's md5: the same number in any engine."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """source, source_size, target from (source, size): the budget shared by weight, no source above its ceiling.

    Sharing the excess again and again ends where every target is the smaller of its ceiling and one level times its
    weight. With the sources ordered by ceiling / weight those at their ceiling come first, so the level follows from
    running sums. These windows hold one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(w) for w in mix.weights])
    shared = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(mix.weights) + 1).cast("int")))
        .withColumn("ceiling", F.col("source_size") * mix.most)
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(mix.share))
        .withColumn("full", F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("budget") - F.col("full")) / F.col("open_weight"))
        # the first source, in this order, that its level does not fill sets the level of all that follow
        .withColumn("level", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("place", "level"))).over(everything)["level"])
    )
    ceiling = F.col("ceiling").cast("double")
    return shared.select(
        "source", "source_size", F.coalesce(F.least(ceiling, F.col("level") * F.col("weight")), ceiling).alias("target")
    )


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, threshold: of each source the hash below which its documents sum up nearest to ``rest``.

    ``rows``: source, size, hash. ``wanted``: source, rest. The rows of a boundary bucket are summed again in each
    round, no others; a round in which every boundary bucket holds a single hash is the last.
    """
    left, found = rows.filter("size > 0"), wanted
    for level in range(1, LEVELS + 1):
        shift = 60 - BITS * level
        bucket = F.shiftright("hash", shift)
        histogram = left.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")
        summed = histogram.withColumn("below", F.sum("size").over(running) - F.col("size"))
        reached = F.col("below") + F.col("size") > F.col("rest")
        found = durable(
            wanted.join(summed.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
            .groupBy("source", "rest")
            # the bucket in which the budget ends; none if all documents fit
            .agg(F.min(F.when(reached, F.struct("bucket", "below", "size"))).alias("edge"))
        )
        at = found.filter("edge IS NOT NULL").select(F.col("source").alias("of"), F.col("edge.bucket").alias("edge"))
        left = left.join(at, F.col("source").eqNullSafe(F.col("of")) & (bucket == F.col("edge")), "left_semi")
        several = left.groupBy("source").agg((F.min("hash") != F.max("hash")).alias("several")).filter("several")
        if level == LEVELS or several.isEmpty():
            break
        wanted = found.select("source", (F.col("rest") - F.coalesce(F.col("edge.below"), F.lit(0))).alias("rest"))
    # one hash is left in the bucket: take it if that comes nearer to the budget
    nearer = (F.col("rest") - F.col("edge.below")) * 2 >= F.col("edge.size")
    end = (F.col("edge.bucket") + F.when(nearer, 1).otherwise(0)) * F.lit(1 << shift)
    return found.select("source", F.coalesce(end, F.lit(1 << 60)).cast("long").alias("threshold"))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, hash of every document."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words(text).alias("size"), hash60(doc_id).alias("hash")
    )


def source_plan(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: source, source_size, target, rounds (whole passes over it) and threshold of one pass more."""
    shares = durable(
        targets(rows, mix)
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    )
    cuts = thresholds(rows, shares.select("source", "rest")).withColumnRenamed("source", "of")
    return durable(shares.join(cuts, F.col("source").eqNullSafe(F.col("of"))).drop("of", "rest"))


def mixed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source, size and hash) with their source's size and target and the number of ``copies`` the mix takes."""
    plan = plan.withColumnRenamed("source", "of")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    # a whole source may be taken twice and its last threshold then lies at the first bucket, so copies stay within the ceiling
    copies = F.col("rounds") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)
    return joined.withColumn("copies", copies).drop("of", "rounds", "threshold")


def mix_sources(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and ``taken`` words of every document."""
    tune(docs.sparkSession)
    rows = durable(sized(docs, doc_id, text, source))
    return mixed(rows, source_plan(rows, mix)).withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, all columns, each as often as the mix takes it. Documents without words are left out:
    they add nothing to any target."""
    tune(docs.sparkSession)
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        F.col(source).cast("string").alias("source"), words(text).alias("size"), hash60(doc_id).alias("hash"),
    )
    plan = source_plan(durable(rows.select("source", "size", "hash")), mix)
    taken = mixed(rows, plan).filter("size > 0 AND copies > 0")
    repeated = taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"))
    return repeated.select(*[F.col(f"row.`{name}`").alias(name) for name in names])
