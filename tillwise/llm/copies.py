"""Exact deduplication: group by a 128-bit content hash, compare the bytes inside, keep one stable row.

DataFrame functions only. Two texts are equal when they are the same after deleting ASCII white space.

The first aggregation has the hash *and* the normalised text as its key, so rows of one hash whose bytes differ
(a collision) come apart into groups of their own. Copies are combined on the map side: of a text with a million
copies, one row for each map task is shuffled. What goes back onto the rows is one row per distinct text, joined
on fixed-size digests; the side of the rows may be skewed, which the adaptive join splits.

Nulls: a null text is the empty text. A null id loses against any other id. Repeated rows (same id, same text) are
rows of their own, each counted; they share ``keep_id``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from tillwise.llm.shipping import SPACE, whole
from tillwise.session import tune

# One decimal holds (code points, id) so that its maximum is the row to keep: ids count down from 2**63, null is 0.
_IDS = "36893488147419103232"  # 2**65
_TOP = "9223372036854775808"  # 2**63


def normalized(text: str | Column = "text") -> Column:
    """The text without ASCII white space."""
    return F.regexp_replace(whole(text), f"{SPACE}+", "")


def md5_128(text: Column) -> Column:
    """The 128-bit content hash as 16 bytes."""
    return F.unhex(F.md5(text))


def _preference(doc_id: Column, chars: Column) -> Column:
    countdown = F.coalesce(F.lit(_TOP).cast("decimal(20,0)") - doc_id.cast("decimal(19,0)"), F.lit(0).cast("decimal(20,0)"))
    return (chars.cast("decimal(10,0)") * F.lit(_IDS).cast("decimal(20,0)") + countdown).cast("decimal(38,0)")


def _preferred_id(preference: Column) -> Column:
    countdown = F.pmod(preference, F.lit(_IDS).cast("decimal(20,0)"))
    return F.when(countdown != 0, (F.lit(_TOP).cast("decimal(20,0)") - countdown).cast("long"))


def exact_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", content_hash: Callable[[Column], Column] = md5_128
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then the one of the smallest id.
    ``kept`` marks every row that bears the kept id and the kept row's text, so a repeated row is kept as often as it is there;
    ``deduplicated`` returns it once.
    """
    tune(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        normalized(text).alias("norm"),
        F.char_length(whole(text)).alias("chars"),
    ).select(
        "doc_id",
        "norm",
        content_hash(F.col("norm")).alias("hash"),
        F.unhex(F.sha2(F.col("norm"), 256)).alias("sha"),
        _preference(F.col("doc_id"), F.col("chars")).alias("preference"),
    )
    groups = (
        rows.groupBy("hash", "norm")
        .agg(
            F.count("*").alias("group_size"),
            F.max("preference").alias("best"),
        )
        .select("hash", F.unhex(F.sha2(F.col("norm"), 256)).alias("sha"), "group_size", "best")
    )
    return rows.drop("norm").join(groups, ["hash", "sha"]).select(
        "doc_id",
        _preferred_id(F.col("best")).alias("keep_id"),
        "group_size",
        (F.col("preference") == F.col("best")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The kept rows are found as in ``exact_copies``; rows that share id and text with a kept row are
    the same document, of which one is returned.
    """
    tune(docs.sparkSession)
    names = docs.columns
    row = F.struct(*[F.col(f"`{name}`") for name in names])
    rows = docs.select(
        normalized(text).alias("_norm"),
        _preference(F.col(doc_id).cast("long"), F.char_length(whole(text))).alias("_preference"),
        row.alias("_row"),
    ).withColumn("_hash", md5_128(F.col("_norm")))
    best = rows.groupBy("_hash", "_norm").agg(F.max("_preference").alias("_preference")).select(
        "_hash", F.sha2(F.col("_norm"), 256).alias("_sha"), "_preference"
    )
    kept = rows.select("_hash", F.sha2(F.col("_norm"), 256).alias("_sha"), "_preference", "_row").join(
        best, ["_hash", "_sha", "_preference"], "left_semi"
    )
    once = kept.groupBy("_hash", "_sha").agg(F.min("_row").alias("_row"))
    return once.select(*[F.col(f"_row.`{name}`").alias(name) for name in names])
