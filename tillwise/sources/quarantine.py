"""Loading rows that may not keep the contract: one pass divides them into accepted rows and rejected ones with their reasons.

A row is rejected for every value that is missing or cannot be read as its column's type, and for every rule that does not hold. Both
parts are written by one job, as two partitions of one table, and published together with the other tables of the load.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from tillwise.session import exists
from tillwise.sources.publish import Entry, discard, name_tables, new_run
from tillwise.sources.tables import SCHEMAS

REJECTED = "raw string, reasons array<string>"  # columns of rejected rows, beside what could be read of them


def sale_rules() -> dict[str, Column]:
    """What has to hold of a sale beside its types, by the name of the reason."""
    return {"quantity below 1": F.col("quantity") >= 1, "revenue below 0": F.col("revenue") >= 0}


@dataclass(frozen=True)
class Divided:
    """Paths and row counts of the two parts."""

    accepted: Entry
    rejected: Entry


def marked(raw: DataFrame, schema: StructType, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """``raw`` with the columns of ``schema``, typed, its ``reasons`` to be rejected (none if accepted) and, where there are any, the row
    as it came in ``raw`` (JSON). A rule that cannot be decided, as a value is missing, gives no reason of its own."""
    names = set(raw.columns)
    read, reasons = [], []
    for field in schema.fields:
        given = F.col(f"`{field.name}`") if field.name in names else F.lit(None)
        value = given.try_cast(field.dataType)
        read.append(value.alias(field.name))
        reasons.append(F.when(given.isNull(), f"missing {field.name}").when(value.isNull(), f"unreadable {field.name}"))
    as_given = F.to_json(F.struct(*[F.col(f"`{name}`") for name in raw.columns]))
    typed = raw.select(*read, as_given.alias("raw"), F.array_compact(F.array(*reasons)).alias("reasons"))
    broken = [F.when(~holds, name) for name, holds in (rules or {}).items()]
    typed = typed.withColumn("reasons", F.concat("reasons", F.array_compact(F.array(*broken)))) if broken else typed
    return typed.withColumn("raw", F.when(F.size("reasons") > 0, F.col("raw")))


def divided(raw: DataFrame, schema: StructType, path: str, rules: Mapping[str, Column] | None = None) -> Divided:
    """Write accepted and rejected rows below ``path`` in one pass."""
    rows = marked(raw, schema, rules)
    seen, bad = Observation(), F.size("reasons") > 0
    part = F.when(bad, "rejected").otherwise("accepted")
    rows.observe(seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected")).withColumn("part", part).write.partitionBy("part").parquet(path)
    out = {}
    for name in ("accepted", "rejected"):
        where = f"{path}/part={name}"
        if not exists(raw.sparkSession, where):
            rows.limit(0).write.parquet(where)
        out[name] = Entry(where, rows=seen.get[name])
    return Divided(**out)


def load_checked(raw: Mapping[str, DataFrame], folder: str, rules: Mapping[str, Mapping[str, Column]] | None = None) -> dict[str, Divided]:
    """Load tables by name (of the three input tables) into ``folder``; the accepted rows are published as the table, the others as
    ``<name>_rejected``. ``load_tables`` reads the accepted ones."""
    rules = {"sales": sale_rules()} if rules is None else rules
    run, out = new_run(folder), {}
    spark = next(iter(raw.values())).sparkSession
    try:
        for name, df in raw.items():
            out[name] = divided(df, SCHEMAS[name], f"{run}/{name}", rules.get(name))
    except BaseException:
        discard(spark, run)
        raise
    entries = {name: parts.accepted for name, parts in out.items()} | {f"{name}_rejected": parts.rejected for name, parts in out.items()}
    name_tables(spark, folder, entries, keep_others=True)
    return out
