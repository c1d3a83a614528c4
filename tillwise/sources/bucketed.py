"""A layout of the sales for everything that goes by one key: hashed into a fixed number of buckets and sorted there.

Sums by the key, and joins with a table in buckets of the same key and number, need no shuffle of the sales. The number of buckets is part
of the files' names, so the folder can be read in any later session, which names the layout again; sizes of a few hundred MB a
bucket are good. A key with very many rows makes one large bucket: its partial sums are still taken task by task only within it, so
hot keys are better served by the plain layout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def save_bucketed(rows: DataFrame, folder: str, key: str, buckets: int) -> None:
    """Write ``rows`` to a new folder in buckets of ``key``, one file each."""
    spark, name = rows.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the session's entry; the files stay


def load_bucketed(spark: SparkSession, folder: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """Read what ``save_bucketed`` wrote, with the layout known to the planner."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)
