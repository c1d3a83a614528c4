"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
R = TypeVar("R")

# Runtime SQL settings only; cluster sizing stays with whoever starts the session.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive features the operators count on, for good, in a session that ``local_session`` did not make."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "tillwise", cpus: str = "8", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    partitions = cpus if cpus.isdigit() else "8"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config(map=SQL_SETTINGS)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for a local session that names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tillwise-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def file_system(spark: SparkSession, path: str):
    """The file system that a path lies in, and the path as Spark's own code takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reaches."""
    system, hadoop = file_system(spark, path)
    return system.exists(hadoop)


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared one for all that ``durable`` writes inside; it is removed at the end.

    Results that still read from it must have been written by then.
    """
    folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        system, hadoop = file_system(spark, folder)
        system.delete(hadoop, True)


def in_threads(call: Callable[[T], R], items: Iterable[T], at_once: int = 8) -> list[R]:
    """``call`` on every item, several at once, in the scratch folder of the caller."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [future.result() for future in [pool.submit(copy_context().run, call, item) for item in items]]


def durable(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` once to a table in the checkpoint folder and read it back from there.

    Used where two passes must see the very same rows, and where several branches start from one
    expensive aggregate. The table outlives any executor; readers take only the columns they
    need, skip partitions of ``by``, and plan their joins with its true size. Inside ``scratch`` it is
    removed with the scope; else it stays for whoever reads the result.
    """
    spark = df.sparkSession
    path = f"{_scope.get() or shared_folder(spark)}/{uuid.uuid4().hex}"
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
