"""What the operators of this package share: code on the executors, empty frames, partition counts."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

ARCHIVE = "tillwise_package.zip"
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

# ASCII white space, as the contracts define it
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the executors once per application, so that their workers can import it.

    Spark serves the archive itself; nothing has to be installed or shared. Texts go to the workers in batches of a few MB,
    a setting of the session from then on: Spark's own limit holds a batch several times over in every task.
    """
    if spark.conf.get(BATCH, None) != BATCH_BYTES:
        spark.conf.set(BATCH, BATCH_BYTES)
    context = spark.sparkContext
    if not any(path.endswith(ARCHIVE) for path in context.listFiles):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="tillwise-"), ARCHIVE)
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(archive)
    return spark


def _trim() -> None:
    """Give freed memory of this process back."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def let_go(spark: SparkSession) -> None:
    """Collect what nobody holds any more, between the parts of a long job.

    Spark's cleaner removes shuffle files and broadcasts of frames only once the JVM has collected them, and the driver's heap
    grows to its limit before the JVM does so by itself.
    """
    gc.collect()
    _trim()
    spark._jvm.System.gc()


def released(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """An Arrow function that gives freed memory back when its task ends.

    Spark keeps Python workers between stages, and what they freed but hold on to counts against the executor.
    """

    def wrapped(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _trim()

    return wrapped


def whole(text: str | Column = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which whoever starts it sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_few_parts(table: DataFrame, parts: int) -> DataFrame:
    """A table of bounded size dealt to few partitions, to be iterated over: that takes a job for each partition, one after the other."""
    return table.repartition(max(1, parts))


def utf8(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the id and the text as UTF-8 bytes, named ``id`` and ``text``, for Arrow functions."""
    return df.select(F.col(id_column).cast("long").alias("id"), F.encode(whole(text_column), "UTF-8").alias("text"))
