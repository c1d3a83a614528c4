"""Publishing sets of tables in two phases: they are written beside what is there, then one manifest names them all.

    folder/parts/<run>/<table>/...     files of one run, written by Spark
    folder/manifests/<number>.json     table -> path, format, rows

Readers go by the manifest of the highest number, which appears whole by a rename. So they see all tables of a run or none, and a
run that ends midway, by an error or by the end of its driver, leaves what was published before as it was. The files of a run
stay until ``KEPT`` newer manifests have followed, for readers that have begun. One publisher works on a folder at a time;
a second one that takes the same number gets an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tillwise.session import file_system

KEPT = 2


@dataclass(frozen=True)
class Entry:
    """A published table."""

    path: str
    format: str = "parquet"
    rows: int | None = None


def new_run(folder: str) -> str:
    """Where the files of a new run go."""
    return f"{folder.rstrip('/')}/parts/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, fmt: str = "parquet") -> Entry:
    """Write a table; its rows are counted while they are written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return Entry(path, fmt, seen.get["rows"])


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    system, path = file_system(spark, f"{folder.rstrip('/')}/manifests")
    if not system.exists(path):
        return []
    names = [str(status.getPath().getName()) for status in system.listStatus(path)]
    return sorted(name for name in names if name[0].isdigit() and name.endswith(".json"))


def _read(spark: SparkSession, folder: str, name: str) -> dict[str, Entry]:
    system, path = file_system(spark, f"{folder.rstrip('/')}/manifests/{name}")
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {table: Entry(**entry) for table, entry in json.loads(text).items()}


def published(spark: SparkSession, folder: str) -> dict[str, Entry]:
    """The tables that are published in a folder now."""
    names = _manifests(spark, folder)
    return _read(spark, folder, names[-1]) if names else {}


def name_tables(spark: SparkSession, folder: str, tables: dict[str, Entry], keep_others: bool = False, without: Iterable[str] = ()) -> dict[str, Entry]:
    """Publish tables whose files are written; with ``keep_others`` beside those published before, but for ``without``."""
    folder = folder.rstrip("/")
    names = _manifests(spark, folder)
    before = _read(spark, folder, names[-1]) if names and keep_others else {}
    dropped = set(without)
    now = {name: entry for name, entry in before.items() if name not in dropped} | tables
    number = int(names[-1].removesuffix(".json")) + 1 if names else 1
    system, temporary = file_system(spark, f"{folder}/manifests/.{uuid.uuid4().hex}")
    out = system.create(temporary)
    try:
        out.write(bytearray(json.dumps({name: asdict(entry) for name, entry in now.items()}, indent=1).encode()))
    finally:
        out.close()
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests/{number:012d}.json")
    if system.exists(final) or not system.rename(temporary, final):
        system.delete(temporary, False)
        raise RuntimeError(f"another run has published to {folder}")
    _expire(spark, folder, [*names, f"{number:012d}.json"])
    return now


def _runs(tables: dict[str, Entry], folder: str) -> set[str]:
    start = f"{folder}/parts/"
    return {start + entry.path.removeprefix(start).split("/")[0] for entry in tables.values() if entry.path.startswith(start)}


def _expire(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Remove manifests that ``KEPT`` newer ones have followed, and the runs that only they name."""
    old, kept = names[: -1 - KEPT], names[-1 - KEPT :]
    if not old:
        return
    needed = set().union(*(_runs(_read(spark, folder, name), folder) for name in kept))
    for name in old:
        for run in _runs(_read(spark, folder, name), folder) - needed:
            discard(spark, run)
        system, path = file_system(spark, f"{folder}/manifests/{name}")
        system.delete(path, False)


def discard(spark: SparkSession, path: str) -> None:
    """Remove files of a run that no manifest names any more, or never did."""
    system, hadoop = file_system(spark, path)
    system.delete(hadoop, True)
