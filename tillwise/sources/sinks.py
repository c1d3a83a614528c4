"""Writing a set of result tables, each as a dataset of its own."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tillwise.session import in_threads
from tillwise.sources.publish import Entry, name_tables, new_run, written

logger = logging.getLogger(__name__)


def publish_datasets(
    datasets: Mapping[str, Callable[[], DataFrame]], folder: str, fmt: str = "parquet", at_once: int = 8
) -> dict[str, Entry | None]:
    """Build, write and count every dataset, then publish them together; a failed one is logged and becomes None.

    Building sits inside the guard as well as writing, because a lazy plan may fail at either.
    Several writes are submitted at once, so that the tail of one leaves no executor idle. Readers that ask ``published`` see
    the datasets of this run, or still all of the run before.
    """
    run = new_run(folder)
    sessions: list[SparkSession] = []

    def write(item: tuple[str, Callable[[], DataFrame]]) -> tuple[str, Entry | None]:
        name, build = item
        try:
            df = build()
            sessions.append(df.sparkSession)
            entry = written(df, f"{run}/{name}", fmt)
        except Exception:
            logger.exception("%s failed", name)
            return name, None
        logger.info("%s: %d rows written to %s", name, entry.rows, entry.path)
        return name, entry

    done = dict(in_threads(write, datasets.items(), at_once))
    good = {name: entry for name, entry in done.items() if entry}
    if good:
        name_tables(sessions[0], folder, good)
    return done


def write_datasets(
    datasets: Mapping[str, Callable[[], DataFrame]], folder: str, fmt: str = "parquet", at_once: int = 8
) -> dict[str, str | None]:
    """``publish_datasets``; the path of each dataset."""
    return {name: entry and entry.path for name, entry in publish_datasets(datasets, folder, fmt, at_once).items()}
