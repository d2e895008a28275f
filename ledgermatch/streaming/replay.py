"""A table replayed as a stream in the order of its events, a bounded part at each trigger.

A stateful stream holds all rows of a micro-batch in its state before the watermark
may drop any of them. A table that comes as one batch is in the state as a whole,
whatever its windows are, so state grows with the table. ``land`` writes the table as files by
ranges of event time, and the stream takes a few of them at a time: the watermark
follows, and state holds the open windows and one trigger's rows.

No row comes late: a later file has no earlier time, so at each trigger every row is
at or after the largest time before, and equal times share a file. Rows without a
time come first. After the last trigger the watermark is the one of a single batch, and so are
the results.

A file stream takes files by modification time, so ``in_name_order`` sets the times
along the names. Where a file system does not keep them (object stores) the
stream is not bounded: it reads all in one batch, as it would without this module.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.sinks.publish import data_files, in_name_order

#: Rows that a trigger takes of a side, about; and the files that they are in, which tasks read at once.
ROWS_PER_TRIGGER = 1_000_000
FILES_PER_TRIGGER = 4


def file_count(n_rows: int, rows: int | None = None) -> int:
    """Files to cut so many rows into; 1 if they are no more than one trigger takes."""
    rows = rows or ROWS_PER_TRIGGER
    return 1 if n_rows <= rows else -(-n_rows * FILES_PER_TRIGGER // rows)


def by_time(df: DataFrame, ts_col: str, files: int) -> DataFrame:
    """The rows in so many partitions by ranges of time; each becomes a file."""
    return df.repartitionByRange(files, ts_col) if files > 1 else df.coalesce(1)


def kept_order(spark: SparkSession, folders: Iterable[str]) -> bool:
    """Whether modification times rise along these folders and the names in them."""
    times = [at for folder in folders for _, at in data_files(spark, folder)]
    return all(a < b for a, b in zip(times, times[1:]))


def land(df: DataFrame, path: str, ts_col: str, files: int) -> int | None:
    """Write ``df`` to ``path`` by time; returns how many files a trigger may take (None: all at once)."""
    by_time(df, ts_col, files).write.parquet(path)
    in_name_order(df.sparkSession, path)
    return FILES_PER_TRIGGER if kept_order(df.sparkSession, [path]) else None
