"""Running streams to files: bounded runs, three-way output, progress metrics."""

from __future__ import annotations

import json
import time
from collections import Counter, deque
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from pyspark import StorageLevel

from ledgermatch.operators.matching import BOTH, INDICATOR, LEFT_ONLY, RIGHT_ONLY
from ledgermatch.sinks.writers import CSV_OPTIONS


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, file_glob: str | None = None,
                max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """Parquet files arriving in ``folder`` as a stream (a file path is not allowed)."""
    reader = spark.readStream.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                   available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet folder; with ``available_now`` run until caught up.

    The checkpoint folder holds offsets and window state, so a restarted query
    resumes where it stopped; it must live on shared storage.
    """
    writer = (stream.writeStream.format("parquet").outputMode(output_mode)
              .option("path", path).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def split_outputs(base: str, names: dict[str, str] | None = None, fmt: str = "parquet"):
    """``foreachBatch`` function writing each micro-batch to three named outputs.

    ``names`` maps ``_merge`` values to folder names (default: the values).
    The micro-batch is persisted while it is written three times (it is one
    trigger's worth of rows) and each write goes to ``<name>/batch=<id>`` with
    overwrite, so a batch re-run after a failure replaces its own files.
    """
    names = names or {BOTH: BOTH, LEFT_ONLY: LEFT_ONLY, RIGHT_ONLY: RIGHT_ONLY}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for tag, name in names.items():
                writer = batch.where(F.col(INDICATOR) == tag).write.mode("overwrite").format(fmt)
                if fmt == "csv":
                    writer = writer.options(**CSV_OPTIONS)
                writer.save(f"{base}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()
    return write


def run_split(stream: DataFrame, base: str, checkpoint: str, names: dict[str, str] | None = None,
              available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    q = (stream.writeStream.foreachBatch(split_outputs(base, names, fmt)).outputMode("append")
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    started = q.start()
    if available_now:
        started.awaitTermination()
    return started


def read_split(spark: SparkSession, base: str, schema: T.StructType,
               names: dict[str, str] | None = None, fmt: str = "parquet") -> DataFrame:
    """The three outputs of ``run_split`` read back as one frame."""
    names = names or {BOTH: BOTH, LEFT_ONLY: LEFT_ONLY, RIGHT_ONLY: RIGHT_ONLY}
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    frames = [reader.load(f"{base}/{n}").select(*schema.names) for n in names.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_PROGRESS_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("input_rows_per_second", T.DoubleType()),
    T.StructField("processed_rows_per_second", T.DoubleType()),
    T.StructField("trigger_ms", T.LongType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("rows_dropped_by_watermark", T.LongType()),
])


def final_watermark(query: StreamingQuery) -> str | None:
    """The event-time watermark reported by the query's last micro-batch."""
    progress = query.lastProgress or {}
    wm = progress.get("eventTime", {}).get("watermark")
    return None if wm in (None, "1970-01-01T00:00:00.000Z") else wm


def _progress_row(p) -> tuple:
    """One row of a progress report, as a dictionary."""
    operators = p.get("stateOperators", [])
    return (int(p["batchId"]), int(p.get("numInputRows", 0)), float(p.get("inputRowsPerSecond") or 0.0),
            float(p.get("processedRowsPerSecond") or 0.0), int(p.get("durationMs", {}).get("triggerExecution", 0)),
            p.get("eventTime", {}).get("watermark"), sum(int(o.get("numRowsTotal", 0)) for o in operators),
            sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in operators))


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Processing-time metrics of recent micro-batches as a small DataFrame.

    These are the query's own progress reports (a few numbers per batch),
    not data rows. ``rows_dropped_by_watermark`` counts late rows, once for each
    stateful operator and window that drops them.
    """
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], _PROGRESS_SCHEMA)


class ProgressListener(StreamingQueryListener):
    """Metrics pushed by every query of a session as its batches end, kept for the last ``keep`` batches.

    ``spark.streams.addListener(listener)`` starts it. ``observed`` holds the metrics of ``DataFrame.observe``
    by name, summed over batches where they are counts.
    """

    def __init__(self, keep: int = 1000):
        self.rows: deque = deque(maxlen=keep)
        self.observed: dict[str, Counter] = {}
        self.ended: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.append(_progress_row(json.loads(event.progress.json)))
        for name, row in event.progress.observedMetrics.items():
            self.observed.setdefault(name, Counter()).update(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append(str(event.id))

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the events of a query that has ended are in; they come a little after it."""
        end = time.monotonic() + seconds
        while str(query.id) not in self.ended:
            if time.monotonic() > end:
                raise TimeoutError(f"no event of the end of query {query.id}")
            time.sleep(0.05)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), _PROGRESS_SCHEMA)


#: Session settings under which state is kept in RocksDB, and checkpoints write what changed instead of the whole state.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the choice stays with their checkpoints."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def join_state(spark: SparkSession, checkpoint: str, side: str, operator_id: int = 0) -> DataFrame:
    """Rows that a stream join's checkpoint holds of one side (``left`` or ``right``), by Spark's state reader."""
    return (spark.read.format("statestore").option("operatorId", operator_id).option("joinSide", side)
            .load(checkpoint).select("partition_id", "value.*"))
