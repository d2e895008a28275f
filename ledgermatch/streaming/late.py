"""Late events kept apart instead of dropped.

A stateful stream drops an event whose windows have all ended before the
watermark, and says no more than how many. ``run_late_split`` goes in front of
it: one stateless query reads both sides, and each of its micro-batches is split
by the watermark of the batches before it, which is what a stateful operator would
have dropped the event by. On-time rows go on to a folder for each side, from
which ``reconcile_stream`` reads; late ones go to folders of their own with their
batch and the watermark that they missed. Nothing is lost: every input row is in
one of the four folders.

The watermark is the lesser of both sides' largest event times so far, less the
grace period. Each batch writes what it has seen to ``seen/batch=<id>``, so the
next one reads one small file, however long the stream has run, and a restart
goes on where it stopped. Each folder of a batch lands under a hidden name and
appears by one rename, whole or not at all; a batch that runs again after a failure
writes what is not there yet. So a stream that reads the on-time rows gets each of
them once. (The rename has to be atomic, as on HDFS and local disks.)

Defined results: an event without a time is on time (the reconciliation reports it
as unmatched); until both sides have had an event nothing is late; an event is
late if its last window ended at or before the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermatch.sinks.publish import exists, folders, replace_folder
from ledgermatch.spec import WindowSpec
from ledgermatch.streaming.replay import by_time, file_count, kept_order
from ledgermatch.streaming.runner import file_stream
from ledgermatch.streaming.windows import event_time, last_window_end

SIDES = ("internal", "external")
_SEEN = "side string, latest timestamp"


def _tagged(internal: DataFrame, external: DataFrame, ts_col: str) -> DataFrame:
    """Both sides as one stream: the side, its row as a struct, the other's struct null."""
    frames = [event_time(f, ts_col) for f in (internal, external)]
    shapes = [f.schema for f in frames]

    def one(k: int) -> DataFrame:
        rows = [F.struct("*") if j == k else F.lit(None).cast(shapes[j]) for j in (0, 1)]
        return frames[k].select(F.lit(SIDES[k]).alias("side"), F.col(ts_col).alias("at"), rows[0].alias("internal"), rows[1].alias("external"))

    return one(0).unionByName(one(1))


def late_split(spark: SparkSession, base: str, spec: WindowSpec) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes a tagged batch's on-time and late rows under ``base``."""
    def seen_before(batch_id: int) -> DataFrame:
        return spark.read.schema(_SEEN).parquet(f"{base}/seen/batch={batch_id - 1}") if batch_id else spark.createDataFrame([], _SEEN)

    def once(rows: DataFrame, folder: str) -> None:
        """Offsets and watermark of a batch are the same at every try, so a folder that is there is right."""
        if not exists(spark, folder):
            replace_folder(rows, folder)  # the files are taken in the order of their names

    def split(batch: DataFrame, batch_id: int) -> None:
        before = seen_before(batch_id)
        known = before.where("latest is not null").agg(F.count(F.lit(1)).alias("n"), F.min("latest").alias("least")).first()
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            watermark = F.lit(None).cast("timestamp")
            if known["n"] == len(SIDES):
                # in milliseconds, as a stream's own watermark
                watermark = F.date_trunc("millisecond", F.lit(known["least"])) - F.expr(f"INTERVAL {spec.grace}")
            late = F.coalesce(last_window_end(F.col("at"), spec) <= watermark, F.lit(False))
            sizes = {r["side"]: r["count"] for r in batch.groupBy("side").count().collect()}  # two at most
            for side in SIDES:
                rows = batch.where(F.col("side") == side)
                ordered = by_time(rows.where(~late), "at", file_count(sizes.get(side, 0)))
                once(ordered.select(f"{side}.*"), f"{base}/on_time/{side}/batch={batch_id}")
                once(rows.where(late).select(f"{side}.*", F.lit(batch_id).cast("long").alias("batch_id"), watermark.alias("watermark")),
                     f"{base}/late/{side}/batch={batch_id}")
            now = batch.groupBy("side").agg(F.max("at").alias("latest"))
            once(before.unionByName(now).groupBy("side").agg(F.max("latest").alias("latest")).coalesce(1), f"{base}/seen/batch={batch_id}")
        finally:
            batch.unpersist()

    return split


def run_late_split(internal: DataFrame, external: DataFrame, base: str, checkpoint: str, spec: WindowSpec, ts_col: str = "ts",
                   available_now: bool = True) -> StreamingQuery:
    """Split two streams into on-time and late rows under ``base``; see the module's description."""
    both = _tagged(internal, external, ts_col)
    writer = both.writeStream.foreachBatch(late_split(both.sparkSession, base, spec)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def on_time_stream(spark: SparkSession, base: str, side: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """One side's on-time rows as a stream, as ``reconcile_stream`` takes them.

    ``max_files_per_trigger`` bounds what a trigger brings into state. A batch's files are by time and batches follow each
    other, so whatever part of them was taken, the rest is on time. Where the file system did not keep that order there is no bound.
    """
    folder = f"{base}/on_time/{side}"
    batches = sorted(folders(spark, folder), key=lambda name: int(name.removeprefix("batch=")))
    bound = max_files_per_trigger if kept_order(spark, [f"{folder}/{name}" for name in batches]) else None
    return file_stream(spark, folder, schema, max_files_per_trigger=bound, recursive=True)


def read_late(spark: SparkSession, base: str, side: str, schema: T.StructType) -> DataFrame:
    """One side's late rows with ``batch_id`` and ``watermark``."""
    full = T.StructType([*schema, T.StructField("batch_id", T.LongType()), T.StructField("watermark", T.TimestampType())])
    return spark.read.schema(full).option("recursiveFileLookup", "true").parquet(f"{base}/late/{side}")
