"""Writers: three-way reconciliation outputs, overwrite loads, partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.operators.matching import BOTH, INDICATOR, LEFT_ONLY, RIGHT_ONLY
from ledgermatch.session import scratch_path
from ledgermatch.sinks.publish import publish, replace_folder
from ledgermatch.sources.files import resolve_path
from ledgermatch.spec import OutputSpec


#: Written and read alike: quotes doubled, timestamps to the microsecond (Spark's default cuts them to milliseconds).
CSV_OPTIONS = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"}


def _writer(df: DataFrame, fmt: str):
    w = df.write.mode("overwrite").format(fmt)
    return w.options(**CSV_OPTIONS) if fmt == "csv" else w


COUNTS = {BOTH: "matched", LEFT_ONLY: "unmatched_internal", RIGHT_ONLY: "unmatched_external"}


def observed(classified: DataFrame, observation: Observation) -> DataFrame:
    """The same frame; whatever runs it first leaves the three row counts in ``observation``."""
    return classified.observe(observation, *[F.count_if(F.col(INDICATOR) == tag).alias(name) for tag, name in COUNTS.items()])


def observed_counts(spark: SparkSession, observation: Observation) -> DataFrame:
    """The counts of the run that was observed, as one row. Waits for it."""
    return spark.createDataFrame([tuple(int(observation.get[n]) for n in COUNTS.values())], ", ".join(f"{n} long" for n in COUNTS.values()))


def write_outputs(classified: DataFrame, out: OutputSpec, observation: Observation | None = None) -> dict[str, str]:
    """Write matched / unmatched internal / unmatched external from one evaluation.

    The classified frame is landed once as parquet under ``spark.checkpoint.dir``,
    in a folder for each kind; each output is then a plain copy of its folder,
    written by Spark straight to its final path. Whatever fails in the
    reconciliation fails before any earlier output is touched. Each output is a
    folder of part files with a header (Spark writes folders, not single files).
    ``observation`` gets the row counts of that one evaluation.
    """
    spark = classified.sparkSession
    base = resolve_path(out.path).rstrip("/")
    landed = scratch_path(spark, "classified")
    counted = observed(classified, observation) if observation else classified
    counted.withColumn("__out", F.col(INDICATOR)).write.partitionBy("__out").parquet(landed)
    schema = T.StructType([*classified.schema, T.StructField("__out", T.StringType())])
    rows = spark.read.schema(schema).parquet(landed)
    names = {BOTH: out.reconciled_file, LEFT_ONLY: out.unmatched_internal_file,
             RIGHT_ONLY: out.unmatched_external_file}
    for tag, name in names.items():
        _writer(rows.where(F.col("__out") == tag).drop("__out"), out.format).save(f"{base}/{name}")
    return {tag: f"{base}/{name}" for tag, name in names.items()}


def read_outputs(spark: SparkSession, written: dict[str, str], schema, fmt: str = "csv") -> DataFrame:
    """Read the three outputs back as one frame (used by round-trip checks)."""
    frames = []
    for path in written.values():
        r = spark.read.schema(schema)
        r = r.options(**CSV_OPTIONS) if fmt == "csv" else r
        frames.append(r.format(fmt).load(path))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Truncate-and-load: the target holds exactly this frame afterwards, or what it held before if the frame fails."""
    return replace_folder(df, path, fmt, **(CSV_OPTIONS if fmt == "csv" else {}))


def write_partitioned(df: DataFrame, path: str, ts_col: str = "reconciliation_timestamp",
                      part_col: str = "reconciliation_date", fmt: str = "parquet") -> str:
    """CREATE OR REPLACE TABLE ... PARTITION BY DATE(ts), in one step: a new version, partitioned by day.

    Returns the version's folder; ``publish.read_published`` reads the table at ``path`` as it is by then.
    """
    dated = df.withColumn(part_col, F.to_date(F.col(ts_col)))
    return publish(dated, path, fmt, [part_col], **(CSV_OPTIONS if fmt == "csv" else {}))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Materialise a frame as a catalog table, replacing it (at ``path`` if given).

    With a path, each load is a version of its own. A table of the same columns is then moved to the new version by one
    catalog change; the old one is readable up to that point, and stays if the load fails.
    """
    if not path:
        df.write.mode("overwrite").format(fmt).saveAsTable(name)
        return
    spark = df.sparkSession
    version = publish(df, path, fmt)
    if spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, version, fmt)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """A catalog table in ``buckets`` files by a hash of ``keys``, each sorted by them.

    Tables with the same keys and number of buckets are joined on these keys without a shuffle. The rows are dealt by
    the same hash first, so a bucket is one file, whatever the number of tasks.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", resolve_path(path)) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_load(df: DataFrame, path: str, load_date: str, load_col: str = "load_date", fmt: str = "parquet",
               partition_by: Sequence[str] = ()) -> str:
    """One day's load into a table partitioned by load date: a rerun replaces that day and no other.

    The day is replaced by a folder move, so that a rerun with fewer rows, or none, leaves nothing behind of the first one.
    """
    day = str(date.fromisoformat(load_date))
    replace_folder(df.drop(load_col), f"{path.rstrip('/')}/{load_col}={day}", fmt, partition_by, **(CSV_OPTIONS if fmt == "csv" else {}))
    return resolve_path(path)
