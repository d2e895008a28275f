"""Event-time windows with a grace period (watermark) on streams.

Watermarks need a zone-aware ``timestamp``; ``timestamp_ntz`` inputs (as
parquet event logs often are) are cast first, in the session time zone.
A side may carry only one event-time column into a stream-stream join, so
after windowing the raw timestamp is passed on as a plain value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.spec import WindowSpec


def event_time(df: DataFrame, ts_col: str) -> DataFrame:
    if not isinstance(df.schema[ts_col].dataType, T.TimestampType):
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df


def window_column(ts: Column, spec: WindowSpec) -> Column:
    if spec.type == "sliding":
        return F.window(ts, spec.size, spec.slide)
    return F.window(ts, spec.size)


def last_window_end(at: Column, spec: WindowSpec) -> Column:
    """End of the last window that holds an event time (the windows of one slide begin at multiples of it since the epoch)."""
    step = F.unix_micros(F.lit("1970-01-01 00:00:00 UTC").cast("timestamp") + F.expr(f"INTERVAL {spec.slide or spec.size}"))
    size = F.unix_micros(F.lit("1970-01-01 00:00:00 UTC").cast("timestamp") + F.expr(f"INTERVAL {spec.size}"))
    micros = F.unix_micros(at)
    return F.timestamp_micros(micros - F.pmod(micros, step) + size)


def with_window(df: DataFrame, ts_col: str, spec: WindowSpec) -> DataFrame:
    """Watermark ``ts_col`` by the grace period and add the ``window`` struct."""
    df = event_time(df, ts_col).withWatermark(ts_col, spec.grace)
    return df.withColumn("window", window_column(F.col(ts_col), spec))


def window_counts(stream: DataFrame, ts_col: str, spec: WindowSpec, value_col: str | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Records (and value range) per window; in append mode a window is final once closed.

    State is bounded: a window's partial aggregate is dropped as soon as the
    watermark passes its end.
    """
    df = with_window(stream, ts_col, spec)
    aggs = [F.count(F.lit(1)).alias("n_records")]
    if value_col:
        aggs += [F.min(value_col).alias("min_amount"), F.max(value_col).alias("max_amount")]
    out = df.groupBy("window", *keys).agg(*aggs)
    return flatten_window(out)


def flatten_window(df: DataFrame) -> DataFrame:
    """``window`` struct to zone-free ``window_start`` / ``window_end`` columns."""
    cols = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"), *cols)
