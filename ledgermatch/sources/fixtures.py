"""Ledger and stream views derived from the benchmark tables.

The ledgers are a deterministic function of ``orders`` (one row per unique
``o_orderkey``) and the streams of ``events``: integer modulus and plain double
arithmetic only, so that any SQL engine computes the same values. They grow
with the input tables, which is what the benchmarks and the oracle checks need.

Every row of the table is on both sides. What does not match differs: dates are
moved, customers replaced, amounts shifted around the tolerance. Some ids are
null or repeated and some locations and amounts are null, so that every rule
about them decides about rows of every query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(prefix: str, width: int, value: Column) -> Column:
    """``prefix`` + zero-padded non-negative integer, like printf('%0Nd'); never truncates."""
    digits = value.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def _day_string(ts: Column, shift_days: Column | int = 0) -> Column:
    return F.date_add(ts.cast("date"), shift_days).cast("string")


def _fee(key: Column) -> Column:
    return (key % 400).cast("double") / F.lit(1e2)


def _ledger_id(prefix: str, key: Column) -> Column:
    """Null for one key in 101; the id of the key before for one in 53."""
    return F.when(key % 101 == 7, F.lit(None).cast("string")).otherwise(
        _padded(prefix, 9, F.when(key % 53 == 11, key - 1).otherwise(key)))


def _location(key: Column) -> Column:
    return F.when(key % 67 == 5, F.lit(None).cast("string")).otherwise(_padded("LOC", 3, key % 25 + 1))


def raw_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transaction_id, date, customer_id, location_id, amount (gross), fee."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        _ledger_id("IN", key).alias("transaction_id"),
        _day_string(F.col("o_orderdate")).alias("date"),
        _padded("CU", 7, F.col("o_custkey")).alias("customer_id"),
        _location(key).alias("location_id"),
        F.when(key % 83 == 2, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("amount"),
        _fee(key).alias("fee"),
    )


def raw_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders: some with moved dates, some with other customers, some with amounts around the tolerance."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    kind = key % 16
    days = F.when(kind == 3, F.lit(1)).when(kind == 9, F.lit(-3)).otherwise(F.lit(0))
    customer = F.when(kind.isin(5, 12), F.col("o_custkey") + 5000000).otherwise(F.col("o_custkey"))
    net = F.col("o_totalprice") - _fee(key)
    off = ((key % 120).cast("double") - F.lit(6e1)) / F.lit(1e3)
    return o.select(
        _ledger_id("EX", key).alias("transaction_id"),
        _day_string(F.col("o_orderdate"), days).alias("date"),
        _padded("CU", 7, customer).alias("customer_id"),
        _location(key).alias("location_id"),
        F.when(kind == 6, net + off).otherwise(net).alias("amount"),
    )


def ledger_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matcher-shaped internal ledger: ``amount`` is the net amount."""
    r = raw_internal(spark, sf_dir)
    return r.select(
        F.col("transaction_id").alias("internal_tx_id"),
        "date", "customer_id", "location_id",
        (F.col("amount") - F.col("fee")).alias("amount"),
    )


def ledger_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matcher-shaped external ledger: ``net_amount`` does not collide with ``amount``."""
    r = raw_external(spark, sf_dir)
    return r.select(
        F.col("transaction_id").alias("external_tx_id"),
        "date", "customer_id", "location_id",
        F.col("amount").alias("net_amount"),
    )


def stream_internal_shape(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"),
                         F.col("value").alias("amount"))


def stream_external_shape(events: DataFrame) -> DataFrame:
    """The same events: some amounts off by one, some under another event id."""
    off = F.when(F.col("event_id") % 9 == 4, F.col("value") + F.lit(1e0)).otherwise(F.col("value"))
    event_id = F.when(F.col("event_id") % 7 == 2, -F.col("event_id") - 1).otherwise(F.col("event_id"))
    return events.select(event_id.alias("event_id"), "user_id", F.col("ts").cast("timestamp").alias("ts"), off.alias("net_amount"))


def documented_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documented internal layout: internal_tx_id, amount, date, customer_id, location_id."""
    r = raw_internal(spark, sf_dir)
    return r.select(F.col("transaction_id").alias("internal_tx_id"), "amount", "date", "customer_id", "location_id")


def documented_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documented external layout with gross, fee, net and a description."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    customer = _padded("CU", 7, F.col("o_custkey"))
    return o.select(
        _ledger_id("EX", key).alias("external_tx_id"),
        F.col("o_totalprice").alias("gross_amount"),
        _fee(key).alias("fee"),
        (F.col("o_totalprice") - _fee(key)).alias("net_amount"),
        _day_string(F.col("o_orderdate")).alias("date"),
        F.concat(F.lit("settled for "), customer).alias("description"),
        customer.alias("customer_id"),
        _location(key).alias("location_id"),
    )
