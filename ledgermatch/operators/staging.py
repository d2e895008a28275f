"""Staging projections of the raw ledgers (rename, derive net amount, parse date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.functions import parse_datetime


def _transaction_date(raw: DataFrame, lenient: bool) -> Column:
    dtype = raw.schema["date"].dataType
    if isinstance(dtype, T.StringType):
        return parse_datetime("date", "yyyy-MM-dd", lenient=lenient)
    return F.col("date").cast("timestamp_ntz")


def _ingestion(raw: DataFrame) -> Column:
    if "ingestion_timestamp" in raw.columns:
        return F.col("ingestion_timestamp").cast("timestamp")
    return F.lit(None).cast("timestamp")


def stage_internal(raw: DataFrame, source_system: str = "internal", lenient: bool = False) -> DataFrame:
    """Internal ledger: ``amount`` becomes ``gross_amount``, ``net_amount = amount - fee``."""
    return raw.select(
        "transaction_id",
        _transaction_date(raw, lenient).alias("transaction_date"),
        "customer_id",
        "location_id",
        F.col("amount").cast("double").alias("gross_amount"),
        F.col("fee").cast("double").alias("fee"),
        (F.col("amount").cast("double") - F.col("fee").cast("double")).alias("net_amount"),
        F.lit(source_system).alias("source_system"),
        _ingestion(raw).alias("ingestion_timestamp"),
    )


def stage_external(raw: DataFrame, source_system: str = "external", lenient: bool = False) -> DataFrame:
    """External ledger: ``amount`` is already net and becomes ``net_amount``."""
    return raw.select(
        "transaction_id",
        _transaction_date(raw, lenient).alias("transaction_date"),
        "customer_id",
        "location_id",
        F.col("amount").cast("double").alias("net_amount"),
        F.lit(source_system).alias("source_system"),
        _ingestion(raw).alias("ingestion_timestamp"),
    )
