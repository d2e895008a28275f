"""Fact-table semantics (path B): SQL-equality keys and the transaction-id rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermatch.functions import StatusLabels
from ledgermatch.operators import mart, staging

RAW_I = "transaction_id string, date string, customer_id string, location_id string, amount double, fee double"
RAW_E = "transaction_id string, date string, customer_id string, location_id string, amount double"


def fct(spark, rows_i, rows_e, **kw):
    i = staging.stage_internal(spark.createDataFrame(rows_i, RAW_I))
    e = staging.stage_external(spark.createDataFrame(rows_e, RAW_E))
    return mart.fct_reconciled(i, e, **kw)


def statuses(df):
    rows = [(r["internal_transaction_id"], r["external_transaction_id"], r["match_status"]) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple("" if v is None else v for v in t))


def test_match_variance_and_unmatched(spark):
    rows_i = [("I1", "2024-01-01", "C1", "L1", 100.0, 1.0), ("I2", "2024-01-01", "C2", "L1", 50.0, 0.0),
              ("I3", "2024-01-02", "C3", "L1", 10.0, 0.0)]
    rows_e = [("E1", "2024-01-01", "C1", "L1", 99.03), ("E2", "2024-01-01", "C2", "L1", 40.0),
              ("E9", "2024-01-05", "C9", "L9", 1.0)]
    got = statuses(fct(spark, rows_i, rows_e))
    assert got == [(None, "E9", "UNMATCHED_EXTERNAL"), ("I1", "E1", "MATCHED"), ("I2", "E2", "AMOUNT_VARIANCE"),
                   ("I3", None, "UNMATCHED_INTERNAL")]


def test_null_amount_is_a_variance(spark):
    got = statuses(fct(spark, [("I1", "2024-01-01", "C1", "L1", None, 1.0)],
                       [("E1", "2024-01-01", "C1", "L1", 5.0)]))
    assert got == [("I1", "E1", "AMOUNT_VARIANCE")]


def test_null_keys_never_match(spark):
    got = statuses(fct(spark, [("I1", "2024-01-01", None, "L1", 1.0, 0.0)], [("E1", "2024-01-01", None, "L1", 1.0)]))
    assert got == [(None, "E1", "UNMATCHED_EXTERNAL"), ("I1", None, "UNMATCHED_INTERNAL")]


def test_null_id_is_reported_unmatched_even_when_paired(spark):
    got = statuses(fct(spark, [(None, "2024-01-01", "C1", "L1", 1.0, 0.0)], [("E1", "2024-01-01", "C1", "L1", 1.0)]))
    assert got == [(None, None, "UNMATCHED_INTERNAL"), (None, "E1", "MATCHED")]


def test_duplicate_id_hides_unpaired_copy_in_exact_mode(spark):
    rows_i = [("I1", "2024-01-01", "C1", "L1", 1.0, 0.0), ("I1", "2024-01-07", "C7", "L7", 1.0, 0.0)]
    rows_e = [("E1", "2024-01-01", "C1", "L1", 1.0)]
    exact = statuses(fct(spark, rows_i, rows_e))
    assert exact == [("I1", "E1", "MATCHED")]  # the unpaired I1 shares an id with a paired row
    trusted = statuses(fct(spark, rows_i, rows_e, id_check="trusted"))
    assert trusted == [("I1", None, "UNMATCHED_INTERNAL"), ("I1", "E1", "MATCHED")]
    with pytest.raises(ValueError):
        fct(spark, rows_i, rows_e, id_check="maybe")


def test_same_day_different_times_match(spark):
    i = spark.createDataFrame([("I1", dt.datetime(2024, 1, 1, 1), "C1", "L1", 1.0, 0.0)],
                              "transaction_id string, date timestamp, customer_id string, location_id string, "
                              "amount double, fee double")
    e = spark.createDataFrame([("E1", dt.datetime(2024, 1, 1, 23), "C1", "L1", 1.0)],
                              "transaction_id string, date timestamp, customer_id string, location_id string, "
                              "amount double")
    out = mart.fct_reconciled(staging.stage_internal(i), staging.stage_external(e))
    assert statuses(out) == [("I1", "E1", "MATCHED")]


def test_labels_and_timestamp(spark):
    labels = StatusLabels(unmatched_internal="UNMATCHED_OURS", unmatched_external="UNMATCHED_THEIRS")
    out = fct(spark, [("I1", "2024-01-01", "C1", "L1", 1.0, 0.0)], [("E1", "2024-01-02", "C1", "L1", 1.0)],
              labels=labels)
    assert {r["match_status"] for r in out.collect()} == {"UNMATCHED_OURS", "UNMATCHED_THEIRS"}
    ts = out.select("reconciliation_timestamp").distinct().collect()
    assert len(ts) == 1 and ts[0][0] is not None
    pinned = fct(spark, [("I1", "2024-01-01", "C1", "L1", 1.0, 0.0)], [], run_ts="2024-06-30 05:00:00")
    assert pinned.first()["reconciliation_timestamp"] == dt.datetime(2024, 6, 30, 5, 0)


def test_parse_datetime_is_strict_by_default(spark):
    bad = staging.stage_external(spark.createDataFrame([("E1", "not-a-date", "C1", "L1", 1.0)], RAW_E))
    with pytest.raises(Exception):
        bad.collect()
    lenient = staging.stage_external(spark.createDataFrame([("E1", "not-a-date", "C1", "L1", 1.0)], RAW_E),
                                     lenient=True)
    assert lenient.first()["transaction_date"] is None


def test_staging_columns(spark):
    i = staging.stage_internal(spark.createDataFrame([("I1", "2024-01-01", "C1", "L1", 10.0, 0.5)], RAW_I))
    r = i.first()
    assert (r["gross_amount"], r["fee"], r["net_amount"]) == (10.0, 0.5, 9.5)
    assert dict(i.dtypes)["transaction_date"] == "timestamp_ntz"
    assert i.columns[-2:] == ["source_system", "ingestion_timestamp"]
    assert i.where(F.col("source_system") == "internal").count() == 1
