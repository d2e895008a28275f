"""End to end on the sf0.001 ledgers: exact counts for every mode and the fact table.

DuckDB works out the counts from the same tables, with SQL written from the rules.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgermatch.functions import StatusLabels
from ledgermatch.operators import mart, quality, staging, summary
from ledgermatch.operators.reconcile import MatchSpec, reconcile
from ledgermatch.plans import oracle_views as V
from ledgermatch.sources import fixtures

SF = "/root/testdata/sf0.001"
KEYS = ("date", "customer_id", "location_id")


def three(res):
    got = {r["_merge"]: r["n"] for r in res.classified.groupBy("_merge").agg(F.count("*").alias("n")).collect()}
    return got.get("both", 0), got.get("left_only", 0), got.get("right_only", 0)


@pytest.fixture(scope="module")
def ledgers(spark):
    return fixtures.ledger_internal(spark, SF), fixtures.ledger_external(spark, SF)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF}/orders.parquet'")
    return con


def grouped(con, ctes, body, by):
    return dict(con.execute(V.with_ctes(ctes, f"SELECT {by}, COUNT(*) FROM ({body}) GROUP BY 1")).fetchall())


@pytest.mark.parametrize("spec, sql", [
    (MatchSpec(KEYS), {}),
    (MatchSpec(KEYS, amount_tolerance=0.05), {"where": "abs(l.amount - r.net_amount) <= 5e-2"}),
    (MatchSpec(KEYS, amount_tolerance=0.05, mode="classify"), {"on_extra": "abs(l.amount - r.net_amount) <= 5e-2"}),
])
def test_three_outputs(ledgers, duck, spec, sql):
    body = V.outer_match_sql("ledger_internal", "ledger_external", list(KEYS), ledgers[0].columns, ledgers[1].columns, **sql)
    want = grouped(duck, V.PATH_A, body, "_merge")
    assert three(reconcile(*ledgers, spec)) == tuple(want.get(k, 0) for k in ("both", "left_only", "right_only"))


def test_fact_table_counts(spark, duck):
    i = staging.stage_internal(fixtures.raw_internal(spark, SF))
    e = staging.stage_external(fixtures.raw_external(spark, SF))
    exact = grouped(duck, V.MART, "SELECT * FROM fct", "match_status")
    fact = mart.fct_reconciled(i, e)
    assert {r["match_status"]: r["count"] for r in summary.status_counts(fact).collect()} == exact
    assert len(exact) == 4
    trusted = mart.fct_reconciled(i, e, id_check="trusted")
    counts = {r["match_status"]: r["count"] for r in summary.status_counts(trusted).collect()}
    assert counts == grouped(duck, V.MART_TRUSTED, "SELECT * FROM fct", "match_status") != exact
    assert quality.unique(fixtures.raw_internal(spark, SF), "transaction_id", "raw").first()["failures"] > 0


def test_conservation(spark, ledgers):
    unique = ledgers[1].dropDuplicates(list(KEYS))
    row = quality.conservation(ledgers[0], reconcile(ledgers[0], unique, MatchSpec(KEYS)).classified, "internal_tx_id").first()
    assert row["n_internal"] == 1500 and row["rows_conserved"]


def test_sql_model_equals_dataframe_model(spark):
    from ledgermatch.plans import sql_models
    raw_i, raw_e = fixtures.raw_internal(spark, SF), fixtures.raw_external(spark, SF)
    labels = StatusLabels(matched="it's matched")
    via_sql = sql_models.fct_reconciled_sql(*sql_models.staged(raw_i, raw_e), labels=labels)
    via_df = mart.fct_reconciled(staging.stage_internal(raw_i), staging.stage_external(raw_e), labels=labels) \
        .drop("reconciliation_timestamp")
    assert via_sql.exceptAll(via_df).count() == 0 and via_df.exceptAll(via_sql).count() == 0
    names = sql_models.register_staging(raw_i, raw_e)
    assert [spark.table(n).count() for n in names] == [1500, 1500]


def test_batch_pipeline_picks_id_rule_from_tests(spark, tmp_path):
    from ledgermatch.plans import jobs
    i_dir, e_dir = str(tmp_path / "internal_daily"), str(tmp_path / "external_daily")
    key = F.monotonically_increasing_id().cast("string")
    raw_i = fixtures.raw_internal(spark, SF).withColumn("transaction_id", F.concat(F.lit("a"), key))
    raw_e = fixtures.raw_external(spark, SF).withColumn("transaction_id", F.concat(F.lit("b"), key))
    raw_i.write.option("header", True).csv(i_dir)
    raw_e.write.option("header", True).csv(e_dir)
    raw = str(tmp_path / "raw")
    res = jobs.batch_pipeline(spark, f"{i_dir}/*.csv", f"{e_dir}/*.csv", str(tmp_path / "mart"),
                              run_ts="2024-06-30 05:00:00", raw_path=raw)
    assert res.id_check == "trusted"  # ids proved unique and non-null
    assert spark.read.parquet(f"{raw}/internal").count() == 1500
    failing = {(r["column_name"], r["test"]) for r in res.quality.where("failures > 0").collect()}
    assert failing == {("location_id", "not_null"), ("amount", "not_null")}
    # A repeated external id makes the exact rule necessary.
    dup_dir = str(tmp_path / "external_dup")
    raw_e.unionByName(raw_e.limit(1)).write.option("header", True).csv(dup_dir)
    res2 = jobs.batch_pipeline(spark, f"{i_dir}/*.csv", f"{dup_dir}/*.csv", str(tmp_path / "mart2"), raw_path=raw)
    assert res2.id_check == "exact"
    assert spark.read.parquet(f"{raw}/external").count() == 1501  # the load replaced the table
