"""Scans, path rules, connector options, sinks and job configuration."""

import os

import pytest
from pyspark.sql import functions as F

from ledgermatch.sinks import writers
from ledgermatch.sources import connectors, files
from ledgermatch.sources.dispatch import read_source
from ledgermatch.spec import JobSpec, OutputSpec, SourceSpec, validate

CSV = "date,customer_id,location_id,amount\n2023-11-05,00427,R7,18.25\n2023-11-09,00981,R2,6.5\n"


@pytest.fixture
def csv_file(tmp_path):
    p = tmp_path / "ledger.csv"
    p.write_text(CSV)
    return str(p)


@pytest.fixture
def psv_file(tmp_path):
    p = tmp_path / "ledger.psv"
    p.write_text(CSV.replace(",", "|"))
    return str(p)


def test_csv_scan_parses_date(spark, csv_file):
    df = files.read_delimited(spark, csv_file)
    assert df.count() == 2
    assert dict(df.dtypes)["date"] == "timestamp_ntz"
    # Without a schema, ids stay text (no silent integer inference).
    assert df.where(F.col("customer_id") == "00427").count() == 1


def test_psv_by_suffix(spark, psv_file):
    df = files.read_delimited(spark, psv_file)
    assert df.columns == ["date", "customer_id", "location_id", "amount"]
    assert df.count() == 2


def test_suffix_rule_is_case_sensitive():
    assert files.delimiter_for("a.psv") == "|"
    assert files.delimiter_for("a.PSV") == ","
    assert files.delimiter_for("a.txt") == ","


def test_missing_local_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, str(tmp_path / "nope.csv"))


def test_glob_allowed_when_it_matches(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(CSV)
    df = files.read_glob(spark, str(tmp_path / "*.csv"), "date string, customer_id string, location_id string, "
                                                         "amount double", with_ingestion_time=True)
    assert df.count() == 6
    assert "ingestion_timestamp" in df.columns


def test_scheme_rules():
    assert files.resolve_path("s3://bucket/x.csv") == "s3a://bucket/x.csv"
    assert files.resolve_path("gs://bucket/x.psv") == "gs://bucket/x.psv"
    assert files.resolve_path("hdfs://nn/x.csv") == "hdfs://nn/x.csv"


def test_missing_date_column_is_an_error(spark, tmp_path):
    p = tmp_path / "nodate.csv"
    p.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="date"):
        files.read_delimited(spark, str(p))


def test_na_tokens_become_null(spark, tmp_path):
    p = tmp_path / "na.csv"
    p.write_text("date,customer_id,amount\n2024-01-01,NA,1.0\n2024-01-02,n/a,2.0\n2024-01-03,7,NULL\n")
    df = files.read_delimited(spark, str(p))
    assert df.where(F.col("customer_id").isNull()).count() == 2
    assert df.where(F.col("amount").isNull()).count() == 1


def test_infer_schema_on_request(spark, csv_file):
    df = files.read_delimited(spark, csv_file, infer_schema=True)
    assert dict(df.dtypes)["amount"] == "double"


def test_typed_external_loader(spark, tmp_path):
    p = tmp_path / "ext.csv"
    p.write_text("external_tx_id,gross_amount,fee,net_amount,date,description,customer_id,location_id\n"
                 "bk-77,61.5,2.25,59.25,2021-02-28,counter deposit,K9,R3\n")
    df = files.load_external_typed(spark, str(p))
    row = df.first()
    assert (row["gross_amount"], row["fee"], row["net_amount"]) == (61.5, 2.25, 59.25)


def test_jdbc_options_split_query():
    src = connectors.redshift_source("h", "db", "u", "p", "SELECT * FROM t WHERE date >= '2024-01-01'",
                                     lower_bound=1, upper_bound=1000, num_partitions=8)
    opts = src.options()
    assert opts["url"] == "jdbc:postgresql://h:5439/db?currentSchema=public"
    assert opts["dbtable"].startswith("(SELECT * FROM t")
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "8"
    assert "query" not in opts  # query and partitionColumn exclude each other


def test_bigquery_and_kafka_options():
    bq = connectors.bigquery_options("proj", "SELECT 1")
    assert bq["parentProject"] == "proj" and bq["query"] == "SELECT 1"
    k = connectors.kafka_options("b:9092", "internal_transactions", "recon_internal",
                                 {"sasl_mechanism": "PLAIN", "security_protocol": "SASL_SSL",
                                  "username": "u", "password": "p"})
    assert k["subscribe"] == "internal_transactions"
    assert k["kafka.sasl.mechanism"] == "PLAIN" and 'username="u"' in k["kafka.sasl.jaas.config"]


def test_unknown_source_type(spark):
    with pytest.raises(ValueError, match="Unsupported source type"):
        read_source(spark, SourceSpec("mongo", query="x"))


def _config(**over):
    cfg = {
        "sources": {"internal": {"type": "file", "path": "a.csv"}, "external": {"type": "file", "path": "b.csv"}},
        "matching": {"match_on": ["date"], "internal_key": "amount", "external_key": "net_amount"},
        "tolerances": {"amount": 0.01, "days": 1},
        "output": {"path": "o", "reconciled_file": "m.csv", "unmatched_internal_file": "ui.csv",
                   "unmatched_external_file": "ue.csv"},
    }
    cfg.update(over)
    return cfg


@pytest.mark.parametrize("broken, message", [
    ({"sources": None}, "sources"),
    ({"sources": {"internal": {"type": "file", "path": "a"}}}, "external"),
    ({"sources": {"internal": {"path": "a"}, "external": {"type": "file", "path": "b"}}}, "type"),
    ({"sources": {"internal": {"type": "file"}, "external": {"type": "file", "path": "b"}}}, "path"),
    ({"sources": {"internal": {"type": "bigquery", "connection": {}}, "external": {"type": "file", "path": "b"}}},
     "query"),
    ({"sources": {"internal": {"type": "redshift", "query": "q"}, "external": {"type": "file", "path": "b"}}},
     "connection"),
    ({"matching": {"match_on": ["date"], "internal_key": "amount"}}, "external_key"),
    ({"output": {"path": "o"}}, "reconciled_file"),
])
def test_config_rules(broken, message):
    cfg = _config()
    for k, v in broken.items():
        if v is None:
            cfg.pop(k)
        else:
            cfg[k] = v
    with pytest.raises(ValueError, match=message):
        validate(cfg)


def test_kafka_config_accepts_topic_and_nested_tolerances():
    cfg = _config(sources={
        "internal": {"type": "kafka", "topic": "t1", "connection": {"bootstrap_servers": "b:1"}},
        "external": {"type": "kafka", "topic": "t2", "connection": {"bootstrap_servers": "b:1"}}},
        window={"type": "sliding", "size": "24h", "slide": "1h", "grace": "10m"})
    cfg.pop("tolerances")
    cfg["matching"]["tolerances"] = {"amount": 0.01, "days": 1}
    spec = JobSpec.from_dict(cfg)
    assert spec.matching.amount_tolerance == 0.01 and spec.window.size == "24 hours"
    assert spec.window.slide == "1 hours" and spec.window.grace == "10 minutes"


def test_write_outputs_single_pass(spark, tmp_path):
    from ledgermatch.operators.reconcile import MatchSpec, reconcile
    i = spark.createDataFrame([("k1", 1.0), ("k2", 2.0)], "key string, amount double")
    e = spark.createDataFrame([("k1", 1.0), ("k3", 3.0)], "key string, net_amount double")
    res = reconcile(i, e, MatchSpec(("key",)))
    out = OutputSpec(str(tmp_path / "out"), "matched.csv", "ui.csv", "ue.csv")
    written = writers.write_outputs(res.classified, out)
    assert sorted(os.listdir(tmp_path / "out")) == ["matched.csv", "ue.csv", "ui.csv"]
    back = spark.read.option("header", True).csv(written["both"])
    assert back.columns == ["key", "amount", "net_amount", "_merge"] and back.count() == 1


def test_write_outputs_empty_side(spark, tmp_path):
    from ledgermatch.operators.reconcile import MatchSpec, reconcile
    i = spark.createDataFrame([("k1", 1.0)], "key string, amount double")
    e = spark.createDataFrame([("k1", 1.0)], "key string, net_amount double")
    res = reconcile(i, e, MatchSpec(("key",)))
    written = writers.write_outputs(res.classified, OutputSpec(str(tmp_path / "o"), "m", "ui", "ue"))
    assert spark.read.schema(res.classified.schema).option("header", True).csv(written["left_only"]).count() == 0


def test_overwrite_and_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-06-30 05:00:00")], "id string, ts string") \
        .withColumn("reconciliation_timestamp", F.to_timestamp("ts"))
    p = str(tmp_path / "t")
    writers.overwrite_table(df, p)
    writers.overwrite_table(df, p)
    assert spark.read.parquet(p).count() == 1
    q = writers.write_partitioned(df, str(tmp_path / "part"))
    assert os.path.isdir(os.path.join(q, "reconciliation_date=2024-06-30"))


def test_ensure_database(spark, tmp_path):
    writers.ensure_database(spark, "recon_test_db", str(tmp_path / "db"))
    assert "recon_test_db" in [d.name for d in spark.catalog.listDatabases()]


def test_save_table_replaces(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    writers.save_table(df, "recon_mart_test", path=str(tmp_path / "mart"))
    writers.save_table(df.union(df), "recon_mart_test", path=str(tmp_path / "mart"))
    assert spark.table("recon_mart_test").count() == 2


def test_typed_internal_loader(spark, tmp_path):
    p = tmp_path / "int.csv"
    p.write_text("internal_tx_id,amount,date,customer_id,location_id\nin-4,18,2021-03-01,K9,R3\n")
    df = files.load_internal_typed(spark, str(p))
    assert dict(df.dtypes)["amount"] == "double" and df.first()["amount"] == 18.0


def test_missing_path_under_any_scheme_is_file_not_found(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, f"file://{tmp_path}/absent.csv")
    with pytest.raises(FileNotFoundError):
        files.read_parquet(spark, str(tmp_path / "absent.parquet"))


def test_columns_are_bound_by_name(spark, tmp_path):
    p = tmp_path / "shuffled.csv"
    p.write_text("amount,date,location_id,customer_id\n4.5,2023-11-05,R7,K1\n")
    schema = "date string, customer_id string, location_id string, amount double"
    for df in (files.read_delimited(spark, str(p), schema=schema, parse_dates=()), files.read_glob(spark, str(p), schema)):
        assert [tuple(r) for r in df.collect()] == [("2023-11-05", "K1", "R7", 4.5)]
    with pytest.raises(ValueError, match="fee"):
        files.read_delimited(spark, str(p), schema=schema + ", fee double", parse_dates=())


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_glob(spark, str(tmp_path / "*.csv"), "x string, y string").collect()


def test_quoted_cells(spark, tmp_path):
    p = tmp_path / "quoted.csv"
    p.write_text('id,note\n1,"a ""b"", c"\n2,"two\nlines"\n')
    got = files.read_delimited(spark, str(p), schema="id int, note string", parse_dates=(), multiline=True).collect()
    assert [tuple(r) for r in got] == [(1, 'a "b", c'), (2, "two\nlines")]


def test_na_in_a_typed_column_is_null_and_other_text_fails(spark, tmp_path):
    p = tmp_path / "typed.csv"
    p.write_text("id,amount\n007,NA\n008,1.5\n")
    got = files.read_delimited(spark, str(p), schema="id string, amount double", parse_dates=()).collect()
    assert [tuple(r) for r in got] == [("007", None), ("008", 1.5)]
    p.write_text("id,amount\n007,much\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, str(p), schema="id string, amount double", parse_dates=()).collect()


def test_a_failed_run_leaves_the_old_outputs_whole(spark, tmp_path):
    out = OutputSpec(str(tmp_path / "out"), "m", "ui", "ue")
    good = spark.createDataFrame([("a", "both"), ("b", "left_only")], "k string, _merge string")
    written = writers.write_outputs(good, out)
    bad = spark.createDataFrame([("x", "both")], "k string, _merge string").withColumn("k", F.col("k").cast("int").cast("string"))
    with pytest.raises(Exception):
        writers.write_outputs(bad, out)
    assert [tuple(r) for r in writers.read_outputs(spark, written, good.schema).orderBy("k").collect()] == [("a", "both"), ("b", "left_only")]


def test_csv_outputs_keep_microseconds_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", twice', "2024-01-01 10:20:30.123456", "both")], "k string, ts string, _merge string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    written = writers.write_outputs(df, OutputSpec(str(tmp_path / "o"), "m", "ui", "ue"))
    assert writers.read_outputs(spark, written, df.schema).collect() == df.collect()


def test_options_reach_the_sources(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(connectors, "read_jdbc", lambda spark, src, dates: seen.update(jdbc=src))
    monkeypatch.setattr(connectors, "read_bigquery", lambda spark, project, query, dates, **kw: seen.update(kw))
    where = {"host": "h", "database": "d", "user": "u", "password": "p"}
    read_source(spark, SourceSpec("redshift", query="q", connection=where, options={"num_partitions": 9, "upper_bound": 5, "lower_bound": 1}))
    assert (seen["jdbc"].num_partitions, seen["jdbc"].lower_bound, seen["jdbc"].upper_bound) == (9, 1, 5)
    read_source(spark, SourceSpec("bigquery", query="q", connection={"project_id": "x"}, options={"materialization_dataset": "tmp"}))
    assert seen["materialization_dataset"] == "tmp"


def test_streams_stop_on_lost_or_malformed_records(spark):
    assert connectors.kafka_options("b:1", "t")["failOnDataLoss"] == "true"
    assert connectors.kafka_options("b:1", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    schema = spark.createDataFrame([], "a int").schema
    raw = spark.createDataFrame([(bytearray(b'{"a": 1}'), None)], "value binary, timestamp timestamp")
    assert connectors.parse_records(raw, schema).first()["a"] == 1
    with pytest.raises(Exception):
        connectors.parse_records(raw.withColumn("value", F.lit("{oops").cast("binary")), schema).collect()


def test_all_faults_of_a_configuration_are_named():
    from ledgermatch.spec import faults
    assert faults({}) == ["sources", "matching", "output"]
    found = faults({"sources": {"internal": {"type": "odd"}, "external": {}}, "matching": {"match_on": []},
                    "output": {"path": "o", "reconciled_file": "m", "unmatched_internal_file": "u"}})
    assert found == ["sources.internal.type (unknown type 'odd')", "sources.external.type", "matching.internal_key",
                     "matching.external_key", "output.unmatched_external_file"]


def test_loader_logs_attempt_and_failure(spark, csv_file, tmp_path, caplog):
    import logging
    with caplog.at_level(logging.INFO, logger="ledgermatch.sources.files"):
        files.read_delimited(spark, csv_file)
        with pytest.raises(FileNotFoundError):
            files.read_delimited(spark, str(tmp_path / "gone.csv"))
    messages = [r.getMessage() for r in caplog.records]
    assert any(m.startswith("Reading delimited file") for m in messages)
    assert any(m.startswith("Failed to load ") for m in messages)


def test_text_in_a_typed_column_fails_without_ansi(spark, tmp_path):
    p = tmp_path / "typed.csv"
    p.write_text("id,amount\n007,much\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("false", "true"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            with pytest.raises(Exception, match="amount has no double in much"):
                files.read_delimited(spark, str(p), schema="id string, amount double", parse_dates=()).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_dates_in_columns_with_a_dot(spark, tmp_path):
    p = tmp_path / "dotted.csv"
    p.write_text("booked.date,x\n2021-02-28,1\n")
    got = files.read_delimited(spark, str(p), parse_dates=("booked.date",)).collect()
    assert str(got[0]["booked.date"]) == "2021-02-28 00:00:00"
