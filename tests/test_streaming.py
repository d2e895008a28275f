"""Structured Streaming: grace period, restart from checkpoint, outputs, metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermatch.spec import WindowSpec
from ledgermatch.streaming import runner
from ledgermatch.streaming.reconcile import reconcile_stream, window_metrics
from ledgermatch.streaming.windows import window_counts

SCHEMA_I = "event_id long, user_id long, ts timestamp, amount double"
SCHEMA_E = "event_id long, user_id long, ts timestamp, net_amount double"
HOUR = WindowSpec("tumbling", "1 hour", grace="10 minutes")


def t(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def drop(spark, folder, rows, schema, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_grace_period_drops_late_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = spark.createDataFrame([], SCHEMA_I).schema
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    # Batch 1 moves the watermark to 03:50; batch 2 brings a row for the 00:00 window (late) ...
    drop(spark, src, [(1, 1, t(0, 5), 1.0), (2, 1, t(4, 0), 1.0)], SCHEMA_I, "a")
    stream = runner.file_stream(spark, src, schema, max_files_per_trigger=1, recursive=True)
    counts = window_counts(stream, "ts", HOUR)
    runner.run_to_parquet(counts, out, ck)
    drop(spark, src, [(3, 1, t(0, 30), 1.0), (4, 1, t(6, 0), 1.0)], SCHEMA_I, "b")
    runner.run_to_parquet(counts, out, ck)
    # ... and a third batch advances past 04:00 so the 04:00 window closes.
    drop(spark, src, [(5, 1, t(9, 0), 1.0)], SCHEMA_I, "c")
    runner.run_to_parquet(counts, out, ck)
    got = {(r["window_start"].hour, r["n_records"]) for r in spark.read.parquet(out).collect()}
    assert (0, 1) in got          # the 00:30 row arrived after the window closed: dropped
    assert (4, 1) in got and (6, 1) in got


def test_restart_resumes_from_checkpoint(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = spark.createDataFrame([], SCHEMA_I).schema
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    drop(spark, src, [(1, 1, t(0, 5), 1.0), (2, 1, t(2, 0), 1.0)], SCHEMA_I, "a")
    stream = runner.file_stream(spark, src, schema, recursive=True)
    runner.run_to_parquet(window_counts(stream, "ts", HOUR), out, ck)
    first = spark.read.parquet(out).count()
    drop(spark, src, [(3, 1, t(5, 0), 1.0)], SCHEMA_I, "b")
    runner.run_to_parquet(window_counts(stream, "ts", HOUR), out, ck)
    rows = spark.read.parquet(out)
    assert first == 1
    # Each closed window is written exactly once across the two runs.
    assert rows.groupBy("window_start").count().where("count > 1").count() == 0
    assert {r["window_start"].hour for r in rows.collect()} == {0, 2}


def _pairs(spark, tmp_path):
    src_i, src_e = str(tmp_path / "si"), str(tmp_path / "se")
    drop(spark, src_i, [(1, 7, t(0, 5), 10.0), (2, 7, t(0, 6), 20.0), (3, 8, t(1, 5), 5.0), (9, 9, t(5, 0), 0.0)],
         SCHEMA_I, "a")
    drop(spark, src_e, [(1, 7, t(0, 7), 10.01), (2, 7, t(0, 8), 99.0), (4, 8, t(1, 9), 5.0), (9, 9, t(5, 1), 0.0)],
         SCHEMA_E, "a")
    si = runner.file_stream(spark, src_i, spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
    se = runner.file_stream(spark, src_e, spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
    return si, se


def test_stream_outer_classifies_and_splits(spark, tmp_path):
    si, se = _pairs(spark, tmp_path)
    s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05)
    base = str(tmp_path / "split")
    q = runner.run_split(s, base, str(tmp_path / "ck"))
    rows = runner.read_split(spark, base, s.schema)
    got = {(r["event_id"], r["_merge"]) for r in rows.collect()}
    # Event 2 is outside the tolerance: two unmatched rows. Event 9's window is still open.
    assert got == {(1, "both"), (2, "left_only"), (2, "right_only"), (3, "left_only"), (4, "right_only"),
                   (9, "both")}
    assert spark.read.parquet(f"{base}/left_only").count() == 2
    metrics = {(r["window_start"].hour, r["n_records"], r["n_matched"]) for r in window_metrics(rows).collect()}
    assert (0, 3, 1) in metrics and (1, 2, 0) in metrics
    progress = runner.progress_frame(spark, q)
    assert progress.count() >= 1 and "processed_rows_per_second" in progress.columns


def test_sliding_windows_repeat_matches(spark, tmp_path):
    si, se = _pairs(spark, tmp_path)
    spec = WindowSpec("sliding", "1 hour", "30 minutes", "10 minutes")
    s = reconcile_stream(si, se, ["user_id", "event_id"], spec, amount_tolerance=0.05, how="inner")
    out = str(tmp_path / "o")
    runner.run_to_parquet(s, out, str(tmp_path / "ck"))
    # Each row lies in two 1-hour windows sliding by 30 minutes, so each pair appears twice.
    assert spark.read.parquet(out).where("event_id = 1").count() == 2


def test_window_spec_rules():
    with pytest.raises(ValueError):
        WindowSpec("session", "1 hour")
    with pytest.raises(ValueError):
        WindowSpec("sliding", "1 hour")


def test_stream_job_from_config(spark, tmp_path):
    from ledgermatch.plans.jobs import run_stream_job
    from ledgermatch.spec import JobSpec
    si, se = str(tmp_path / "si"), str(tmp_path / "se")
    drop(spark, si, [(1, 7, t(0, 5), 10.0), (2, 8, t(0, 6), 20.0), (3, 9, t(3, 0), 1.0)], SCHEMA_I, "a")
    drop(spark, se, [(1, 7, t(0, 7), 10.001), (3, 9, t(3, 1), 1.0)], SCHEMA_E, "a")
    cfg = {
        "sources": {"internal": {"type": "kafka", "topic": "x", "connection": {"bootstrap_servers": "b:1"}},
                    "external": {"type": "kafka", "topic": "y", "connection": {"bootstrap_servers": "b:1"}}},
        "window": {"type": "tumbling", "size": "1h", "grace": "10m"},
        "matching": {"match_on": ["date", "user_id", "event_id"], "internal_key": "amount",
                     "external_key": "net_amount", "tolerances": {"amount": 0.01}},
        "output": {"path": str(tmp_path / "out"), "reconciled_file": "matched", "unmatched_internal_file": "ui",
                   "unmatched_external_file": "ue", "format": "parquet"},
        "state": {"storage_path": str(tmp_path / "state")},
    }
    spec = JobSpec.from_dict(cfg)
    # No Kafka connector here: the same spec with folder sources instead.
    from dataclasses import replace
    spec = replace(spec, internal=replace(spec.internal, type="file", path=si, options={"recursive": True}),
                   external=replace(spec.external, type="file", path=se, options={"recursive": True}))
    schema_i = spark.createDataFrame([], SCHEMA_I).schema
    schema_e = spark.createDataFrame([], SCHEMA_E).schema
    q, schema, names = run_stream_job(spark, spec, schema_i, schema_e)
    # Matched rows are emitted at once, even for the still-open 03:00 window.
    assert {r["event_id"] for r in spark.read.parquet(str(tmp_path / "out" / "matched")).collect()} == {1, 3}
    assert {r["event_id"] for r in spark.read.parquet(str(tmp_path / "out" / "ui")).collect()} == {2}


def test_join_state_keeps_only_open_windows(spark, tmp_path):
    # Two rows a side per hour from 00:00 to 05:00; the watermark ends at 04:50,
    # so windows up to 04:00 close and leave the state store.
    rows_i = [(h * 10 + k, h, t(h, 5 + k), 1.0) for h in range(6) for k in range(2)]
    rows_e = [(h * 10 + k, h, t(h, 6 + k), 9.0) for h in range(6) for k in range(2)]
    drop(spark, str(tmp_path / "si"), rows_i, SCHEMA_I, "a")
    drop(spark, str(tmp_path / "se"), rows_e, SCHEMA_E, "a")
    si = runner.file_stream(spark, str(tmp_path / "si"), spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
    se = runner.file_stream(spark, str(tmp_path / "se"), spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
    s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05)
    q = runner.run_to_parquet(s, str(tmp_path / "o"), str(tmp_path / "ck"))
    last = runner.progress_frame(spark, q).orderBy(F.desc("batch_id")).first()
    out = spark.read.parquet(str(tmp_path / "o"))
    # Every row is outside the tolerance: the closed windows (00:00-03:00, 4 hours x 2 rows) are reported.
    assert out.where("_merge = 'left_only'").count() == 8 and out.where("_merge = 'right_only'").count() == 8
    # State holds only the open windows' rows (hours 4 and 5, 2 rows x 2 sides x 2 hours),
    # counted per side in the key-to-rows and key-index stores.
    assert 0 < last["state_rows"] <= 4 * 2 * 2


def test_salted_stream_join_equals_plain(spark, tmp_path):
    # One user carries most rows of the window, with repeated keys on both sides.
    rows_i = [(k % 5, 7, t(0, k % 50), float(k % 3)) for k in range(40)] + [(99, 8, t(2, 0), 1.0)]
    rows_e = [(k % 5, 7, t(0, k % 50 + 1), float(k % 4)) for k in range(30)] + [(98, 9, t(2, 5), 1.0)]
    drop(spark, str(tmp_path / "si"), rows_i, SCHEMA_I, "a")
    drop(spark, str(tmp_path / "se"), rows_e, SCHEMA_E, "a")
    schema_i = spark.createDataFrame([], SCHEMA_I).schema
    schema_e = spark.createDataFrame([], SCHEMA_E).schema
    results = []
    for buckets in (1, 4):
        si = runner.file_stream(spark, str(tmp_path / "si"), schema_i, recursive=True)
        se = runner.file_stream(spark, str(tmp_path / "se"), schema_e, recursive=True)
        s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05, salt_buckets=buckets)
        out = str(tmp_path / f"o{buckets}")
        runner.run_to_parquet(s, out, str(tmp_path / f"ck{buckets}"))
        rows = spark.read.parquet(out).collect()
        results.append(sorted(tuple("" if v is None else str(v) for v in r) for r in rows))
    assert results[0] == results[1] and len(results[0]) > 40


def test_stream_job_uses_date_as_event_time(spark, tmp_path):
    from ledgermatch.plans.jobs import run_stream_job
    from ledgermatch.spec import JobSpec
    schema = "customer_id string, location_id string, date timestamp, amount double"
    schema_e = "customer_id string, location_id string, date timestamp, net_amount double"
    drop(spark, str(tmp_path / "si"), [("C1", "L1", t(0, 5), 10.0), ("C2", "L1", t(0, 9), 5.0)], schema, "a")
    drop(spark, str(tmp_path / "se"), [("C1", "L1", t(0, 20), 10.0)], schema_e, "a")
    cfg = {
        "sources": {"internal": {"type": "file", "path": str(tmp_path / "si"), "recursive": True},
                    "external": {"type": "file", "path": str(tmp_path / "se"), "recursive": True}},
        "window": {"type": "tumbling", "size": "1h", "grace": "0m"},
        "matching": {"match_on": ["date", "customer_id", "location_id"], "internal_key": "amount",
                     "external_key": "net_amount"},
        "output": {"path": str(tmp_path / "out"), "reconciled_file": "m", "unmatched_internal_file": "ui",
                   "unmatched_external_file": "ue"},
    }
    run_stream_job(spark, JobSpec.from_dict(cfg), spark.createDataFrame([], schema).schema,
                   spark.createDataFrame([], schema_e).schema)
    matched = spark.read.option("header", True).csv(str(tmp_path / "out" / "m")).collect()  # the default format
    assert [(r["customer_id"], r["_merge"]) for r in matched] == [("C1", "both")]


def test_events_without_a_time_are_reported(spark, tmp_path):
    drop(spark, str(tmp_path / "si"), [(1, 7, t(0, 5), 10.0), (2, 7, None, 5.0)], SCHEMA_I, "a")
    drop(spark, str(tmp_path / "se"), [(1, 7, t(0, 6), 10.0), (3, 7, None, 6.0)], SCHEMA_E, "a")
    si = runner.file_stream(spark, str(tmp_path / "si"), spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
    se = runner.file_stream(spark, str(tmp_path / "se"), spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
    s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05)
    runner.run_to_parquet(s, str(tmp_path / "o"), str(tmp_path / "ck"))
    got = {(r["event_id"], r["_merge"], r["window_start"] is None) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {(1, "both", False), (2, "left_only", True), (3, "right_only", True)}


def test_day_tolerance_matches_across_windows(spark, tmp_path):
    # 00:59 and 01:00 are in different windows; 20:00 a day before is still within one floored day.
    drop(spark, str(tmp_path / "si"), [(1, 7, t(0, 59), 10.0), (2, 7, t(1, 0), 5.0)], SCHEMA_I, "a")
    drop(spark, str(tmp_path / "se"), [(1, 7, t(1, 0), 10.0), (2, 7, t(23, 0), 5.0)], SCHEMA_E, "a")
    si = runner.file_stream(spark, str(tmp_path / "si"), spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
    se = runner.file_stream(spark, str(tmp_path / "se"), spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
    s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05, date_tolerance_days=1)
    runner.run_to_parquet(s, str(tmp_path / "o"), str(tmp_path / "ck"))
    got = {(r["event_id"], r["_merge"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {(1, "both"), (2, "both")}


def test_late_rows_are_kept_apart_and_counted(spark, tmp_path):
    """Arrival by arrival: what a stateful stream would drop is in the late folders, the rest is on time."""
    from ledgermatch.streaming import late
    base, schemas = str(tmp_path), {"internal": SCHEMA_I, "external": SCHEMA_E}
    arrivals = [
        ([(1, 1, t(0, 5), 1.0), (2, 1, t(4, 0), 1.0), (9, 1, None, 1.0)], [(1, 1, t(0, 6), 1.0)]),
        ([(3, 1, t(0, 30), 1.0)], [(2, 1, t(6, 0), 1.0)]),   # the watermark is still the external side's: nothing is late
        ([(4, 1, t(2, 59), 1.0), (5, 1, t(3, 0), 1.0)], [(6, 1, t(1, 0), 1.0), (7, 1, t(9, 0), 1.0)]),   # 03:50 by now
        ([(8, 1, t(9, 0), 1.0), (10, 1, t(2, 0), 1.0)], []),
    ]
    watermarks = []
    for k, pair in enumerate(arrivals):
        for side, rows in zip(late.SIDES, pair):
            drop(spark, f"{base}/{side}", rows, schemas[side], f"a{k}")
        streams = [runner.file_stream(spark, f"{base}/{side}", spark.createDataFrame([], schemas[side]).schema, recursive=True) for side in late.SIDES]
        late.run_late_split(*streams, f"{base}/split", f"{base}/ck", HOUR)
        seen = {r.side: r.latest for r in spark.read.parquet(f"{base}/split/seen/batch={k}").collect()}
        watermarks.append(min(seen.values()))
    assert watermarks == [t(0, 6), t(4, 0), t(4, 0), t(9, 0)]
    got = {side: sorted((r.event_id, r.batch_id, r.watermark) for r in late.read_late(spark, f"{base}/split", side, spark.createDataFrame([], schemas[side]).schema).collect())
           for side in late.SIDES}
    assert got == {"internal": [(4, 2, t(3, 50)), (10, 3, t(3, 50))], "external": [(6, 2, t(3, 50))]}
    on_time = [spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/split/on_time/{side}").count() for side in late.SIDES]
    assert on_time[0] + 2 == sum(len(i) for i, _ in arrivals) and on_time[1] + 1 == sum(len(e) for _, e in arrivals)


def test_a_batch_that_runs_again_writes_what_is_missing(spark, tmp_path, monkeypatch):
    """A batch that broke off between two folders: the first one's files stay, so who read them gets no row twice."""
    from ledgermatch.sinks import publish
    from ledgermatch.streaming import late
    rows = spark.createDataFrame([(1, 1, t(0, 5), 1.0)], SCHEMA_I)
    batch = late._tagged(rows, spark.createDataFrame([(2, 1, t(0, 5), 1.0)], SCHEMA_E), "ts")
    split = late.late_split(spark, str(tmp_path), HOUR)

    def broken(df, folder):
        if "external" in folder:
            raise RuntimeError("lost")
        return publish.replace_folder(df, folder)

    monkeypatch.setattr(late, "replace_folder", broken)
    with pytest.raises(RuntimeError):
        split(batch, 0)
    monkeypatch.setattr(late, "replace_folder", publish.replace_folder)
    files = sorted(str(p) for p in (tmp_path / "on_time").rglob("*.parquet"))
    for _ in range(2):
        split(batch, 0)
    assert files and set(files) < {str(p) for p in (tmp_path / "on_time").rglob("*.parquet")}
    for side in late.SIDES:
        assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/on_time/{side}").count() == 1


@pytest.mark.parametrize("spec", [HOUR, WindowSpec("sliding", "1 hour", "15 minutes", "10 minutes"), WindowSpec("sliding", "50 minutes", "20 minutes"),
                                  WindowSpec("tumbling", "1 day")])
def test_last_window_end_is_that_of_the_windows(spark, spec):
    from ledgermatch.streaming import late
    from ledgermatch.streaming.windows import window_column
    df = spark.range(2000).select(F.timestamp_micros(F.col("id") * 7_654_321_987 - 3_000_000_000_000).alias("ts")).union(
        spark.createDataFrame([(t(1, 0),), (t(1, 15),), (t(0, 0),)], "ts timestamp"))
    df = df.withColumn("key", F.unix_micros("ts"))
    ends = df.withColumn("w", window_column(F.col("ts"), spec)).groupBy("key").agg(F.max("w.end").alias("want"))
    bad = df.withColumn("got", late.last_window_end(F.col("ts"), spec)).join(ends, "key").where("got != want or got is null or want is null")
    assert bad.count() == 0


def test_null_keys_match_as_in_a_batch(spark, tmp_path):
    drop(spark, str(tmp_path / "si"), [(1, None, t(0, 5), 10.0), (None, 8, t(0, 6), 5.0)], SCHEMA_I, "a")
    drop(spark, str(tmp_path / "se"), [(1, None, t(0, 7), 10.0), (9, 9, t(5, 0), 5.0)], SCHEMA_E, "a")
    for safe, want in ((True, {(1, "both"), (9, "right_only")}), (False, {(1, "left_only"), (1, "right_only"), (9, "right_only")})):
        si = runner.file_stream(spark, str(tmp_path / "si"), spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
        se = runner.file_stream(spark, str(tmp_path / "se"), spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
        s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05, null_safe_keys=safe)
        out = str(tmp_path / f"o{safe}")
        runner.run_to_parquet(s, out, str(tmp_path / f"ck{safe}"))
        got = {(r["event_id"], r["_merge"]) for r in spark.read.parquet(out).collect()}
        assert {x for x in got if x[0] != 9 and x[0] is not None} == {x for x in want if x[0] != 9}


def test_sliding_pairs_come_once(spark, tmp_path):
    si, se = _pairs(spark, tmp_path)
    spec = WindowSpec("sliding", "1 hour", "15 minutes", "10 minutes")
    s = reconcile_stream(si, se, ["user_id", "event_id"], spec, amount_tolerance=0.05, how="inner", pairs_once=True)
    runner.run_to_parquet(s, str(tmp_path / "o"), str(tmp_path / "ck"))
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 9]
    assert "window_start" not in s.columns
    with pytest.raises(ValueError):
        reconcile_stream(si, se, ["user_id"], spec, pairs_once=True)


def test_state_reader_and_pushed_metrics(spark, tmp_path):
    """RocksDB state holds open windows only; a listener gets each batch's figures, dropped rows among them."""
    listener = runner.ProgressListener()
    spark.streams.addListener(listener)
    try:
        drop(spark, str(tmp_path / "si"), [(1, 7, t(0, 5), 1.0), (2, 7, t(5, 0), 1.0)], SCHEMA_I, "a")
        drop(spark, str(tmp_path / "se"), [(1, 7, t(0, 6), 9.0), (3, 7, t(5, 1), 1.0)], SCHEMA_E, "a")

        def run():
            si = runner.file_stream(spark, str(tmp_path / "si"), spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
            se = runner.file_stream(spark, str(tmp_path / "se"), spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
            s = reconcile_stream(si, se, ["user_id", "event_id"], HOUR, amount_tolerance=0.05)
            with runner.rocksdb_state(spark):
                return runner.run_to_parquet(s, str(tmp_path / "o"), str(tmp_path / "ck"))

        run()
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
        assert "RocksDB" not in before
        assert sorted(r.i_event_id for r in runner.join_state(spark, str(tmp_path / "ck"), "left").collect()) == [2]
        # two batches on, a row of a window that has ended is dropped and counted
        drop(spark, str(tmp_path / "si"), [(4, 7, t(0, 30), 1.0), (5, 7, t(6, 0), 1.0)], SCHEMA_I, "b")
        q = run()
        assert sum(r.rows_dropped_by_watermark for r in runner.progress_frame(spark, q).collect()) == 1
        for _ in range(100):
            if len(listener.ended) >= 2 and sum(r[-1] for r in listener.rows) == 1:
                break
            import time
            time.sleep(0.1)
        rows = listener.frame(spark).collect()
        # both sides are read twice: for the join, and for events without a time
        assert sum(r.num_input_rows for r in rows) == 12 and sum(r.rows_dropped_by_watermark for r in rows) == 1
    finally:
        spark.streams.removeListener(listener)


def test_stream_job_keeps_late_events(spark, tmp_path):
    """Two runs of the job: what comes late to the second one is neither matched nor lost."""
    from ledgermatch.plans.jobs import run_stream_job
    from ledgermatch.spec import JobSpec
    from ledgermatch.streaming import late
    cfg = {
        "sources": {side: {"type": "file", "path": str(tmp_path / side), "recursive": True} for side in late.SIDES},
        "window": {"type": "tumbling", "size": "1h", "grace": "10m"},
        "matching": {"match_on": ["user_id", "event_id"], "internal_key": "amount", "external_key": "net_amount"},
        "output": {"path": str(tmp_path / "out"), "reconciled_file": "m", "unmatched_internal_file": "ui", "unmatched_external_file": "ue", "format": "parquet"},
    }
    schema_i, schema_e = (spark.createDataFrame([], x).schema for x in (SCHEMA_I, SCHEMA_E))
    arrivals = [([(1, 7, t(0, 5), 1.0), (2, 7, t(5, 0), 1.0)], [(1, 7, t(0, 6), 1.0), (3, 7, t(5, 0), 1.0)]),
                ([(4, 7, t(0, 30), 1.0), (3, 7, t(5, 1), 1.0)], [(4, 7, t(0, 31), 1.0)])]
    for k, (rows_i, rows_e) in enumerate(arrivals):
        drop(spark, str(tmp_path / "internal"), rows_i, SCHEMA_I, f"a{k}")
        drop(spark, str(tmp_path / "external"), rows_e, SCHEMA_E, f"a{k}")
        run_stream_job(spark, JobSpec.from_dict(cfg), schema_i, schema_e, late_path=str(tmp_path / "split"))
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out" / "m")).collect()) == [1, 3]
    held = [late.read_late(spark, str(tmp_path / "split"), side, schema).collect() for side, schema in zip(late.SIDES, (schema_i, schema_e))]
    assert [[(r.event_id, r.batch_id, r.watermark) for r in rows] for rows in held] == [[(4, 1, t(4, 50))], [(4, 1, t(4, 50))]]


def _out_of_order(spark, folder, n=400):
    """Four days of events in no order of time, some without a time; one file."""
    ts = F.timestamp_seconds(1_704_067_200 + (F.col("id") * 7919 % n) * 864)
    events = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 50 != 9, ts).alias("ts"),
                                   F.lit("x").alias("event_type"), (F.col("id") % 5).cast("double").alias("value"))
    events.coalesce(1).write.parquet(str(folder / "landed"))
    part = next((folder / "landed").glob("*.parquet"))
    (folder / "events.parquet").write_bytes(part.read_bytes())
    return str(folder)


def _values(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", ["stream_recon_outer", "stream_recon_outer_salted", "stream_sliding_pairs", "stream_recon_days", "stream_late_balance", "stream_state_rows",
                                  "stream_split_csv"])
def test_many_triggers_give_what_one_gives(spark, tmp_path, monkeypatch, name):
    """A table in no order of time, replayed by time in bounded triggers: the rows of one batch."""
    from ledgermatch.plans.catalog import QUERIES
    from ledgermatch.streaming import replay
    taken = []
    for function in ("run_to_parquet", "run_split"):
        def ran(*args, run=getattr(runner, function), **kwargs):
            q = run(*args, **kwargs)
            taken.append([p["numInputRows"] for p in q.recentProgress])
            return q
        monkeypatch.setattr(runner, function, ran)
    sf_dir = _out_of_order(spark, tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        want = _values(QUERIES[name](spark, sf_dir))
        monkeypatch.setattr(replay, "ROWS_PER_TRIGGER", 100)
        assert _values(QUERIES[name](spark, sf_dir)) == want and want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    one, many = taken
    assert len([n for n in many if n]) >= 4 and max(many) < max(one)


def test_files_are_taken_by_time(spark, tmp_path):
    """Modification times follow the names, and what is written next is later; a folder where they do not is not in order."""
    import os
    from ledgermatch.streaming import replay
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 7919 % 1000).alias("ts"))
    paths = [str(tmp_path / x) for x in "ab"]
    assert [replay.land(df, p, "ts", replay.file_count(1000, 200)) for p in paths] == [replay.FILES_PER_TRIGGER] * 2
    assert replay.kept_order(spark, paths) and not replay.kept_order(spark, paths[::-1])
    ranges = [df.sparkSession.read.parquet(f).agg(F.min("ts"), F.max("ts")).first() for f in sorted(map(str, (tmp_path / "a").glob("*.parquet")), key=os.path.getmtime)]
    assert len(ranges) == 20 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_sliding_pairs_hold_a_row_once(spark, tmp_path):
    """Rows within the size that share no window are no pair; state has one row for each event, not one for each window."""
    at = [(k, 7, t(0, k), 1.0) for k in range(60)]
    drop(spark, str(tmp_path / "si"), at, SCHEMA_I, "a")
    drop(spark, str(tmp_path / "se"), [(k, 7, t(0, k) + dt.timedelta(minutes=m), 1.0) for k in range(60) for m in (0, 40, 50, 59)], SCHEMA_E, "a")
    si = runner.file_stream(spark, str(tmp_path / "si"), spark.createDataFrame([], SCHEMA_I).schema, recursive=True)
    se = runner.file_stream(spark, str(tmp_path / "se"), spark.createDataFrame([], SCHEMA_E).schema, recursive=True)
    s = reconcile_stream(si, se, ["user_id", "event_id"], WindowSpec("sliding", "1 hour", "15 minutes", "10 minutes"), how="inner", pairs_once=True)
    q = runner.run_to_parquet(s, str(tmp_path / "o"), str(tmp_path / "ck"))
    got = {(r.event_id, int((r.ts_external - r.ts_internal).total_seconds()) // 60) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {(k, m) for k in range(60) for m in (0, 40, 50, 59) if k + m < k // 15 * 15 + 60}
    assert q.recentProgress[0]["stateOperators"][-1]["numRowsUpdated"] + q.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] <= 60 + 240 + len(got)
