"""Tables replaced in one step: failures, readers in between, buckets and load days."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgermatch.operators.reconcile import MatchSpec, reconcile
from ledgermatch.plans import jobs
from ledgermatch.sinks import publish, writers
from ledgermatch.spec import OutputSpec


def _rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def _failing(spark):
    """Rows of which the last raises, after others were written."""
    return spark.range(20_000).repartition(8).select(F.when(F.col("id") == 19_999, F.raise_error(F.lit("bad row")).cast("int"))
                                                     .otherwise(F.col("id").cast("int")).alias("v"))


def _values(df):
    return sorted(r.v for r in df.collect())


def test_a_failed_publish_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "mart")
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path)
    publish.publish(_rows(spark, 1, 2), path)
    with pytest.raises(Exception, match="bad row"):
        publish.publish(_failing(spark), path)
    assert _values(publish.read_published(spark, path)) == [1, 2]
    publish.publish(_rows(spark, 3), path)
    assert _values(publish.read_published(spark, path)) == [3]


def test_readers_keep_their_version_and_old_ones_expire(spark, tmp_path):
    path = str(tmp_path / "mart")
    publish.publish(_rows(spark, 0), path)
    reader = publish.read_published(spark, path)
    for k in (1, 2):
        publish.publish(_rows(spark, k), path, keep=2)
        assert _values(reader) == [0]
    publish.publish(_rows(spark, 3), path, keep=2)
    assert len(publish.versions(spark, path)) == 3 and _values(publish.read_published(spark, path)) == [3]
    assert not [n for n in os.listdir(path) if n.startswith("._current-")]


@pytest.mark.parametrize("write", [writers.overwrite_table, publish.replace_folder])
def test_a_failed_overwrite_leaves_the_folder(spark, tmp_path, write):
    path = str(tmp_path / "t")
    write(_rows(spark, 1, 2), path)
    with pytest.raises(Exception, match="bad row"):
        write(_failing(spark), path)
    assert _values(spark.read.parquet(path)) == [1, 2]
    assert os.listdir(tmp_path) == ["t"]
    # a table may be replaced by what was read from it
    write(spark.read.parquet(path).where("v > 1"), path)
    assert _values(spark.read.parquet(path)) == [2] and os.listdir(tmp_path) == ["t"]


def test_a_mart_that_fails_half_way_leaves_yesterdays(spark, tmp_path):
    head = "transaction_id,date,customer_id,location_id,amount,fee\n"
    for side, tail in (("i", ",1\n"), ("e", "\n")):
        (tmp_path / f"{side}.csv").write_text((head if side == "i" else head.replace(",fee", "")) + f"a,2021-05-06,K1,R1,10{tail}")
        (tmp_path / f"{side}_bad.csv").write_text((head if side == "i" else head.replace(",fee", "")) + f"a,2021-05-06,K1,R1,10{tail}b,no date,K1,R1,10{tail}")
    mart = str(tmp_path / "mart")
    run = lambda bad: jobs.batch_pipeline(spark, str(tmp_path / f"i{bad}.csv"), str(tmp_path / f"e{bad}.csv"), mart, run_ts="2024-06-30 05:00:00",
                                          raw_path=str(tmp_path / "raw"))
    first = run("")
    with pytest.raises(Exception):
        run("_bad")
    rows = publish.read_published(spark, mart).collect()
    assert [(r.internal_transaction_id, r.match_status) for r in rows] == [("a", "AMOUNT_VARIANCE")]
    assert publish.current_version(spark, mart) == first.fact_path


def test_a_catalog_table_moves_to_its_new_version(spark, tmp_path):
    path, name = str(tmp_path / "mart"), "published_mart_test"
    writers.save_table(_rows(spark, 1), name, path=path)
    with pytest.raises(Exception, match="bad row"):
        writers.save_table(_failing(spark), name, path=path)
    assert _values(spark.table(name)) == [1]
    writers.save_table(_rows(spark, 2, 3), name, path=path)
    assert _values(spark.table(name)) == [2, 3]
    writers.save_table(_rows(spark, 4).withColumn("w", F.lit("x")), name, path=path)
    assert spark.table(name).columns == ["v", "w"]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = []
        for side in ("left", "right"):
            df = spark.range(500).select((F.col("id") % 40).alias("k"), F.concat(F.lit("x"), F.col("id") % 3).alias("l"), F.lit(side).alias(side))
            frames.append(writers.save_bucketed(df, f"bucketed_{side}", ["k", "l"], 4, str(tmp_path / side)))
            assert len([f for f in os.listdir(tmp_path / side) if f.endswith(".parquet")]) <= 4
        joined = frames[0].join(frames[1], ["k", "l"])
        assert joined.count() == spark.range(500).selectExpr("id % 40 k", "id % 3 l").groupBy("k", "l").count().selectExpr("sum(count * count) n").first().n
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" not in frames[0].groupBy("k", "l").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_load_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "loads")
    writers.write_load(_rows(spark, 1, 2), path, "2024-01-01")
    writers.write_load(_rows(spark, 3, 4), path, "2024-01-02")
    before = sorted(os.listdir(f"{path}/load_date=2024-01-01"))
    writers.write_load(_rows(spark, 5), path, "2024-01-02")
    writers.write_load(_rows(spark), path, "2024-01-03")
    table = spark.read.schema("v int, load_date string").parquet(path)
    assert sorted((r.load_date, r.v) for r in table.collect()) == [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 5)]
    assert sorted(os.listdir(f"{path}/load_date=2024-01-01")) == before
    with pytest.raises(ValueError):
        writers.write_load(_rows(spark), path, "yesterday")
    # a table of days prunes the others as the query runs
    days = spark.createDataFrame([("2024-01-02", 1)], "load_date string, x int").where("x = 1")
    read = table.join(F.broadcast(days), "load_date")
    assert _values(read) == [5]
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_the_write(spark, tmp_path):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "date string, amount double")
    right = spark.createDataFrame([("a", 1.0), ("d", 2.0)], "date string, net_amount double")
    seen = Observation()
    writers.write_outputs(reconcile(left, right, MatchSpec(("date",))).classified, OutputSpec(str(tmp_path / "o"), "m", "ui", "ue"), seen)
    assert tuple(writers.observed_counts(spark, seen).first()) == (1, 2, 1)
