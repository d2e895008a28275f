"""The incremental batch against full rebuilds."""

import os
import random
import shutil

import pytest

from pyspark.sql import functions as F

from ledgermatch.operators import mart, staging
from ledgermatch.plans import incremental
from ledgermatch.sources import files

RNG = random.Random(9)


def _load(spark, rows_i, rows_e):
    raw_i = spark.createDataFrame(rows_i, files.RAW_INTERNAL_SCHEMA)
    raw_e = spark.createDataFrame(rows_e, files.RAW_EXTERNAL_SCHEMA)
    return [staging.stage_internal(raw_i).drop("ingestion_timestamp"), staging.stage_external(raw_e).drop("ingestion_timestamp")]


def _row(side, k, day):
    key = (f"2024-03-{day:02d}" if day else None, RNG.choice(["K1", "K2", None]), RNG.choice(["R1", "R2"]))
    return (f"{side}{k}", *key, float(RNG.randint(1, 3)), 0.0) if side == "i" else (f"{side}{k}", *key, float(RNG.randint(1, 3)))


def _facts(df):
    return sorted((tuple(str(r[c]) for c in mart.MART_COLUMNS[:-1]) for r in df.collect()))


@pytest.fixture
def loads():
    """Four days of loads; some rows come for earlier days, some have no day."""
    out = []
    for day in range(1, 5):
        days = [day] * 6 + [RNG.randint(1, day), 0]
        out.append(([_row("i", f"{day}_{j}", d) for j, d in enumerate(days)], [_row("e", f"{day}_{j}", d) for j, d in enumerate(days)]))
    return out


@pytest.mark.parametrize("grain", ["day", "month"])
def test_equals_a_rebuild_after_every_load(spark, tmp_path, loads, grain):
    path, all_i, all_e = str(tmp_path / "state"), [], []
    for day, (i, e) in enumerate(loads, 1):
        all_i, all_e = all_i + i, all_e + e
        res = incremental.run_load(spark, path, f"2024-03-{day:02d}", *_load(spark, i, e), grain=grain)
        assert _facts(res.fact) == _facts(mart.fct_reconciled(*_load(spark, all_i, all_e), id_check="trusted"))


def test_closed_days_are_never_read_again(spark, tmp_path, loads):
    path = str(tmp_path / "state")
    only = [([r for r in i if r[1] == f"2024-03-{d:02d}"], [r for r in e if r[1] == f"2024-03-{d:02d}"]) for d, (i, e) in enumerate(loads, 1)]
    incremental.run_load(spark, path, "2024-03-01", *_load(spark, *only[0]))
    before = _facts(mart.fct_reconciled(*_load(spark, only[0][0] + only[1][0], only[0][1] + only[1][1]), id_check="trusted"))
    # unreadable items of a closed day do no harm
    for side in incremental.SIDES:
        folder = f"{path}/items/{side}/load_date=2024-03-01/period=2024-03-01"
        for name in os.listdir(folder):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"not parquet")
    res = incremental.run_load(spark, path, "2024-03-02", *_load(spark, *only[1]))
    assert _facts(res.fact) == before
    assert res.touched == ["2024-03-02"]


def test_a_rerun_replaces_its_load_and_clears_what_it_left(spark, tmp_path, loads):
    path = str(tmp_path / "state")
    for day in (1, 2):
        incremental.run_load(spark, path, f"2024-03-0{day}", *_load(spark, *loads[day - 1]))
    moved_i = [(r[0], "2024-03-20", *r[2:]) for r in loads[1][0]]
    res = incremental.run_load(spark, path, "2024-03-02", *_load(spark, moved_i, []))
    assert _facts(res.fact) == _facts(mart.fct_reconciled(*_load(spark, loads[0][0] + moved_i, loads[0][1]), id_check="trusted"))


def test_a_broken_run_is_made_good(spark, tmp_path, loads, monkeypatch):
    path = str(tmp_path / "state")
    incremental.run_load(spark, path, "2024-03-01", *_load(spark, *loads[0]))
    fact = mart.fct_reconciled

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(mart, "fct_reconciled", broken)
    with pytest.raises(RuntimeError):
        incremental.run_load(spark, path, "2024-03-02", *_load(spark, *loads[1]))
    monkeypatch.setattr(mart, "fct_reconciled", fact)
    # the next load works out the broken one's days as well
    res = incremental.run_load(spark, path, "2024-03-03", *_load(spark, *loads[2]))
    rows = [sum((side for side in part), []) for part in zip(*loads[:3])]
    assert _facts(res.fact) == _facts(mart.fct_reconciled(*_load(spark, *rows), id_check="trusted"))
    assert not os.path.exists(f"{path}/pending")
    shutil.rmtree(path)
    with pytest.raises(ValueError):
        incremental.run_load(spark, path, "2024-03-03", *_load(spark, *loads[2]), grain="week")


def test_a_load_is_worked_out_once(spark, tmp_path, loads):
    """The rows of a load are read for its landing only; which periods it touches is known from the folders."""
    path, read = str(tmp_path / "state"), spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            read.add(1)
            yield r

    i, e = _load(spark, *loads[0])
    frames = [spark.createDataFrame(df.rdd.mapPartitions(counted), df.schema) for df in (i, e)]
    res = incremental.run_load(spark, path, "2024-03-01", *frames)
    assert read.value == len(loads[0][0]) + len(loads[0][1])
    assert _facts(res.fact) == _facts(mart.fct_reconciled(i, e, id_check="trusted")) and res.touched == ["2024-03-01", "none"]


def test_the_mart_is_worked_out_once_for_all_loads_of_a_table(spark, monkeypatch):
    from ledgermatch.plans import catalog
    from ledgermatch.sinks import writers
    plans = []
    save = writers.save_table
    monkeypatch.setattr(writers, "save_table", lambda df, *args, **kwargs: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), save(df, *args, **kwargs)))
    out = catalog.QUERIES["sink_database_table"](spark, "/root/testdata/sf0.001")
    assert _facts(out.withColumn("x", F.lit(0))) == _facts(catalog.QUERIES["fct_reconciled"](spark, "/root/testdata/sf0.001").withColumn("x", F.lit(0)))
    assert len(plans) == 3 and not any("Join" in p for p in plans)
