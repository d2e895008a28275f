"""The nightly batch without all of history: only what a load can change is read.

A pair shares its day, so a load can change the fact rows of the days that it has
rows of, and of no other. Both ledgers' items are kept by load date and period of
their day (day, month or year); a load

1. lands its rows beside the items, which is the only time that they are worked out, and
   names the periods it touches: those of its rows, of the rows it replaces and of
   runs that broke off. Periods are folders, so listing them tells without reading a row;
2. replaces its own rows, so that a rerun of a load leaves nothing of the first;
3. reads both sides' items of these periods, open and matched, other partitions
   being pruned, and works out their fact rows;
4. replaces these periods of the fact table, and no other.

Periods that no load touches any more are closed: their items are never read
again, and their fact rows, open items among them, stay as they are. A row that
comes late opens its period once more.

The result equals a full rebuild with ``id_check="trusted"`` over all loads. The
exact id rule asks whether an id was paired on any day, which is a question to all
of history; ``jobs.batch_pipeline`` answers it.

The touched periods are noted as folders under ``pending`` before anything is
replaced and removed in the end, so a run that fails is made good by the next one.
They are a part of the calendar, which bounds what the driver gets to know of a load.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.functions import StatusLabels
from ledgermatch.operators import mart
from ledgermatch.sinks import publish
from ledgermatch.sources.files import resolve_path

SIDES = ("internal", "external")
_GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
#: Period of rows without a date. They pair with nothing.
NO_DATE = "none"


@dataclass
class LoadResult:
    #: The whole fact table as it is now.
    fact: DataFrame
    #: The periods that were worked out anew.
    touched: list[str]


def _period(grain: str) -> Column:
    return F.coalesce(F.date_format("transaction_date", _GRAINS[grain]), F.lit(NO_DATE))


def _periods(spark: SparkSession, loads: Iterable[str]) -> set[str]:
    """Periods that these folders have rows of."""
    return {n.removeprefix("period=") for folder in loads for n in publish.folders(spark, folder) if n.startswith("period=")}


def run_load(spark: SparkSession, path: str, load_date: str, internal: DataFrame, external: DataFrame, run_ts: str | None = None,
             tolerance: float = 0.05, labels: StatusLabels = StatusLabels(), grain: str = "day") -> LoadResult:
    """Take in one load of staged ledgers (``stage_internal`` / ``stage_external``) and bring the fact table up to date."""
    if grain not in _GRAINS:
        raise ValueError(f"grain is one of {sorted(_GRAINS)}, not {grain!r}")
    base, day = resolve_path(path).rstrip("/"), str(date.fromisoformat(load_date))
    loads = dict(zip(SIDES, (internal, external)))
    loads = {side: df.withColumn("period", _period(grain)) for side, df in loads.items()}
    places = {side: f"{base}/items/{side}" for side in SIDES}
    fact_path, pending_path = f"{base}/fact", f"{base}/pending/load_date={day}"

    own = {side: f"{places[side]}/load_date={day}" for side in SIDES}
    landed = {}
    try:
        for side, df in loads.items():
            landed[side] = publish.land(df.drop("load_date").hint("rebalance", F.col("period")), own[side], partition_by=["period"])
    except Exception:
        for folder in landed.values():
            publish.remove(spark, folder)
        raise
    touched = _periods(spark, (*landed.values(), *own.values(), *publish.subfolders(spark, f"{base}/pending")))
    for period in touched:
        publish.make_folder(spark, f"{pending_path}/period={period}")

    items = {}
    for side, df in loads.items():
        publish.take_place(spark, landed[side], own[side])
        schema = df.drop("period").schema.add("load_date", "string").add("period", "string")
        # periods are partitions, so other files are not even opened
        items[side] = spark.read.schema(schema).parquet(places[side]).where(F.col("period").isin(*touched))
    fact = mart.fct_reconciled(items["internal"], items["external"], tolerance, labels, "trusted", run_ts).withColumn("period", _period(grain))
    publish.replace_partitions(fact.hint("rebalance", F.col("period")), fact_path, ["period"])
    # a load that was replaced by one without rows of a period leaves that period's old fact rows
    held = _periods(spark, [load for side in SIDES for load in publish.subfolders(spark, places[side])])
    for period in touched - held:
        publish.remove(spark, f"{fact_path}/period={period}")
    publish.remove(spark, f"{base}/pending")
    whole = spark.read.schema(fact.schema).parquet(fact_path)
    return LoadResult(whole, sorted(touched))
