"""``read_source``: one reader per source type, chosen from the spec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.sources import connectors, files
from ledgermatch.spec import SourceSpec


def _split(opts: dict) -> dict:
    """How a database read is cut into parallel ranges."""
    bounds = {k: int(opts[k]) for k in ("lower_bound", "upper_bound", "fetch_size") if opts.get(k) is not None}
    return {"partition_column": opts.get("partition_column", "id"), "num_partitions": int(opts.get("num_partitions", 64)), **bounds}


def read_source(spark: SparkSession, src: SourceSpec) -> DataFrame:
    """Batch read of a file or database source (``kafka`` is read by the streaming module)."""
    opts = dict(src.options)
    parse_dates = tuple(opts.pop("parse_dates", ("date",)))
    if src.type in ("file", "csv", "psv"):
        if src.path and (src.path.endswith(".parquet") or opts.get("format") == "parquet"):
            return files.read_parquet(spark, src.path, opts.get("columns"), opts.get("where"), parse_dates)
        return files.read_delimited(spark, src.path, schema=opts.get("schema"), infer_schema=bool(opts.get("infer_schema", False)),
                                    parse_dates=parse_dates, multiline=bool(opts.get("multiline", False)))
    if src.type == "parquet":
        return files.read_parquet(spark, src.path, opts.get("columns"), opts.get("where"), parse_dates)
    if src.type == "bigquery":
        return connectors.read_bigquery(spark, src.connection["project_id"], src.query, parse_dates,
                                        materialization_dataset=opts.get("materialization_dataset"))
    if src.type == "redshift":
        c = src.connection
        jdbc = connectors.redshift_source(c["host"], c["database"], c["user"], c["password"], src.query,
                                          port=int(c.get("port", connectors.REDSHIFT_PORT)),
                                          schema=c.get("schema", connectors.REDSHIFT_SCHEMA),
                                          **_split(opts))
        return connectors.read_jdbc(spark, jdbc, parse_dates)
    if src.type == "jdbc":
        c = src.connection
        jdbc = connectors.JdbcSource(url=c["url"], query=src.query, user=c.get("user"), password=c.get("password"),
                                     driver=c.get("driver"), **_split(opts))
        return connectors.read_jdbc(spark, jdbc, parse_dates)
    raise ValueError(f"Unsupported source type: {src.type}")
