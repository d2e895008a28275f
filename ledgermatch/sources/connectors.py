"""Database, warehouse and Kafka sources as Spark reader options.

The cluster supplies the drivers / connectors (JDBC driver jar, the
BigQuery connector, ``spark-sql-kafka``); this module only builds the
reader. Reads are parallel: JDBC splits on a numeric column, BigQuery reads
through its storage API, Kafka by topic partition.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

REDSHIFT_PORT = 5439
REDSHIFT_SCHEMA = "public"


@dataclass(frozen=True)
class JdbcSource:
    """A query read in parallel, split on ``partition_column`` into ranges."""

    url: str
    query: str
    user: str | None = None
    password: str | None = None
    partition_column: str | None = "id"
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int = 64
    fetch_size: int = 10_000
    driver: str | None = None
    extra: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        # "query" and "partitionColumn" exclude each other, so the query is a subquery table.
        opts = {"url": self.url, "dbtable": f"({self.query}) AS src", "fetchsize": str(self.fetch_size)}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        if self.partition_column and self.lower_bound is not None and self.upper_bound is not None:
            opts.update({"partitionColumn": self.partition_column, "lowerBound": str(self.lower_bound),
                         "upperBound": str(self.upper_bound), "numPartitions": str(self.num_partitions)})
        opts.update(self.extra)
        return opts


def redshift_url(host: str, database: str, port: int = REDSHIFT_PORT, schema: str = REDSHIFT_SCHEMA) -> str:
    """PostgreSQL-protocol URL; the schema becomes the search path."""
    return f"jdbc:postgresql://{host}:{port}/{database}?currentSchema={schema}"


def redshift_source(host: str, database: str, user: str, password: str, query: str,
                    port: int = REDSHIFT_PORT, schema: str = REDSHIFT_SCHEMA, **kw) -> JdbcSource:
    return JdbcSource(url=redshift_url(host, database, port, schema), query=query, user=user,
                      password=password, driver=kw.pop("driver", "org.postgresql.Driver"), **kw)


def _bounds(spark: SparkSession, src: JdbcSource) -> tuple[int, int] | None:
    """MIN/MAX of the split column, computed by the database in one tiny query."""
    probe = JdbcSource(url=src.url, user=src.user, password=src.password, driver=src.driver,
                       query=f"SELECT MIN({src.partition_column}) AS lo, MAX({src.partition_column}) AS hi "
                             f"FROM ({src.query}) AS b", partition_column=None, extra=src.extra)
    row = spark.read.format("jdbc").options(**probe.options()).load().first()
    if row is None or row["lo"] is None:
        return None
    return int(row["lo"]), int(row["hi"])


def read_jdbc(spark: SparkSession, src: JdbcSource, parse_dates: tuple[str, ...] = ("date",)) -> DataFrame:
    """Parallel JDBC read; bounds are looked up when not given."""
    if src.partition_column and (src.lower_bound is None or src.upper_bound is None):
        bounds = _bounds(spark, src)
        if bounds is not None:
            src = replace(src, lower_bound=bounds[0], upper_bound=bounds[1])
    if "numPartitions" not in src.options() and src.num_partitions > 1:
        log.warning("reading %s in one task: there is no column to split it on", src.url)
    df = spark.read.format("jdbc").options(**src.options()).load()
    from ledgermatch.sources.files import parse_date_columns
    return parse_date_columns(df, [c for c in parse_dates if c in df.columns])


def bigquery_options(project_id: str, query: str, materialization_dataset: str | None = None) -> dict[str, str]:
    """Options for the BigQuery connector's query read (views enabled)."""
    opts = {"query": query, "parentProject": project_id, "viewsEnabled": "true"}
    if materialization_dataset:
        opts["materializationDataset"] = materialization_dataset
    return opts


def read_bigquery(spark: SparkSession, project_id: str, query: str, parse_dates: tuple[str, ...] = ("date",),
                  **kw) -> DataFrame:
    df = spark.read.format("bigquery").options(**bigquery_options(project_id, query, **kw)).load()
    from ledgermatch.sources.files import parse_date_columns
    return parse_date_columns(df, [c for c in parse_dates if c in df.columns])


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  security: dict | None = None, starting_offsets: str = "earliest",
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` including SASL settings.

    Records that expired before they were read stop the stream: skipped ones would
    come out as unmatched rows of the other side. ``fail_on_data_loss=False`` skips them.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    sec = security or {}
    if "security_protocol" in sec:
        opts["kafka.security.protocol"] = sec["security_protocol"]
    if "sasl_mechanism" in sec:
        opts["kafka.sasl.mechanism"] = sec["sasl_mechanism"]
    if "username" in sec:
        opts["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f"username=\"{sec['username']}\" password=\"{sec.get('password', '')}\";")
    return opts


def read_kafka_stream(spark: SparkSession, options: dict[str, str], value_schema: T.StructType) -> DataFrame:
    """Stream of JSON records; the Kafka timestamp is kept as ``kafka_ts``."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return parse_records(raw, value_schema)


def parse_records(raw: DataFrame, value_schema: T.StructType) -> DataFrame:
    """JSON in ``value`` to columns; a malformed record fails the stream rather than vanish as a row of nulls."""
    return raw.select(F.from_json(F.col("value").cast("string"), value_schema, {"mode": "FAILFAST"}).alias("v"),
                      F.col("timestamp").alias("kafka_ts")).select("v.*", "kafka_ts")
