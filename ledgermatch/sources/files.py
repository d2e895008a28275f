"""Delimited and parquet file sources.

Path rules of the original loader, kept as behaviour:

* a path ending in ``.psv`` (case-sensitive) is pipe-separated, anything else
  is comma-separated;
* a path must exist (``FileNotFoundError`` otherwise); globs are allowed as long
  as they match something. Spark resolves paths on their own file system, so
  this holds for any scheme and for a cluster's default one;
* ``s3://`` is read through Hadoop's ``s3a://`` file system, other URL schemes
  as they are (the cluster must carry the connector).

Reading. Columns are bound by their names in the header, whatever their order.
A schema names and types the columns that are wanted (no inference pass over
100 TB); all cells are read as text, pandas' NA tokens become nulls, and then
the types are cast, so ``NA`` in a number column is a null and other text there
fails the read, whatever the session's ANSI setting. Without a schema all columns
stay text; ``infer_schema="lattice"`` works out types by ``inference.infer_types``
(ids with leading zeros and declared keys stay text), and ``infer_schema=True`` is
Spark's own inference pass over all rows. Cells may be quoted, with doubled quotes
inside; line breaks inside quotes need ``multiline=True``, since a file with them
cannot be split. Files read together must have the same header; one that
differs is an error, never a silent shift of columns.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.functions import PANDAS_NA_TOKENS, na_to_null
from ledgermatch.sources.inference import infer_types

log = logging.getLogger(__name__)

# The column layout of the nightly raw loads.
RAW_INTERNAL_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("fee", T.DoubleType()),
])
RAW_EXTERNAL_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
])


@contextmanager
def _missing_as_file_not_found(path: str):
    """Spark reports a missing path (any scheme) as PATH_NOT_FOUND when the read resolves."""
    try:
        yield
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            log.error("Failed to load %s: not found", path)
            raise FileNotFoundError(f"File not found: {path}") from exc
        raise


def delimiter_for(path: str) -> str:
    return "|" if path.endswith(".psv") else ","


def resolve_path(path: str) -> str:
    """The path as Spark reads it."""
    return "s3a://" + path[len("s3://"):] if urlparse(path).scheme == "s3" else path


def _wanted(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _cells(spark: SparkSession, path: str, sep: str, multiline: bool) -> DataFrame:
    """All cells as text, columns named by the header. Every file must have that header."""
    reader = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
              .option("mode", "FAILFAST").option("multiLine", multiline))
    with _missing_as_file_not_found(path):
        names = reader.option("inferSchema", False).csv(resolve_path(path)).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        return reader.schema(schema).option("enforceSchema", False).csv(resolve_path(path))


def _typed(df: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    """The schema's columns by name, cast from text (a value that does not fit fails)."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return df.select([_strict(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType, f.name, path).alias(f.name) for f in schema])


def _strict(cell: Column, given: T.DataType, wanted: T.DataType, name: str, path: str) -> Column:
    """A cast that fails on what does not fit. That is not left to the session's ANSI setting, without which it gives nulls."""
    if given == wanted:
        return cell
    value = cell.try_cast(wanted)
    message = F.concat(F.lit(f"{path}: column {name} has no {wanted.simpleString()} in "), cell.cast("string"))
    return F.when(cell.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   infer_schema: bool | str = False, parse_dates: Sequence[str] = ("date",),
                   na_values: Sequence[str] | None = PANDAS_NA_TOKENS, sep: str | None = None,
                   multiline: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """CSV / PSV scan with header; see the module's description. ``keys`` stay text where types are inferred."""
    log.info("Reading delimited file %s", path)
    sep = sep or delimiter_for(path)
    if infer_schema not in (False, True, "lattice"):
        raise ValueError(f"infer_schema is False, True or 'lattice', not {infer_schema!r}")
    if infer_schema is True and schema is None:
        with _missing_as_file_not_found(path):
            df = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
                  .option("mode", "FAILFAST").option("multiLine", multiline).option("inferSchema", True)
                  .csv(resolve_path(path)))
    else:
        df = _cells(spark, path, sep, multiline)
    if na_values:
        df = df.select([na_to_null(F.col(f"`{c}`"), tuple(na_values)).alias(c) if t == "string" else F.col(f"`{c}`")
                        for c, t in df.dtypes])
    if schema is None and infer_schema == "lattice":
        schema = infer_types(df, keys)
    if schema is not None:
        df = _typed(df, _wanted(schema), path)
    return parse_date_columns(df, parse_dates)


def parse_date_columns(df: DataFrame, parse_dates: Sequence[str] = ("date",)) -> DataFrame:
    """``parse_dates``: listed columns become timestamps; a missing one is an error."""
    for c in parse_dates or ():
        if c not in df.columns:
            raise ValueError(f"Missing column provided to 'parse_dates': '{c}'")
        if isinstance(df.schema[c].dataType, T.StringType):
            df = df.withColumn(c, F.to_timestamp_ntz(F.col(f"`{c}`")))
        elif not isinstance(df.schema[c].dataType, T.TimestampNTZType):
            df = df.withColumn(c, F.col(f"`{c}`").cast("timestamp_ntz"))
    return df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 where: str | None = None, parse_dates: Sequence[str] = ()) -> DataFrame:
    """Parquet scan; ``columns`` and ``where`` reach the scan as pruning and pushed filters."""
    with _missing_as_file_not_found(path):
        df = spark.read.parquet(resolve_path(path))
    if where:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return parse_date_columns(df, parse_dates)


def read_glob(spark: SparkSession, pattern: str, schema: T.StructType | str, sep: str | None = None,
              with_ingestion_time: bool = False, na_values: Sequence[str] | None = PANDAS_NA_TOKENS) -> DataFrame:
    """Multi-file load (e.g. ``daily/*.csv``) with a fixed schema, one split per file block.

    ``with_ingestion_time`` adds ``ingestion_timestamp`` from the file's
    modification time, the load-time pseudo column.
    """
    cells = _cells(spark, pattern, sep or delimiter_for(pattern), False)
    wanted = _wanted(schema)
    clean = cells.select([na_to_null(F.col(f"`{c}`"), tuple(na_values or ())).alias(c) for c in cells.columns]
                         + ([F.col("_metadata.file_modification_time").alias("__loaded")] if with_ingestion_time else []))
    df = _typed(clean, T.StructType([*wanted, T.StructField("__loaded", T.TimestampType())]) if with_ingestion_time else wanted, pattern)
    return df.withColumnRenamed("__loaded", "ingestion_timestamp") if with_ingestion_time else df


def load_internal_typed(spark: SparkSession, path: str) -> DataFrame:
    """Internal ledger file: ``amount`` as double, ``date`` parsed."""
    return _with_doubles(read_delimited(spark, path), ("amount",), path)


def load_external_typed(spark: SparkSession, path: str) -> DataFrame:
    """External ledger file: gross, fee and net amounts as double, ``date`` parsed."""
    return _with_doubles(read_delimited(spark, path), ("gross_amount", "fee", "net_amount"), path)


def _with_doubles(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    return df.withColumns({c: _strict(F.col(c), df.schema[c].dataType, T.DoubleType(), c, path) for c in columns})
