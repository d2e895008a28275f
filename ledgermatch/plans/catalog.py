"""Registered queries: each builds a DataFrame from the benchmark tables.

``QUERIES[name](spark, sf_dir)`` returns the lazy result; ``ORACLE[name]`` is
the same question in DuckDB SQL over the raw parquet views (omitted where the
result depends on run time, e.g. stream emission, and checked in tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermatch.functions import StatusLabels
from ledgermatch.operators import mart, quality, staging, summary
from ledgermatch.operators.reconcile import MatchSpec, reconcile
from ledgermatch.plans import incremental, jobs, sql_models
from ledgermatch.plans import oracle_views as V
from ledgermatch.session import scratch_path
from ledgermatch.sinks import publish, writers
from ledgermatch.sources import files, fixtures
from ledgermatch.sources.dispatch import read_source
from ledgermatch.spec import JobSpec, OutputSpec, SourceSpec, WindowSpec
from ledgermatch.streaming import late, replay, runner
from ledgermatch.streaming.reconcile import overall_metrics, reconcile_stream, window_metrics
from ledgermatch.streaming.windows import window_counts

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (staging.stage_internal(fixtures.raw_internal(spark, sf_dir)),
            staging.stage_external(fixtures.raw_external(spark, sf_dir)))


_MART_OUT = [c for c in mart.MART_COLUMNS if c != "reconciliation_timestamp"]


# ---------------------------------------------------------------- the mart (R2)

@register("fct_reconciled", V.with_ctes(V.MART, "SELECT * FROM fct"))
def q_fct_reconciled(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.fct_reconciled(i, e, tolerance=0.05).select(*_MART_OUT)


@register("fct_reconciled_trusted_ids", V.with_ctes(V.MART_TRUSTED, "SELECT * FROM fct"))
def q_fct_reconciled_trusted(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.fct_reconciled(i, e, tolerance=0.05, id_check="trusted").select(*_MART_OUT)


@register("staging_internal", V.with_ctes(V.STAGED, "SELECT * FROM stg_internal"))
def q_staging_internal(spark, sf_dir):
    i, _ = staged(spark, sf_dir)
    return i.drop("ingestion_timestamp")


@register("staging_external", V.with_ctes(V.STAGED, "SELECT * FROM stg_external"))
def q_staging_external(spark, sf_dir):
    _, e = staged(spark, sf_dir)
    return e.drop("ingestion_timestamp")


@register("inner_join_date_key", V.with_ctes(V.MART, "SELECT * FROM matched"))
def q_inner_join_date_key(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.matched_pairs(i, e, tolerance=0.05).drop("reconciliation_timestamp")


@register("unmatched_internal_anti", V.with_ctes(V.MART, "SELECT * FROM unmatched_int"))
def q_unmatched_internal_anti(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.unmatched_internal(i, e).drop("reconciliation_timestamp")


@register("unmatched_external_anti", V.with_ctes(V.MART, "SELECT * FROM unmatched_ext"))
def q_unmatched_external_anti(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.unmatched_external(i, e).drop("reconciliation_timestamp")


# ------------------------------------------------------- path A: the matcher


_LI = ["internal_tx_id", "date", "customer_id", "location_id", "amount"]
_LE = ["external_tx_id", "date", "customer_id", "location_id", "net_amount"]
_RI = ["transaction_id", "date", "customer_id", "location_id", "amount", "fee"]
_RE = ["transaction_id", "date", "customer_id", "location_id", "amount"]
_DCL = ["date", "customer_id", "location_id"]
_CL = ["customer_id", "location_id"]
_TOL = "abs(l.amount - r.net_amount) <= 5e-2"
_DAYS1 = "abs(date_diff('day', strptime(r.date, '%Y-%m-%d'), strptime(l.date, '%Y-%m-%d'))) <= 1"


def ledgers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixtures.ledger_internal(spark, sf_dir), fixtures.ledger_external(spark, sf_dir)


def _path_a(ctes_body: str) -> str:
    return V.with_ctes(V.PATH_A, ctes_body)


@register("recon_exact", _path_a(V.outer_match_sql("ledger_internal", "ledger_external", ["date", "customer_id"], _LI, _LE)))
def q_recon_exact(spark, sf_dir):
    """No tolerance: exact keys; the location is on both sides and gets suffixes."""
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=("date", "customer_id"))).classified


@register("outer_join_indicator", _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE)))
def q_outer_join_indicator(spark, sf_dir):
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_DCL))).classified


@register("outer_join_suffixes", V.with_ctes(V.LEDGERS, V.outer_match_sql("raw_internal", "raw_external", _DCL, _RI, _RE)))
def q_outer_join_suffixes(spark, sf_dir):
    """Colliding names: 'amount' is suffixed, so the amount tolerance is skipped."""
    i, e = fixtures.raw_internal(spark, sf_dir), fixtures.raw_external(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_DCL), amount_tolerance=0.05)).classified


@register("recon_filter_mode",
          _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE, where=_TOL)))
def q_recon_filter_mode(spark, sf_dir):
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_DCL), amount_tolerance=0.05)).classified


@register("recon_classify_mode",
          _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE, on_extra=_TOL)))
def q_recon_classify_mode(spark, sf_dir):
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_DCL), amount_tolerance=0.05, mode="classify")).classified


def _classified_split(which: str):
    def fn(spark, sf_dir):
        i, e = ledgers(spark, sf_dir)
        res = reconcile(i, e, MatchSpec(match_on=tuple(_DCL), amount_tolerance=0.05, mode="classify"))
        return getattr(res, which)
    return fn


for _name, _merge in (("matched", "both"), ("unmatched_internal", "left_only"), ("unmatched_external", "right_only")):
    register(_name, _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE,
                                              on_extra=_TOL, merge=_merge)))(_classified_split(_name))


@register("amount_tolerance",
          _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _CL, _LI, _LE, where=_TOL)))
def q_amount_tolerance(spark, sf_dir):
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_CL), amount_tolerance=0.05)).classified


@register("date_tolerance",
          _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _CL, _LI, _LE, where=_DAYS1)))
def q_date_tolerance(spark, sf_dir):
    """Date outside match_on: date_internal / date_external within one (floored) day."""
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_CL), date_tolerance_days=1)).classified


@register("amount_and_date_tolerance",
          _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _CL, _LI, _LE, on_extra=f"{_TOL} AND {_DAYS1}")))
def q_amount_and_date_tolerance(spark, sf_dir):
    """Both tolerances in one match: a grid of amount and day cells in the key, the rest unmatched."""
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_CL), amount_tolerance=0.05, date_tolerance_days=1, mode="classify")).classified


_POSTED = ["lp AS (SELECT *, CAST(CAST(date AS DATE) + 1 AS VARCHAR) AS posted_date FROM ledger_internal)",
           "ep AS (SELECT external_tx_id, CAST(CAST(date AS DATE) + 2 AS VARCHAR) AS posted_date, date, customer_id, location_id, net_amount FROM ledger_external)"]


@register("date_columns_first_pair", V.with_ctes(V.PATH_A + _POSTED, V.outer_match_sql(
    "lp", "ep", _CL, [*_LI, "posted_date"], ["external_tx_id", "posted_date", *_LE[1:]], where=_DAYS1.replace("r.date", "r.posted_date"))))
def q_date_columns_first_pair(spark, sf_dir):
    """Of several columns named after dates the first of each side decides: ``date`` of one, ``posted_date`` of the other."""
    i, e = ledgers(spark, sf_dir)
    i = i.withColumn("posted_date", F.date_add(F.col("date").cast("date"), 1).cast("string"))
    e = e.select("external_tx_id", F.date_add(F.col("date").cast("date"), 2).cast("string").alias("posted_date"), "date", "customer_id", "location_id", "net_amount")
    return reconcile(i, e, MatchSpec(match_on=tuple(_CL), date_tolerance_days=1)).classified


@register("many_to_many_match",
          _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _CL, _LI, _LE, merge="both")))
def q_many_to_many_match(spark, sf_dir):
    """Duplicate keys pair every internal with every external row of the key."""
    i, e = ledgers(spark, sf_dir)
    return reconcile(i, e, MatchSpec(match_on=tuple(_CL))).matched


@register("amount_difference", V.with_ctes(V.MART, "SELECT internal_transaction_id, external_transaction_id, "
                                                   "amount_difference FROM matched"))
def q_amount_difference(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.matched_pairs(i, e).select("internal_transaction_id", "external_transaction_id", "amount_difference")


@register("match_status", V.with_ctes(V.MART, "SELECT internal_transaction_id, external_transaction_id, "
                                              "match_status FROM matched"))
def q_match_status(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    return mart.matched_pairs(i, e).select("internal_transaction_id", "external_transaction_id", "match_status")


# ------------------------------------------------------- summaries, windows, sorts


def fct(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, e = staged(spark, sf_dir)
    return mart.fct_reconciled(i, e, tolerance=0.05)


@register("status_counts", V.with_ctes(V.MART, "SELECT match_status, COUNT(*) AS count FROM fct GROUP BY match_status"))
def q_status_counts(spark, sf_dir):
    return summary.status_counts(fct(spark, sf_dir))


@register("status_summary", V.with_ctes(V.MART, """SELECT match_status, COUNT(*) AS count,
  ROUND(CAST(COUNT(*) AS DOUBLE) * 1e2 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS percentage
FROM fct GROUP BY match_status ORDER BY count DESC"""))
def q_status_summary(spark, sf_dir):
    return summary.status_summary(fct(spark, sf_dir))


@register("match_rate", V.with_ctes(V.MART, """SELECT COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE match_status = 'MATCHED') AS n_matched,
  COUNT(*) FILTER (WHERE match_status = 'AMOUNT_VARIANCE') AS n_amount_variance,
  COUNT(*) FILTER (WHERE match_status = 'UNMATCHED_INTERNAL') AS n_unmatched_internal,
  COUNT(*) FILTER (WHERE match_status = 'UNMATCHED_EXTERNAL') AS n_unmatched_external,
  CAST(COUNT(*) FILTER (WHERE match_status = 'MATCHED') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS match_rate
FROM fct"""))
def q_match_rate(spark, sf_dir):
    return summary.match_rate(fct(spark, sf_dir))


@register("output_counts", _path_a(
    "SELECT COUNT(*) FILTER (WHERE _merge = 'both') AS matched, "
    "COUNT(*) FILTER (WHERE _merge = 'left_only') AS unmatched_internal, "
    "COUNT(*) FILTER (WHERE _merge = 'right_only') AS unmatched_external FROM ("
    + V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE) + ") x"))
def q_output_counts(spark, sf_dir):
    i, e = ledgers(spark, sf_dir)
    return summary.output_counts(reconcile(i, e, MatchSpec(match_on=tuple(_DCL))).classified)


@register("output_counts_observed", _path_a(
    "SELECT COUNT(*) FILTER (WHERE _merge = 'both') AS matched, "
    "COUNT(*) FILTER (WHERE _merge = 'left_only') AS unmatched_internal, "
    "COUNT(*) FILTER (WHERE _merge = 'right_only') AS unmatched_external FROM ("
    + V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE, on_extra=_TOL) + ") x"))
def q_output_counts_observed(spark, sf_dir):
    """Counts that the write of the three outputs leaves behind: the ledgers are read and matched once."""
    i, e = ledgers(spark, sf_dir)
    seen = Observation()
    res = reconcile(i, e, MatchSpec(match_on=tuple(_DCL), amount_tolerance=0.05, mode="classify"))
    writers.write_outputs(res.classified, OutputSpec(scratch_path(spark, "observed"), "matched.csv", "unmatched_internal.csv", "unmatched_external.csv"), seen)
    return writers.observed_counts(spark, seen)


@register("ledger_preview", V.with_ctes(V.LEDGERS, "SELECT * FROM raw_internal ORDER BY transaction_id NULLS FIRST, date, customer_id LIMIT 5"))
def q_ledger_preview(spark, sf_dir):
    return summary.preview(fixtures.raw_internal(spark, sf_dir), ["transaction_id", "date", "customer_id"], 5)


# ------------------------------------------------------- data-quality tests (Q1-Q4)

_RAW_COLS_I = ["transaction_id", "date", "customer_id", "location_id", "amount", "fee"]
_RAW_COLS_E = ["transaction_id", "date", "customer_id", "location_id", "amount"]
_MART_NOT_NULL = ["transaction_date", "customer_id", "location_id", "match_status"]


def _dq_unique_sql(table: str, column: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'unique' AS test, COUNT(*) AS failures "
            f"FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1) d")


def _dq_not_null_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS test, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {table}" for c in columns)


@register("dq_unique", V.with_ctes(V.LEDGERS, _dq_unique_sql("raw_internal", "transaction_id") + " UNION ALL "
                                   + _dq_unique_sql("raw_external", "transaction_id") + " UNION ALL "
                                   + _dq_unique_sql("raw_internal", "customer_id")))
def q_dq_unique(spark, sf_dir):
    """The two declared id tests, plus customer_id, which does repeat."""
    ri, re_ = fixtures.raw_internal(spark, sf_dir), fixtures.raw_external(spark, sf_dir)
    return (quality.unique(ri, "transaction_id", "raw_internal")
            .unionByName(quality.unique(re_, "transaction_id", "raw_external"))
            .unionByName(quality.unique(ri, "customer_id", "raw_internal")))


@register("dq_not_null", V.with_ctes(V.MART, _dq_not_null_sql("raw_internal", _RAW_COLS_I) + " UNION ALL "
                                     + _dq_not_null_sql("raw_external", _RAW_COLS_E) + " UNION ALL "
                                     + _dq_not_null_sql("fct", _MART_NOT_NULL)))
def q_dq_not_null(spark, sf_dir):
    ri, re_ = fixtures.raw_internal(spark, sf_dir), fixtures.raw_external(spark, sf_dir)
    return (quality.not_null(ri, _RAW_COLS_I, "raw_internal")
            .unionByName(quality.not_null(re_, _RAW_COLS_E, "raw_external"))
            .unionByName(quality.not_null(fct(spark, sf_dir), _MART_NOT_NULL, "fct")))


@register("dq_accepted_values", V.with_ctes(V.MART, """SELECT 'fct' AS table_name, 'match_status' AS column_name,
  'accepted_values' AS test, COUNT(*) FILTER (WHERE match_status IS NOT NULL AND match_status NOT IN
  ('MATCHED', 'AMOUNT_VARIANCE', 'UNMATCHED_INTERNAL', 'UNMATCHED_EXTERNAL')) AS failures FROM fct
UNION ALL SELECT 'fct_renamed', 'match_status', 'accepted_values',
  COUNT(*) FILTER (WHERE match_status = 'UNMATCHED_EXTERNAL') FROM fct"""))
def q_dq_accepted_values(spark, sf_dir):
    """The declared list on the mart as it was published, and the same test where one of its labels is not in the list."""
    path = scratch_path(spark, "fct_labels")
    publish.publish(fct(spark, sf_dir).select("match_status"), path)
    table = publish.read_published(spark, path)
    status = F.col("match_status")
    renamed = table.withColumn("match_status", F.when(status == StatusLabels().unmatched_external, "NOT_IN_OURS").otherwise(status))
    return (quality.accepted_values(table, "match_status", StatusLabels().all(), "fct")
            .unionByName(quality.accepted_values(renamed, "match_status", StatusLabels().all(), "fct_renamed")))


@register("dq_conservation", _path_a("""SELECT n_internal, n_matched_rows, n_matched_internal_ids, n_unmatched_internal,
  n_matched_rows + n_unmatched_internal = n_internal AS rows_conserved,
  n_matched_internal_ids + n_unmatched_internal = n_internal AS ids_conserved
FROM (SELECT (SELECT COUNT(*) FROM ledger_internal) AS n_internal,
             COUNT(*) FILTER (WHERE _merge = 'both') AS n_matched_rows,
             COUNT(DISTINCT CASE WHEN _merge = 'both' THEN internal_tx_id END) AS n_matched_internal_ids,
             COUNT(*) FILTER (WHERE _merge = 'left_only') AS n_unmatched_internal
      FROM (""" + V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE) + ") x) y"))
def q_dq_conservation(spark, sf_dir):
    i, e = ledgers(spark, sf_dir)
    return quality.conservation(i, reconcile(i, e, MatchSpec(match_on=tuple(_DCL))).classified, "internal_tx_id")


# ------------------------------------------------------- sources, sinks and jobs
# Each query first writes a fixture view to a fresh folder under spark.checkpoint.dir,
# then answers from what it reads back, so the scan / sink is on the measured path.


def _to_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


def _raw_parsed(name: str) -> str:
    cols = {"raw_internal": "transaction_id, strptime(date, '%Y-%m-%d') AS date, customer_id, location_id, amount, fee",
            "raw_external": "transaction_id, strptime(date, '%Y-%m-%d') AS date, customer_id, location_id, amount"}
    return f"SELECT {cols[name]} FROM {name}"


_LEDGERS_PARSED = [
    "li AS (SELECT internal_tx_id, strptime(date, '%Y-%m-%d') AS date, customer_id, location_id, amount "
    "FROM ledger_internal)",
    "le AS (SELECT external_tx_id, strptime(date, '%Y-%m-%d') AS date, customer_id, location_id, net_amount "
    "FROM ledger_external)",
]


@register("scan_csv", V.with_ctes(V.LEDGERS, "SELECT * FROM raw_internal"))
def q_scan_csv(spark, sf_dir):
    path = _to_csv(fixtures.raw_internal(spark, sf_dir), scratch_path(spark, "raw_internal") + ".csv")
    return files.read_delimited(spark, path, schema=files.RAW_INTERNAL_SCHEMA, parse_dates=())


@register("scan_path_rules", V.with_ctes(V.LEDGERS, "SELECT rule, COUNT(*) FILTER (WHERE rule <> 'missing') AS n_rows, "
          "COUNT(amount) FILTER (WHERE rule <> 'missing') AS n_amounts FROM raw_internal, (VALUES ('plain'), ('scheme'), ('glob'), ('missing')) r(rule) GROUP BY rule"))
def q_scan_path_rules(spark, sf_dir):
    """One file set by its path, by a path with a scheme and by a glob; a path that is not there is an error."""
    path = _to_csv(fixtures.raw_internal(spark, sf_dir), scratch_path(spark, "paths") + ".csv")
    whole = path if "://" in path or path.startswith("file:") else f"file://{path}"
    read = lambda p: files.read_delimited(spark, p, schema=files.RAW_INTERNAL_SCHEMA, parse_dates=())
    counts = lambda df, rule: df.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("n_rows"), F.count("amount").alias("n_amounts"))
    out = counts(read(path), "plain").unionByName(counts(read(whole), "scheme")).unionByName(counts(read(f"{path}/*.csv"), "glob"))
    try:
        read(f"{path}-missing").count()
    except FileNotFoundError:
        return out.unionByName(counts(read(path).limit(0), "missing"))
    raise AssertionError("a missing path was read")


@register("scan_psv", V.with_ctes(V.LEDGERS, _raw_parsed("raw_external")))
def q_scan_psv(spark, sf_dir):
    path = _to_csv(fixtures.raw_external(spark, sf_dir), scratch_path(spark, "raw_external") + ".psv", sep="|")
    return files.read_delimited(spark, path, schema=files.RAW_EXTERNAL_SCHEMA)


@register("scan_parse_date", V.with_ctes(V.LEDGERS, "SELECT transaction_id, strptime(date, '%Y-%m-%d') AS date, "
                                                    "customer_id, location_id FROM raw_internal"))
def q_scan_parse_date(spark, sf_dir):
    """No schema: text columns, NA tokens to null, then 'date' parsed to a timestamp."""
    path = _to_csv(fixtures.raw_internal(spark, sf_dir), scratch_path(spark, "raw_internal_text") + ".csv")
    return files.read_delimited(spark, path).select("transaction_id", "date", "customer_id", "location_id")


@register("scan_typed_ledgers", V.with_ctes(
    [V.DOC_EXTERNAL], "SELECT external_tx_id, gross_amount, fee, net_amount, strptime(date, '%Y-%m-%d') AS date, "
                      "description, customer_id, location_id FROM doc_external"))
def q_scan_typed_ledgers(spark, sf_dir):
    path = _to_csv(fixtures.documented_external(spark, sf_dir), scratch_path(spark, "external_documented") + ".csv")
    return files.load_external_typed(spark, path)


@register("scan_typed_internal", V.with_ctes(V.LEDGERS + [V.DOC_INTERNAL], "SELECT internal_tx_id, amount, strptime(date, '%Y-%m-%d') "
                                             "AS date, customer_id, location_id FROM doc_internal"))
def q_scan_typed_internal(spark, sf_dir):
    path = _to_csv(fixtures.documented_internal(spark, sf_dir), scratch_path(spark, "internal_documented") + ".csv")
    return files.load_internal_typed(spark, path)


@register("scan_csv_quoted", V.with_ctes(V.LEDGERS, "SELECT transaction_id, 'paid \"' || customer_id || '\", on' || chr(10) || date AS note "
                                                    "FROM raw_internal"))
def q_scan_csv_quoted(spark, sf_dir):
    """Quotes, separators and line breaks inside cells."""
    raw = fixtures.raw_internal(spark, sf_dir)
    note = F.concat(F.lit('paid "'), "customer_id", F.lit('", on\n'), "date")
    path = _to_csv(raw.select("transaction_id", note.alias("note")), scratch_path(spark, "quoted") + ".csv")
    return files.read_delimited(spark, path, schema="transaction_id string, note string", parse_dates=(), multiline=True)


@register("scan_csv_reordered_header", V.with_ctes(V.LEDGERS, "SELECT * FROM raw_internal"))
def q_scan_csv_reordered_header(spark, sf_dir):
    """Columns are bound by name, whatever their order in the file."""
    raw = fixtures.raw_internal(spark, sf_dir).select("fee", "location_id", "amount", "transaction_id", "customer_id", "date")
    path = _to_csv(raw, scratch_path(spark, "reordered") + ".csv")
    return files.read_delimited(spark, path, schema=files.RAW_INTERNAL_SCHEMA, parse_dates=())


@register("scan_csv_na_typed", V.with_ctes(V.LEDGERS, "SELECT transaction_id, CASE WHEN amount > 1e5 THEN NULL ELSE amount END AS amount "
                                                      "FROM raw_internal"))
def q_scan_csv_na_typed(spark, sf_dir):
    """NA tokens in a typed column are nulls."""
    raw = fixtures.raw_internal(spark, sf_dir)
    amount = F.when(F.col("amount") > F.lit(1e5), F.lit("NA")).otherwise(F.col("amount").cast("string"))
    path = _to_csv(raw.select("transaction_id", amount.alias("amount")), scratch_path(spark, "na") + ".csv")
    return files.read_delimited(spark, path, schema="transaction_id string, amount double", parse_dates=())


@register("scan_infer_lattice", V.with_ctes(V.LEDGERS, "SELECT printf('%09d', CAST(substr(transaction_id, 3) AS INT)) AS transaction_id, "
          "CAST(substr(customer_id, 3) AS VARCHAR) AS customer_id, CAST(substr(location_id, 4) AS INT) % 7 AS location_no, "
          "CAST(date AS DATE) AS date, amount, fee > 2e0 AS large_fee, substr(customer_id, 4) AS customer_key FROM raw_internal"))
def q_scan_infer_lattice(spark, sf_dir):
    """Types worked out over all rows: numbers, dates and booleans are typed, zero-led ids and the declared key stay text."""
    raw = fixtures.raw_internal(spark, sf_dir).select(
        F.substring("transaction_id", 3, 20).alias("transaction_id"), F.substring("customer_id", 3, 20).alias("customer_id"),
        (F.substring("location_id", 4, 20).cast("int") % 7).alias("location_no"), "date", "amount", (F.col("fee") > F.lit(2e0)).alias("large_fee"),
        F.substring("customer_id", 4, 20).alias("customer_key"))
    path = _to_csv(raw, scratch_path(spark, "untyped") + ".csv")
    return files.read_delimited(spark, path, infer_schema="lattice", keys=("customer_key",), parse_dates=())


@register("load_glob_fixed_schema", V.with_ctes(V.LEDGERS, "SELECT * FROM raw_internal"))
def q_load_glob_fixed_schema(spark, sf_dir):
    folder = scratch_path(spark, "internal_daily")
    _to_csv(fixtures.raw_internal(spark, sf_dir), folder)
    return files.read_glob(spark, f"{folder}/*.csv", files.RAW_INTERNAL_SCHEMA)


@register("scan_pushdown_filter", V.with_ctes(V.LEDGERS, "SELECT date, customer_id, location_id, amount "
                                                         "FROM raw_internal WHERE date >= '1998-06-30'"))
def q_scan_pushdown_filter(spark, sf_dir):
    """Projection and predicate of a source query reach the parquet scan."""
    path = scratch_path(spark, "raw_internal_parquet")
    writers.overwrite_table(fixtures.raw_internal(spark, sf_dir), path)
    src = SourceSpec("parquet", path=path, options={"columns": ["date", "customer_id", "location_id", "amount"],
                                                    "where": "date >= '1998-06-30'", "parse_dates": []})
    return read_source(spark, src)


@register("recon_mixed_sources", V.with_ctes(V.PATH_A + _LEDGERS_PARSED, V.outer_match_sql("li", "le", _DCL, _LI, _LE)))
def q_recon_mixed_sources(spark, sf_dir):
    """Internal side from parquet, external side from a pipe-separated file."""
    i_path = scratch_path(spark, "ledger_internal_parquet")
    writers.overwrite_table(fixtures.ledger_internal(spark, sf_dir), i_path)
    e_path = _to_csv(fixtures.ledger_external(spark, sf_dir), scratch_path(spark, "ledger_external") + ".psv", "|")
    internal = read_source(spark, SourceSpec("parquet", path=i_path))
    external = read_source(spark, SourceSpec("file", path=e_path)).withColumn(
        "net_amount", F.col("net_amount").cast("double"))
    return reconcile(internal, external, MatchSpec(match_on=tuple(_DCL))).classified


@register("sink_csv_roundtrip", _path_a(V.outer_match_sql("ledger_internal", "ledger_external", _DCL, _LI, _LE,
                                                          on_extra=_TOL)))
def q_sink_csv_roundtrip(spark, sf_dir):
    """Three CSV outputs written in one pass, read back as one frame."""
    i, e = ledgers(spark, sf_dir)
    res = reconcile(i, e, MatchSpec(match_on=tuple(_DCL), amount_tolerance=0.05, mode="classify"))
    out = OutputSpec(scratch_path(spark, "outputs"), "matched.csv", "unmatched_internal.csv",
                     "unmatched_external.csv")
    written = writers.write_outputs(res.classified, out)
    return writers.read_outputs(spark, written, res.classified.schema)


@register("sink_truncate_load", V.with_ctes(V.LEDGERS, "SELECT * FROM raw_internal"))
def q_sink_truncate_load(spark, sf_dir):
    """Loading twice into the same target leaves one copy (WRITE_TRUNCATE)."""
    path = scratch_path(spark, "raw_internal_table")
    raw = fixtures.raw_internal(spark, sf_dir)
    writers.overwrite_table(raw, path)
    writers.overwrite_table(raw, path)
    return spark.read.parquet(path)


_RUN_TS = "2024-06-30 05:00:00"


@register("run_timestamp", V.with_ctes(V.MART, f"SELECT TIMESTAMP '{_RUN_TS}' AS reconciliation_timestamp, COUNT(*) AS n_rows FROM fct"))
def q_run_timestamp(spark, sf_dir):
    """All rows of a run carry its timestamp."""
    i, e = staged(spark, sf_dir)
    stamp = F.col("reconciliation_timestamp").cast("timestamp_ntz").alias("reconciliation_timestamp")
    return mart.fct_reconciled(i, e, run_ts=_RUN_TS).groupBy(stamp).agg(F.count(F.lit(1)).alias("n_rows"))


@register("sink_database_table", V.with_ctes(V.MART, "SELECT * FROM fct"))
def q_sink_database_table(spark, sf_dir):
    """The mart as a table of a database that is created if missing: loaded, loaded again, and kept when a load fails."""
    folder = scratch_path(spark, "warehouse")
    database = folder.rsplit("/", 1)[-1].replace("-", "_")
    for _ in range(2):
        writers.ensure_database(spark, database, folder)
    table, mart_rows = f"{database}.fct_reconciled", fct(spark, sf_dir).select(*_MART_OUT)
    # worked out once: all three loads read what was landed
    landed = scratch_path(spark, "fct_landed")
    mart_rows.write.parquet(landed)
    rows = spark.read.schema(mart_rows.schema).parquet(landed)
    for load in (rows.limit(5), rows):
        writers.save_table(load, table, path=f"{folder}/fct_reconciled")
    broken = rows.withColumn("match_status", F.when(F.col("match_status") == "MATCHED", F.raise_error(F.lit("bad row"))).otherwise(F.col("match_status")))
    try:
        writers.save_table(broken, table, path=f"{folder}/fct_reconciled")
    except Exception as exc:  # the load's own fault, and no other
        if "bad row" not in str(exc):
            raise
    return spark.table(table)


@register("sink_atomic_replace", V.with_ctes(V.LEDGERS, "SELECT * FROM raw_internal"))
def q_sink_atomic_replace(spark, sf_dir):
    """A published table after a good load and one that fails half-way: the good one is read."""
    path, raw = scratch_path(spark, "published"), fixtures.raw_internal(spark, sf_dir)
    publish.publish(raw.limit(10), path)
    publish.publish(raw, path)
    broken = raw.withColumn("fee", F.when(F.col("fee") > F.lit(3e0), F.raise_error(F.lit("bad row")).cast("double")).otherwise(F.col("fee")))
    try:
        publish.publish(broken, path)
    except Exception as exc:  # the load's own fault, and no other
        if "bad row" not in str(exc):
            raise
    return publish.read_published(spark, path)


_BUCKETS = 8


@register("sink_bucketed_table", V.with_ctes(V.MART, "SELECT internal_transaction_id, external_transaction_id, amount_difference FROM matched"))
def q_sink_bucketed_table(spark, sf_dir):
    """Both staged ledgers as catalog tables in buckets of the match key; their join has no shuffle."""
    keys, tables = ["customer_id", "location_id", "day"], []
    for side, df in zip(("internal", "external"), staged(spark, sf_dir)):
        path = scratch_path(spark, f"bucketed_{side}")
        dated = df.drop("ingestion_timestamp").withColumn("day", F.to_date("transaction_date"))
        tables.append(writers.save_bucketed(dated, path.rsplit("/", 1)[-1].replace("-", "_"), keys, _BUCKETS, path))
    i, e = (t.alias(a) for t, a in zip(tables, "ie"))
    pairs = i.hint("merge").join(e, [F.col(f"i.{k}") == F.col(f"e.{k}") for k in keys])
    return pairs.select(F.col("i.transaction_id").alias("internal_transaction_id"), F.col("e.transaction_id").alias("external_transaction_id"),
                        F.abs(F.col("i.net_amount") - F.col("e.net_amount")).alias("amount_difference"))


@register("load_partition_rerun", V.with_ctes(V.LEDGERS, "SELECT *, CASE WHEN date < '1998-01-01' THEN '2024-01-01' ELSE '2024-01-02' END AS load_date "
                                              "FROM raw_internal WHERE date < '1998-01-01' OR fee < 2e0"))
def q_load_partition_rerun(spark, sf_dir):
    """Three days' loads, the second run again with fewer rows: its day is replaced, the others stay; two days are read."""
    path, raw = scratch_path(spark, "loads"), fixtures.raw_internal(spark, sf_dir)
    early = F.col("date") < "1998-01-01"
    writers.write_load(raw.where(early), path, "2024-01-01")
    writers.write_load(raw.where(~early), path, "2024-01-02")
    writers.write_load(raw, path, "2024-01-03")
    writers.write_load(raw.where(~early & (F.col("fee") < F.lit(2e0))), path, "2024-01-02")
    loads = spark.read.schema(raw.schema.add("load_date", "string")).parquet(path)
    # the days to read come from a table: partitions of other days are pruned as the query runs
    calendar = spark.createDataFrame([("2024-01-01", "closed"), ("2024-01-02", "closed"), ("2024-01-03", "open")], "load_date string, state string")
    return loads.join(F.broadcast(calendar.where("state = 'closed'")), "load_date", "left_semi")


@register("batch_incremental", V.with_ctes(V.MART_TRUSTED, "SELECT * FROM fct"))
def q_batch_incremental(spark, sf_dir):
    """Five loads, rows that come a load late, and one load run twice: the same as one rebuild of everything."""
    i, e = (df.drop("ingestion_timestamp") for df in staged(spark, sf_dir))
    load = F.greatest(F.floor((F.year("transaction_date") - 1995) / 2), F.lit(0))
    late_row = F.coalesce(F.substring("transaction_id", -1, 1) == "3", F.lit(False)).cast("long")
    path = scratch_path(spark, "incremental")
    for k in (0, 1, 2, 2, 3, 4):
        done = incremental.run_load(spark, path, f"2024-01-0{k + 1}", i.where(load == k), e.where(load + late_row == k), run_ts=_RUN_TS, grain="year")
    return done.fact.select(*_MART_OUT)


@register("sink_partitioned_table", V.with_ctes(V.MART, "SELECT *, '2024-06-30' AS reconciliation_date FROM fct"))
def q_sink_partitioned_table(spark, sf_dir):
    i, e = staged(spark, sf_dir)
    path = writers.write_partitioned(mart.fct_reconciled(i, e, run_ts=_RUN_TS), scratch_path(spark, "fct_partitioned"))
    return (spark.read.parquet(path).where(F.col("reconciliation_date") == F.lit("2024-06-30").cast("date"))
            .drop("reconciliation_timestamp")
            .withColumn("reconciliation_date", F.col("reconciliation_date").cast("string")))


@register("job_end_to_end", V.with_ctes(V.PATH_A + _LEDGERS_PARSED, V.outer_match_sql(
    "li", "le", _DCL, _LI, _LE, where=_TOL)))
def q_job_end_to_end(spark, sf_dir):
    """Config-driven job: CSV + PSV files in, three CSV outputs, read back."""
    i_path = _to_csv(fixtures.ledger_internal(spark, sf_dir), scratch_path(spark, "job_internal") + ".csv")
    e_path = _to_csv(fixtures.ledger_external(spark, sf_dir), scratch_path(spark, "job_external") + ".psv", "|")
    config = {
        "sources": {
            "internal": {"type": "file", "path": i_path,
                         "schema": "internal_tx_id string, date string, customer_id string, location_id string, "
                                   "amount double"},
            "external": {"type": "file", "path": e_path,
                         "schema": "external_tx_id string, date string, customer_id string, location_id string, "
                                   "net_amount double"}},
        "matching": {"match_on": _DCL, "internal_key": "amount", "external_key": "net_amount"},
        "tolerances": {"amount": 0.05, "days": 0},
        "output": {"path": scratch_path(spark, "job_out"), "reconciled_file": "matched.csv",
                   "unmatched_internal_file": "unmatched_internal.csv",
                   "unmatched_external_file": "unmatched_external.csv"},
    }
    result, written = jobs.run_job(spark, JobSpec.from_dict(config))
    return writers.read_outputs(spark, written, result.classified.schema)


@register("batch_pipeline", V.with_ctes(V.MART, "SELECT *, '2024-06-30' AS reconciliation_date FROM fct"))
def q_batch_pipeline(spark, sf_dir):
    """Nightly batch over daily CSV drops; returns the published partition."""
    i_dir = scratch_path(spark, "internal_daily")
    e_dir = scratch_path(spark, "external_daily")
    _to_csv(fixtures.raw_internal(spark, sf_dir), i_dir)
    _to_csv(fixtures.raw_external(spark, sf_dir), e_dir)
    res = jobs.batch_pipeline(spark, f"{i_dir}/*.csv", f"{e_dir}/*.csv", scratch_path(spark, "marts"), run_ts=_RUN_TS)
    return (spark.read.parquet(res.fact_path).where(F.col("reconciliation_date") == F.lit("2024-06-30").cast("date"))
            .drop("reconciliation_timestamp")
            .withColumn("reconciliation_date", F.col("reconciliation_date").cast("string")))


# ------------------------------------------------------- streaming
# The events table is replayed as a file stream (available-now trigger) into
# parquet under spark.checkpoint.dir; the query answers from the sink.


_HOUR = WindowSpec("tumbling", "1 hour", grace="10 minutes")
_SLIDE = WindowSpec("sliding", "1 hour", "15 minutes", "10 minutes")
_STREAM_KEYS = ["user_id", "event_id"]


def _event_streams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The table as a stream for each side; one of more rows than a trigger should hold comes in the order of its times."""
    events = fixtures.table(spark, sf_dir, "events")
    files = replay.file_count(events.count())
    folder, glob, bound = sf_dir, "events.parquet", None
    if files > 1:
        events = events.select("event_id", "user_id", "ts", "value")
        folder, glob = scratch_path(spark, "events-by-time"), None
        bound = replay.land(events, folder, "ts", files)
    ev_i, ev_e = [runner.file_stream(spark, folder, events.schema, glob, bound) for _ in late.SIDES]
    return fixtures.stream_internal_shape(ev_i), fixtures.stream_external_shape(ev_e)


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"stream-{name}")
    runner.run_to_parquet(stream, f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def _window_counts_sql(slide: int | None) -> str:
    return V.with_ctes(V.STREAMS + [V.stream_watermark(["s_int"]), V.windowed("s_int", "w", 60, slide)],
                       "SELECT window_start, window_end, COUNT(*) AS n_records, MIN(amount) AS min_amount, "
                       "MAX(amount) AS max_amount FROM w GROUP BY window_start, window_end "
                       "HAVING window_end <= (SELECT wm FROM wm)")


@register("stream_tumbling_counts", _window_counts_sql(None))
def q_stream_tumbling_counts(spark, sf_dir):
    internal, _ = _event_streams(spark, sf_dir)
    return _run(spark, window_counts(internal, "ts", _HOUR, "amount"), "tumbling")


@register("stream_sliding_counts", _window_counts_sql(15))
def q_stream_sliding_counts(spark, sf_dir):
    internal, _ = _event_streams(spark, sf_dir)
    return _run(spark, window_counts(internal, "ts", _SLIDE, "amount"), "sliding")


def _stream_join_sql(how: str, select_metrics: bool = False, internal: str = "s_int", external: str = "s_ext",
                     more: list[str] = [], keys: tuple[str, ...] = ()) -> str:
    body = """SELECT COALESCE(i.window_start, e.window_start) AS window_start,
         COALESCE(i.window_end, e.window_end) AS window_end,
         CASE WHEN i.__l IS NOT NULL THEN i.user_id ELSE e.user_id END AS user_id,
         CASE WHEN i.__l IS NOT NULL THEN i.event_id ELSE e.event_id END AS event_id, {KEYS}
         i.ts AS ts_internal, i.amount, e.ts AS ts_external, e.net_amount,
         CASE WHEN i.__l IS NOT NULL AND e.__r IS NOT NULL THEN 'both'
              WHEN i.__l IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
  FROM (SELECT *, 1 AS __l FROM wi) i {JOIN} (SELECT *, 1 AS __r FROM we) e
    ON i.user_id = e.user_id AND i.event_id = e.event_id AND i.window_start = e.window_start
   AND abs(i.amount - e.net_amount) <= 5e-2""".replace("{JOIN}", "JOIN" if how == "inner" else "FULL OUTER JOIN")
    body = body.replace("{KEYS}", "".join(f"CASE WHEN i.__l IS NOT NULL THEN i.{k} ELSE e.{k} END AS {k}, " for k in keys))
    body += "".join(f" AND i.{k} = e.{k}" for k in keys)
    if how != "inner":
        body = (f"SELECT * FROM ({body}) j WHERE _merge = 'both' OR window_end IS NULL OR window_end <= (SELECT wm FROM wm)")
    if select_metrics:
        body = (f"SELECT window_start, window_end, COUNT(*) AS n_records, "
                f"COUNT(*) FILTER (WHERE _merge = 'both') AS n_matched, "
                f"COUNT(*) FILTER (WHERE _merge = 'left_only') AS n_unmatched_internal, "
                f"COUNT(*) FILTER (WHERE _merge = 'right_only') AS n_unmatched_external, "
                f"CAST(COUNT(*) FILTER (WHERE _merge = 'both') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS match_rate, "
                f"window_end <= (SELECT wm FROM wm) AS complete "
                f"FROM ({body}) x GROUP BY window_start, window_end")
    return V.with_ctes(V.STREAMS + more + [V.stream_watermark([internal, external]), V.windowed(internal, "wi", 60),
                                           V.windowed(external, "we", 60)], body)


@register("stream_recon_inner", _stream_join_sql("inner"))
def q_stream_recon_inner(spark, sf_dir):
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05, how="inner")
    return _run(spark, s, "recon-inner")


@register("stream_recon_outer", _stream_join_sql("full_outer"))
def q_stream_recon_outer(spark, sf_dir):
    """Matched pairs plus the unmatched rows of every window closed by the watermark."""
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    return _run(spark, s, "recon-outer")


@register("stream_window_metrics", _stream_join_sql("full_outer", select_metrics=True))
def q_stream_window_metrics(spark, sf_dir):
    """Per-window match metrics over the three-way (foreachBatch) stream output."""
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    path = scratch_path(spark, "stream-split")
    q = runner.run_split(s, f"{path}/out", f"{path}/checkpoint")
    return window_metrics(runner.read_split(spark, f"{path}/out", s.schema), runner.final_watermark(q))


@register("stream_overall_metrics", "SELECT COUNT(*) AS n_records, COUNT(*) FILTER (WHERE _merge = 'both') AS n_matched, "
          "COUNT(*) FILTER (WHERE _merge = 'left_only') AS n_unmatched_internal, "
          "COUNT(*) FILTER (WHERE _merge = 'right_only') AS n_unmatched_external, "
          "CAST(COUNT(*) FILTER (WHERE _merge = 'both') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS match_rate "
          f"FROM ({_stream_join_sql('full_outer')}) a")
def q_stream_overall_metrics(spark, sf_dir):
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    return overall_metrics(_run(spark, s, "recon-overall"))


@register("stream_observed_counts", "SELECT COUNT(*) FILTER (WHERE _merge = 'both') AS matched, COUNT(*) FILTER (WHERE _merge = 'left_only') AS unmatched_internal, "
          f"COUNT(*) FILTER (WHERE _merge = 'right_only') AS unmatched_external FROM ({_stream_join_sql('full_outer')}) a")
def q_stream_observed_counts(spark, sf_dir):
    """Counts that each micro-batch pushes to a listener as it is written; the output is not read again."""
    internal, external = _event_streams(spark, sf_dir)
    path, listener = scratch_path(spark, "stream-observed"), runner.ProgressListener()
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    name = path.rsplit("/", 1)[-1]
    s = s.observe(name, *[F.count_if(F.col("_merge") == tag).alias(n) for tag, n in writers.COUNTS.items()])
    spark.streams.addListener(listener)
    try:
        listener.wait(runner.run_to_parquet(s, f"{path}/out", f"{path}/checkpoint"))
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([tuple(listener.observed[name][n] for n in writers.COUNTS.values())], ", ".join(f"{n} long" for n in writers.COUNTS.values()))


_TIMELESS = ["s_int0 AS (SELECT event_id, user_id, CASE WHEN event_id % 23 = 6 THEN NULL ELSE ts END AS ts, amount FROM s_int)"]


@register("stream_null_event_time", _stream_join_sql("full_outer", internal="s_int0", more=_TIMELESS))
def q_stream_null_event_time(spark, sf_dir):
    """Events without a time match nothing and are reported as unmatched, in no window."""
    internal, external = _event_streams(spark, sf_dir)
    internal = internal.withColumn("ts", F.when(F.col("event_id") % 23 != 6, F.col("ts")))
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    return _run(spark, s, "null-time")


def _with_null_users(df):
    return df.withColumn("user_id", F.when(F.pmod("event_id", F.lit(19)) != 4, F.col("user_id")))


_NULL_USERS = [f"{b} AS (SELECT event_id, CASE WHEN ((event_id % 19) + 19) % 19 = 4 THEN NULL ELSE user_id END AS user_id, ts, {v} FROM {a})"
               for a, b, v in (("s_int", "s_intn", "amount"), ("s_ext", "s_extn", "net_amount"))]


@register("stream_null_keys", _stream_join_sql("full_outer", internal="s_intn", external="s_extn", more=_NULL_USERS)
          .replace("i.user_id = e.user_id", "i.user_id IS NOT DISTINCT FROM e.user_id"))
def q_stream_null_keys(spark, sf_dir):
    """Null keys match each other in a stream as they do in a batch."""
    internal, external = map(_with_null_users, _event_streams(spark, sf_dir))
    return _run(spark, reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05), "null-keys")


@register("stream_sliding_pairs", V.with_ctes(V.STREAMS + [V.windowed("s_int", "wi", 60, 15), V.windowed("s_ext", "we", 60, 15)], """
SELECT DISTINCT i.user_id, i.event_id, i.ts AS ts_internal, i.amount, e.ts AS ts_external, e.net_amount, 'both' AS _merge
FROM wi i JOIN we e ON i.user_id = e.user_id AND i.event_id = e.event_id AND i.window_start = e.window_start AND abs(i.amount - e.net_amount) <= 5e-2"""))
def q_stream_sliding_pairs(spark, sf_dir):
    """Pairs of four overlapping windows, each reported once."""
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _SLIDE, amount_tolerance=0.05, how="inner", pairs_once=True)
    return _run(spark, s, "sliding-pairs")


def _open_rows_sql(side: str, table: str, value: str) -> str:
    return (f"SELECT '{side}' AS side, window_start, window_end, user_id, event_id, ts, {value} AS value FROM {table} "
            "WHERE window_end > (SELECT wm FROM wm)")


@register("stream_state_rows", V.with_ctes(V.STREAMS + [V.stream_watermark(["s_int", "s_ext"]), V.windowed("s_int", "wi", 60), V.windowed("s_ext", "we", 60)],
          _open_rows_sql("internal", "wi", "amount") + " UNION ALL " + _open_rows_sql("external", "we", "net_amount")))
def q_stream_state_rows(spark, sf_dir):
    """What the stream's checkpoint still holds, in RocksDB and read by Spark's state reader: rows of open windows only."""
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    path = scratch_path(spark, "stream-state")
    with runner.rocksdb_state(spark):
        runner.run_to_parquet(s, f"{path}/out", f"{path}/checkpoint")
    frames = []
    for side, store, p, value in (("internal", "left", "i", "amount"), ("external", "right", "e", "net_amount")):
        state = runner.join_state(spark, f"{path}/checkpoint", store)
        frames.append(state.select(F.lit(side).alias("side"), F.col(f"{p}_window.start").cast("timestamp_ntz").alias("window_start"),
                                   F.col(f"{p}_window.end").cast("timestamp_ntz").alias("window_end"), F.col(f"{p}_user_id").alias("user_id"),
                                   F.col(f"{p}_event_id").alias("event_id"), F.col(f"{p}_ts").cast("timestamp_ntz").alias("ts"),
                                   F.col(f"{p}_{value}").alias("value")))
    return frames[0].unionByName(frames[1])


_ARRIVALS = 5
_LATE = [f"{name} AS (SELECT event_id, user_id, ts, {value}, least((day(ts) - 1) // 6 + CASE WHEN ((event_id % {m}) + {m}) % {m} = {r} THEN 2 ELSE 0 END, "
         f"{_ARRIVALS - 1}) AS arrival FROM {table})" for name, table, value, m, r in (("a_int", "s_int", "amount", 13, 5), ("a_ext", "s_ext", "net_amount", 17, 3))]
_LATE.append("""seen AS (SELECT k, (SELECT max(ts) FROM a_int WHERE arrival < k) AS mi, (SELECT max(ts) FROM a_ext WHERE arrival < k) AS me
  FROM range(5) r(k))""")
_LATE.append("wm AS (SELECT k, date_trunc('millisecond', least(mi, me)) - INTERVAL 10 MINUTE AS wm FROM seen WHERE mi IS NOT NULL AND me IS NOT NULL)")


def _late_sql(side: str, table: str, value: str) -> str:
    return (f"SELECT '{side}' AS side, event_id, user_id, ts, {value} AS value, arrival AS batch_id, wm AS watermark FROM {table} JOIN wm ON k = arrival "
            "WHERE time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE <= wm")


def _arrived(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """The event streams in five arrivals, some events two arrivals late, split as each of them comes in."""
    events = fixtures.table(spark, sf_dir, "events")
    base = scratch_path(spark, "stream-late")
    sides = {"internal": (fixtures.stream_internal_shape(events), 13, 5), "external": (fixtures.stream_external_shape(events), 17, 3)}
    schemas = {side: df.schema for side, (df, _, _) in sides.items()}
    for k in range(_ARRIVALS):
        for side, (df, m, r) in sides.items():
            behind = F.when(F.pmod("event_id", F.lit(m)) == r, 2).otherwise(0)
            arrival = F.least(F.floor((F.dayofmonth("ts") - 1) / 6) + behind, F.lit(_ARRIVALS - 1))
            df.where(arrival == k).write.parquet(f"{base}/in/{side}/arrival={k}")
        streams = [runner.file_stream(spark, f"{base}/in/{side}", schemas[side], recursive=True) for side in sides]
        late.run_late_split(*streams, f"{base}/split", f"{base}/checkpoint", _HOUR)
    return f"{base}/split", schemas


@register("stream_late_rows", V.with_ctes(V.STREAMS + _LATE, _late_sql("internal", "a_int", "amount") + " UNION ALL " + _late_sql("external", "a_ext", "net_amount")))
def q_stream_late_rows(spark, sf_dir):
    """Every event that came after its window had closed, with the watermark it missed."""
    base, schemas = _arrived(spark, sf_dir)
    frames = []
    for side, value in (("internal", "amount"), ("external", "net_amount")):
        rows = late.read_late(spark, base, side, schemas[side])
        frames.append(rows.select(F.lit(side).alias("side"), "event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                                  F.col(value).alias("value"), "batch_id", F.col("watermark").cast("timestamp_ntz").alias("watermark")))
    return frames[0].unionByName(frames[1])


@register("stream_late_balance", V.with_ctes(V.STREAMS + _LATE + [
    "on_i AS (SELECT * FROM a_int ANTI JOIN (" + _late_sql("internal", "a_int", "amount") + ") l USING (event_id))",
    "on_e AS (SELECT * FROM a_ext ANTI JOIN (" + _late_sql("external", "a_ext", "net_amount") + ") l USING (event_id))",
    "wmj AS (SELECT date_trunc('millisecond', least((SELECT max(ts) FROM on_i), (SELECT max(ts) FROM on_e))) - INTERVAL 10 MINUTE AS wm)",
    V.windowed("on_i", "wi", 60), V.windowed("on_e", "we", 60),
    "joined AS (SELECT i.event_id AS i, e.event_id AS e, coalesce(i.window_end, e.window_end) AS window_end FROM wi i FULL OUTER JOIN we e "
    "ON i.user_id = e.user_id AND i.event_id = e.event_id AND i.window_start = e.window_start AND abs(i.amount - e.net_amount) <= 5e-2)"],
    """SELECT (SELECT count(*) FROM events) AS n_internal, (SELECT count(*) FROM a_int) - (SELECT count(*) FROM on_i) AS n_late_internal,
  (SELECT count(*) FROM a_ext) - (SELECT count(*) FROM on_e) AS n_late_external, count(*) FILTER (WHERE i IS NOT NULL AND e IS NOT NULL) AS n_matched,
  count(*) FILTER (WHERE e IS NULL AND window_end <= (SELECT wm FROM wmj)) AS n_unmatched_internal,
  count(*) FILTER (WHERE i IS NULL AND window_end <= (SELECT wm FROM wmj)) AS n_unmatched_external,
  count(*) FILTER (WHERE e IS NULL AND window_end > (SELECT wm FROM wmj)) AS n_open_internal,
  count(*) FILTER (WHERE i IS NULL AND window_end > (SELECT wm FROM wmj)) AS n_open_external, true AS balanced FROM joined"""))
def q_stream_late_balance(spark, sf_dir):
    """Matched, unmatched, still open and late events of each side add up to all that came in."""
    base, schemas = _arrived(spark, sf_dir)
    streams = [late.on_time_stream(spark, base, side, schemas[side], replay.FILES_PER_TRIGGER) for side in late.SIDES]
    s = reconcile_stream(*streams, _STREAM_KEYS, _HOUR, amount_tolerance=0.05)
    path = scratch_path(spark, "late-balance")
    with runner.rocksdb_state(spark):
        runner.run_to_parquet(s, f"{path}/out", f"{path}/checkpoint")
    out = spark.read.schema(s.schema).parquet(f"{path}/out")
    held = [runner.join_state(spark, f"{path}/checkpoint", store).select(F.col(f"{p}_event_id").alias("event_id")) for store, p in (("left", "i"), ("right", "e"))]
    matched = out.where("_merge = 'both'").select("event_id")
    still_open = [h.join(matched, "event_id", "left_anti") for h in held]
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    events = fixtures.table(spark, sf_dir, "events")
    counts = [one(events, "n_internal"), one(late.read_late(spark, base, "internal", schemas["internal"]), "n_late_internal"),
              one(late.read_late(spark, base, "external", schemas["external"]), "n_late_external"), one(matched, "n_matched"),
              one(out.where("_merge = 'left_only'"), "n_unmatched_internal"), one(out.where("_merge = 'right_only'"), "n_unmatched_external"),
              one(still_open[0], "n_open_internal"), one(still_open[1], "n_open_external")]
    row = counts[0]
    for c in counts[1:]:
        row = row.join(c)  # one row each
    sums = [F.col("n_matched") + F.col(f"n_unmatched_{side}") + F.col(f"n_open_{side}") + F.col(f"n_late_{side}") == F.col("n_internal") for side in late.SIDES]
    return row.withColumn("balanced", sums[0] & sums[1])


_DATED = ["s_int1 AS (SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, ts, amount FROM s_int)",
          "s_ext1 AS (SELECT event_id, user_id, CAST(CAST(ts AS DATE) + CAST(event_id % 5 = 1 AS INT) AS VARCHAR) AS date, ts, "
          "net_amount FROM s_ext)"]


def _stream_job(spark, sf_dir, fmt: str):
    """The configured stream job on folders of events with a date of their own beside the event time."""
    internal, external = [f(fixtures.table(spark, sf_dir, "events")) for f in (fixtures.stream_internal_shape, fixtures.stream_external_shape)]
    day = F.col("ts").cast("timestamp_ntz").cast("date")
    internal = internal.withColumn("date", day.cast("string"))
    external = external.withColumn("date", F.date_add(day, F.when(F.col("event_id") % 5 == 1, 1).otherwise(0)).cast("string"))
    base = scratch_path(spark, f"stream-job-{fmt}")
    files = replay.file_count(internal.count())
    sources = {side: {"type": "file", "path": f"{base}/{side}"} for side in ("internal", "external")}
    for frame, source in ((internal, sources["internal"]), (external, sources["external"])):
        source["max_files_per_trigger"] = replay.land(frame, source["path"], "ts", files)
    config = {
        "sources": sources,
        "matching": {"match_on": ["user_id", "event_id", "date"], "internal_key": "amount", "external_key": "net_amount"},
        "tolerances": {"amount": 0.05},
        "window": {"type": "tumbling", "size": "1h", "grace": "10m"},
        "output": {"path": f"{base}/out", "reconciled_file": "matched", "unmatched_internal_file": "unmatched_internal",
                   "unmatched_external_file": "unmatched_external", "format": fmt},
    }
    _, schema, names = jobs.run_stream_job(spark, JobSpec.from_dict(config), internal.schema, external.schema, ts_col="ts")
    return runner.read_split(spark, f"{base}/out", schema, names, fmt)


@register("stream_date_key", _stream_join_sql("full_outer", internal="s_int1", external="s_ext1", more=_DATED, keys=("date",)))
def q_stream_date_key(spark, sf_dir):
    """A key called date stays a key when the event time is another column."""
    return _stream_job(spark, sf_dir, "parquet")


@register("stream_split_csv", _stream_join_sql("full_outer", internal="s_int1", external="s_ext1", more=_DATED, keys=("date",)))
def q_stream_split_csv(spark, sf_dir):
    """The configured format reaches the three stream outputs."""
    return _stream_job(spark, sf_dir, "csv")


@register("stream_recon_days", V.with_ctes(V.STREAMS + [
    "s_ext2 AS (SELECT event_id, user_id, ts + CASE event_id % 11 WHEN 3 THEN INTERVAL 20 HOUR WHEN 5 THEN INTERVAL 60 HOUR "
    "ELSE INTERVAL 0 HOUR END AS ts, net_amount FROM s_ext)", V.stream_watermark(["s_int", "s_ext2"]),
    V.windowed("s_int", "wi", 60), V.windowed("s_ext2", "we", 60)], """
SELECT * FROM (
  SELECT COALESCE(i.window_start, e.window_start) AS window_start, COALESCE(i.window_end, e.window_end) AS window_end,
         COALESCE(i.user_id, e.user_id) AS user_id, COALESCE(i.event_id, e.event_id) AS event_id,
         i.ts AS ts_internal, i.amount, e.ts AS ts_external, e.net_amount,
         CASE WHEN i.user_id IS NULL THEN 'right_only' WHEN e.user_id IS NULL THEN 'left_only' ELSE 'both' END AS _merge
  FROM wi i FULL OUTER JOIN we e ON i.user_id = e.user_id AND i.event_id = e.event_id
   AND i.ts >= e.ts - INTERVAL 1 DAY AND i.ts < e.ts + INTERVAL 2 DAY AND abs(i.amount - e.net_amount) <= 5e-2) j
WHERE _merge = 'both'
   OR _merge = 'left_only' AND ts_internal <= (SELECT wm FROM wm) - INTERVAL 1 DAY - INTERVAL 1 MILLISECOND
   OR _merge = 'right_only' AND ts_external <= (SELECT wm FROM wm) - INTERVAL 2 DAY"""))
def q_stream_recon_days(spark, sf_dir):
    """Events match across windows within one (floored) day; unmatched ones follow the watermark."""
    internal, external = _event_streams(spark, sf_dir)
    late = F.when(F.col("event_id") % 11 == 3, F.expr("INTERVAL 20 HOURS")).when(
        F.col("event_id") % 11 == 5, F.expr("INTERVAL 60 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    external = external.withColumn("ts", F.col("ts") + late)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05, date_tolerance_days=1)
    return _run(spark, s, "recon-days")


# ------------------------------------------------------- the mart as Spark SQL


@register("fct_reconciled_sql", V.with_ctes(V.MART, "SELECT * FROM fct"))
def q_fct_reconciled_sql(spark, sf_dir):
    """The same fact table from SQL text."""
    i, e = sql_models.staged(fixtures.raw_internal(spark, sf_dir), fixtures.raw_external(spark, sf_dir))
    return sql_models.fct_reconciled_sql(i, e)


@register("stream_recon_outer_salted", _stream_join_sql("full_outer"))
def q_stream_recon_outer_salted(spark, sf_dir):
    """The outer stream reconciliation with each key's window state spread over 4 buckets."""
    internal, external = _event_streams(spark, sf_dir)
    s = reconcile_stream(internal, external, _STREAM_KEYS, _HOUR, amount_tolerance=0.05, salt_buckets=4)
    return _run(spark, s, "recon-outer-salted")
