"""The fixture ledgers and staging models written as plain SQL CTEs.

These are the independent oracle: DuckDB runs them over the same parquet
tables (``orders``, ``events`` registered as views) and the results are
compared with the DataFrame implementation. Double literals are written
``1e2`` / ``5e-2`` because ``0.05`` is a decimal literal in both engines.
"""

import re

_FEE = "CAST(o_orderkey % 400 AS DOUBLE) / 1e2"


def _id(prefix: str) -> str:
    return (f"CASE WHEN o_orderkey % 101 = 7 THEN NULL ELSE printf('{prefix}%09d', "
            "CASE WHEN o_orderkey % 53 = 11 THEN o_orderkey - 1 ELSE o_orderkey END) END")


_LOCATION = "CASE WHEN o_orderkey % 67 = 5 THEN NULL ELSE printf('LOC%03d', o_orderkey % 25 + 1) END"

RAW_INTERNAL = f"""raw_internal AS (
  SELECT {_id('IN')} AS transaction_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
         printf('CU%07d', o_custkey) AS customer_id,
         {_LOCATION} AS location_id,
         CASE WHEN o_orderkey % 83 = 2 THEN NULL ELSE o_totalprice END AS amount,
         {_FEE} AS fee
  FROM orders)"""

RAW_EXTERNAL = f"""raw_external AS (
  SELECT {_id('EX')} AS transaction_id,
         CAST(CAST(o_orderdate AS DATE)
              + CASE o_orderkey % 16 WHEN 3 THEN 1 WHEN 9 THEN -3 ELSE 0 END AS VARCHAR) AS date,
         printf('CU%07d', CASE WHEN o_orderkey % 16 IN (5, 12) THEN o_custkey + 5000000 ELSE o_custkey END) AS customer_id,
         {_LOCATION} AS location_id,
         CASE WHEN o_orderkey % 16 = 6
              THEN (o_totalprice - {_FEE}) + (CAST(o_orderkey % 120 AS DOUBLE) - 6e1) / 1e3
              ELSE o_totalprice - {_FEE} END AS amount
  FROM orders)"""

LEDGER_INTERNAL = """ledger_internal AS (
  SELECT transaction_id AS internal_tx_id, date, customer_id, location_id, amount - fee AS amount
  FROM raw_internal)"""

LEDGER_EXTERNAL = """ledger_external AS (
  SELECT transaction_id AS external_tx_id, date, customer_id, location_id, amount AS net_amount
  FROM raw_external)"""

STG_INTERNAL = """stg_internal AS (
  SELECT transaction_id, strptime(date, '%Y-%m-%d') AS transaction_date, customer_id, location_id,
         amount AS gross_amount, fee, amount - fee AS net_amount, 'internal' AS source_system
  FROM raw_internal)"""

STG_EXTERNAL = """stg_external AS (
  SELECT transaction_id, strptime(date, '%Y-%m-%d') AS transaction_date, customer_id, location_id,
         amount AS net_amount, 'external' AS source_system
  FROM raw_external)"""

# The fact table from its rules: pairs share customer, location and day; a row is unmatched if its id is null or is
# not among the ids of its side's paired rows.
_DAYS = """day_i AS (SELECT *, CAST(transaction_date AS DATE) AS day FROM stg_internal),
day_e AS (SELECT *, CAST(transaction_date AS DATE) AS day FROM stg_external)"""

_PAIRED = """paired_i AS (
  SELECT DISTINCT transaction_id FROM day_i SEMI JOIN day_e USING (customer_id, location_id, day)
  WHERE transaction_id IS NOT NULL),
paired_e AS (
  SELECT DISTINCT transaction_id FROM day_e SEMI JOIN day_i USING (customer_id, location_id, day)
  WHERE transaction_id IS NOT NULL)"""

MATCHED = _DAYS + ",\n" + _PAIRED + """,
matched AS (
  SELECT day_i.transaction_id AS internal_transaction_id, day_e.transaction_id AS external_transaction_id,
         day_i.transaction_date, customer_id, location_id,
         gross_amount AS internal_gross_amount, fee AS internal_fee, day_i.net_amount AS internal_net_amount,
         day_e.net_amount AS external_amount, abs(day_i.net_amount - day_e.net_amount) AS amount_difference,
         if(coalesce(abs(day_i.net_amount - day_e.net_amount) <= 5e-2, false), 'MATCHED', 'AMOUNT_VARIANCE')
           AS match_status
  FROM day_i JOIN day_e USING (customer_id, location_id, day))"""

UNMATCHED_INTERNAL = """unmatched_int AS (
  SELECT transaction_id AS internal_transaction_id, NULL::VARCHAR AS external_transaction_id, transaction_date,
         customer_id, location_id, gross_amount AS internal_gross_amount, fee AS internal_fee,
         net_amount AS internal_net_amount, NULL::DOUBLE AS external_amount, NULL::DOUBLE AS amount_difference,
         'UNMATCHED_INTERNAL' AS match_status
  FROM stg_internal
  WHERE NOT EXISTS (SELECT 1 FROM paired_i WHERE paired_i.transaction_id = stg_internal.transaction_id))"""

UNMATCHED_EXTERNAL = """unmatched_ext AS (
  SELECT NULL::VARCHAR AS internal_transaction_id, transaction_id AS external_transaction_id, transaction_date,
         customer_id, location_id, NULL::DOUBLE AS internal_gross_amount, NULL::DOUBLE AS internal_fee,
         NULL::DOUBLE AS internal_net_amount, net_amount AS external_amount, NULL::DOUBLE AS amount_difference,
         'UNMATCHED_EXTERNAL' AS match_status
  FROM stg_external
  WHERE NOT EXISTS (SELECT 1 FROM paired_e WHERE paired_e.transaction_id = stg_external.transaction_id))"""

# Where ids are trusted, a row is unmatched exactly if it has no partner (or a null id).
_TRUSTED = """trusted_i AS (
  SELECT * FROM stg_internal s WHERE transaction_id IS NULL OR NOT EXISTS (
    SELECT 1 FROM day_e d WHERE d.customer_id = s.customer_id AND d.location_id = s.location_id AND d.day = CAST(s.transaction_date AS DATE))),
trusted_e AS (
  SELECT * FROM stg_external s WHERE transaction_id IS NULL OR NOT EXISTS (
    SELECT 1 FROM day_i d WHERE d.customer_id = s.customer_id AND d.location_id = s.location_id AND d.day = CAST(s.transaction_date AS DATE)))"""

FCT = """fct AS (
  SELECT * FROM matched UNION ALL SELECT * FROM unmatched_int UNION ALL SELECT * FROM unmatched_ext)"""

STREAM_INTERNAL = """s_int AS (
  SELECT event_id, user_id, ts, value AS amount FROM events)"""

STREAM_EXTERNAL = """s_ext AS (
  SELECT CASE WHEN event_id % 7 = 2 THEN -event_id - 1 ELSE event_id END AS event_id, user_id, ts,
         CASE WHEN event_id % 9 = 4 THEN value + 1e0 ELSE value END AS net_amount
  FROM events)"""

LEDGERS = [RAW_INTERNAL, RAW_EXTERNAL]
PATH_A = LEDGERS + [LEDGER_INTERNAL, LEDGER_EXTERNAL]
STAGED = LEDGERS + [STG_INTERNAL, STG_EXTERNAL]
MART = STAGED + [MATCHED, UNMATCHED_INTERNAL, UNMATCHED_EXTERNAL, FCT]
MART_TRUSTED = STAGED + [MATCHED, _TRUSTED, re.sub(r"(?s)FROM stg_internal.*", "FROM trusted_i)", UNMATCHED_INTERNAL),
                         re.sub(r"(?s)FROM stg_external.*", "FROM trusted_e)", UNMATCHED_EXTERNAL), FCT]
STREAMS = [STREAM_INTERNAL, STREAM_EXTERNAL]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def outer_match_sql(left: str, right: str, keys: list[str], left_cols: list[str], right_cols: list[str],
                    on_extra: str | None = None, where: str | None = None, merge: str | None = None,
                    suffix_overlaps: bool = True) -> str:
    """FULL OUTER JOIN with null-safe keys, coalesced keys and a ``_merge`` indicator.

    Columns come out in the pandas order: left columns (keys coalesced), then the
    right side's non-key columns; overlapping non-key names get suffixes.
    """
    overlap = (set(left_cols) & set(right_cols)) - set(keys) if suffix_overlaps else set()
    sel = []
    for c in left_cols:
        if c in keys:
            sel.append(f"CASE WHEN l.__l IS NOT NULL THEN l.{c} ELSE r.{c} END AS {c}")
        else:
            sel.append(f"l.{c} AS {c + '_internal' if c in overlap else c}")
    for c in right_cols:
        if c not in keys:
            sel.append(f"r.{c} AS {c + '_external' if c in overlap else c}")
    sel.append("CASE WHEN l.__l IS NOT NULL AND r.__r IS NOT NULL THEN 'both' "
               "WHEN l.__l IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge")
    on = " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in keys)
    if on_extra:
        on += f" AND ({on_extra})"
    sql = (f"SELECT * FROM (SELECT {', '.join(sel)} FROM (SELECT *, 1 AS __l FROM {left}) l "
           f"FULL OUTER JOIN (SELECT *, 1 AS __r FROM {right}) r ON {on}"
           + (f" WHERE {where}" if where else "") + ") m")
    if merge:
        sql += f" WHERE _merge = '{merge}'"
    return sql

DOC_EXTERNAL = f"""doc_external AS (
  SELECT {_id('EX')} AS external_tx_id, o_totalprice AS gross_amount, {_FEE} AS fee,
         o_totalprice - {_FEE} AS net_amount, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
         'settled for ' || printf('CU%07d', o_custkey) AS description,
         printf('CU%07d', o_custkey) AS customer_id, {_LOCATION} AS location_id
  FROM orders)"""

DOC_INTERNAL = """doc_internal AS (
  SELECT transaction_id AS internal_tx_id, amount, date, customer_id, location_id FROM raw_internal)"""

# Streams: Spark aligns windows to the epoch; time_bucket's default origin
# (2000-01-01) gives the same boundaries for minute and hour sizes. The
# watermark is max(ts) minus the grace, at millisecond precision, and a join's
# watermark is the smaller of its two inputs'. Append mode emits aggregates
# and unmatched join rows only for windows with window_end <= watermark.


def stream_watermark(tables: list[str], grace: str = "10 MINUTE") -> str:
    maxes = ", ".join(f"(SELECT date_trunc('millisecond', max(ts)) FROM {t})" for t in tables)
    expr = maxes if len(tables) == 1 else f"LEAST({maxes})"
    return f"wm AS (SELECT {expr} - INTERVAL {grace} AS wm)"


def windowed(table: str, alias: str, size_min: int, slide_min: int | None = None) -> str:
    if slide_min is None:
        return (f"{alias} AS (SELECT *, time_bucket(INTERVAL {size_min} MINUTE, ts) AS window_start, "
                f"time_bucket(INTERVAL {size_min} MINUTE, ts) + INTERVAL {size_min} MINUTE AS window_end "
                f"FROM {table})")
    k = size_min // slide_min
    start = f"time_bucket(INTERVAL {slide_min} MINUTE, ts) - k * INTERVAL {slide_min} MINUTE"
    return (f"{alias} AS (SELECT t.*, {start} AS window_start, {start} + INTERVAL {size_min} MINUTE AS window_end "
            f"FROM {table} t, range(0, {k}) r(k))")
