"""The reconciled fact table: one row per matched pair or unmatched transaction.

Semantics (SQL equality, so null keys never match):

* a pair is an internal and an external row with equal customer, location and
  calendar day; it is MATCHED when ``abs(internal net - external net) <= tolerance`` and
  AMOUNT_VARIANCE otherwise (a null amount is a variance);
* an internal row is unmatched when its ``transaction_id`` is null or is not the
  id of any paired internal row (likewise for the external side).

Plan. Each ledger is shuffled once at full width, by the match key. Rows whose key
is not complete take a hash of their own for a key, so they spread over all tasks
and meet nothing. The pairs are an inner join of the two; a left join with the
other side's *distinct* keys adds a ``_paired`` flag, where a hot key is one row
per map task and AQE may split the probe side. Unmatched rows are a filter on the
flag, and so are the paired ids that the id rule takes away, which are narrow and
de-duplicated before their shuffle. All of these read the same exchange of each
ledger: nothing but distinct keys, ids and unmatched rows is shuffled beside it.
``id_check="trusted"`` leaves the id step out where ids were proven unique and
non-null (see ``quality.unique`` / ``quality.not_null``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.functions import StatusLabels, amount_difference, status_expr
from ledgermatch.operators.partitioning import distinct_keys

KEY_COLUMNS = ("_customer", "_location", "_day", "_none")

MART_COLUMNS = (
    "internal_transaction_id",
    "external_transaction_id",
    "transaction_date",
    "customer_id",
    "location_id",
    "internal_gross_amount",
    "internal_fee",
    "internal_net_amount",
    "external_amount",
    "amount_difference",
    "match_status",
    "reconciliation_timestamp",
)

_INTERNAL = ("transaction_id", "transaction_date", "customer_id", "location_id", "gross_amount", "fee", "net_amount")
_EXTERNAL = ("transaction_id", "transaction_date", "customer_id", "location_id", "net_amount")


def _keyed(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns and the match key, none of it null. Where a part is missing the key is a hash of the row, odd for
    internal rows and even for external ones, so that it meets none of the other side."""
    day = F.to_date("transaction_date")
    present = F.col("customer_id").isNotNull() & F.col("location_id").isNotNull() & day.isNotNull()
    own = F.xxhash64(*columns).bitwiseOR(F.lit(1).cast("long"))
    own = own if columns == _INTERNAL else F.shiftleft(own, 1)
    part = lambda value, default: F.coalesce(F.when(present, value), default)
    return df.select(*columns, part(F.col("customer_id"), F.lit("")).alias("_customer"), part(F.col("location_id"), F.lit("")).alias("_location"),
                     part(day, F.lit("1970-01-01").cast("date")).alias("_day"), part(F.lit(0).cast("long"), own).alias("_none"))


def _run_ts(run_ts: str | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.to_timestamp(F.lit(run_ts))


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def matched_pairs(internal: DataFrame, external: DataFrame, tolerance: float = 0.05,
                  labels: StatusLabels = StatusLabels(), run_ts: str | None = None) -> DataFrame:
    """Inner join on customer, location and ``DATE(transaction_date)`` with status."""
    # Both sides keep their own column names up to the join, so each side's
    # exchange is the same plan as in the anti joins and is reused there.
    i = _keyed(internal, _INTERNAL).alias("i")
    e = _keyed(external, _EXTERNAL).alias("e")
    cond = [F.col(f"i.{k}") == F.col(f"e.{k}") for k in KEY_COLUMNS]
    net_i, net_e = F.col("i.net_amount"), F.col("e.net_amount")
    return i.join(e, cond, "inner").select(
        F.col("i.transaction_id").alias("internal_transaction_id"),
        F.col("e.transaction_id").alias("external_transaction_id"),
        # Always the internal values (they are not null in a pair); reading the external ones
        # as well keeps this join's external shuffle identical to the external flag's, so
        # Spark runs it once.
        F.coalesce(F.col("i.transaction_date"), F.col("e.transaction_date")).alias("transaction_date"),
        F.coalesce(F.col("i.customer_id"), F.col("e.customer_id")).alias("customer_id"),
        F.coalesce(F.col("i.location_id"), F.col("e.location_id")).alias("location_id"),
        F.col("i.gross_amount").alias("internal_gross_amount"),
        F.col("i.fee").alias("internal_fee"),
        net_i.alias("internal_net_amount"),
        net_e.alias("external_amount"),
        amount_difference(net_i, net_e).alias("amount_difference"),
        status_expr(net_i, net_e, tolerance, labels).alias("match_status"),
        _run_ts(run_ts).alias("reconciliation_timestamp"),
    )


def _flagged(side: DataFrame, other: DataFrame, side_cols: tuple[str, ...], other_cols: tuple[str, ...]) -> DataFrame:
    """Rows of ``side`` with ``_paired``: whether the other side has the same keys."""
    partner_keys = distinct_keys(_keyed(other, other_cols).where("_none = 0"), list(KEY_COLUMNS))
    found = _keyed(side, side_cols).join(partner_keys.withColumn("_paired", F.lit(True)), list(KEY_COLUMNS), "left")
    return found.withColumn("_paired", F.col("_paired").isNotNull())


def _unmatched_rows(side: DataFrame, other: DataFrame, side_cols: tuple[str, ...],
                    other_cols: tuple[str, ...], id_check: str) -> DataFrame:
    """Rows of ``side`` reported unmatched under the id rule."""
    if id_check not in ("exact", "trusted"):
        raise ValueError(f"id_check must be 'exact' or 'trusted', not {id_check!r}")
    flagged = _flagged(side, other, side_cols, other_cols)
    # A null id never equals a paired id, so a paired row with a null id is reported too.
    rows = flagged.where(~F.col("_paired") | F.col("transaction_id").isNull()).drop("_paired")
    if id_check == "trusted":
        return rows
    # An id also carried by a paired row (a duplicate id) is not unmatched. Null ids meet
    # nothing: rows without one take a hash for an id, odd and so none of a paired row.
    # With keys that cannot be null no filter on them is inferred, and the flag is made of
    # all columns: so this branch reads the ledger's one exchange, too.
    present, own = F.col("transaction_id").isNotNull(), F.xxhash64(*side_cols).bitwiseOR(F.lit(1).cast("long"))
    id_key = F.coalesce(F.col("transaction_id"), F.lit("")).alias("_id")
    rows = rows.select("*", id_key, F.coalesce(F.when(present, F.lit(0).cast("long")), own).alias("_no_id"))
    paired_ids = (flagged.where("_paired").groupBy(id_key, F.when(present, 0).otherwise(2).cast("long").alias("_no_id"))
                  .agg(F.max(F.xxhash64(*side_cols)).alias("_id_paired")))
    marked = rows.join(paired_ids, ["_id", "_no_id"], "left")
    return marked.where(F.col("_id_paired").isNull()).drop("_id_paired", "_id", "_no_id")


def unmatched_internal(internal: DataFrame, external: DataFrame, labels: StatusLabels = StatusLabels(),
                       id_check: str = "exact", run_ts: str | None = None) -> DataFrame:
    rows = _unmatched_rows(internal, external, _INTERNAL, _EXTERNAL, id_check)
    return rows.select(
        F.col("transaction_id").alias("internal_transaction_id"),
        _null("string").alias("external_transaction_id"),
        "transaction_date",
        "customer_id",
        "location_id",
        F.col("gross_amount").alias("internal_gross_amount"),
        F.col("fee").alias("internal_fee"),
        F.col("net_amount").alias("internal_net_amount"),
        _null("double").alias("external_amount"),
        _null("double").alias("amount_difference"),
        F.lit(labels.unmatched_internal).alias("match_status"),
        _run_ts(run_ts).alias("reconciliation_timestamp"),
    )


def unmatched_external(internal: DataFrame, external: DataFrame, labels: StatusLabels = StatusLabels(),
                       id_check: str = "exact", run_ts: str | None = None) -> DataFrame:
    rows = _unmatched_rows(external, internal, _EXTERNAL, _INTERNAL, id_check)
    return rows.select(
        _null("string").alias("internal_transaction_id"),
        F.col("transaction_id").alias("external_transaction_id"),
        "transaction_date",
        "customer_id",
        "location_id",
        _null("double").alias("internal_gross_amount"),
        _null("double").alias("internal_fee"),
        _null("double").alias("internal_net_amount"),
        F.col("net_amount").alias("external_amount"),
        _null("double").alias("amount_difference"),
        F.lit(labels.unmatched_external).alias("match_status"),
        _run_ts(run_ts).alias("reconciliation_timestamp"),
    )


def fct_reconciled(internal: DataFrame, external: DataFrame, tolerance: float = 0.05,
                   labels: StatusLabels = StatusLabels(), id_check: str = "exact",
                   run_ts: str | None = None) -> DataFrame:
    """UNION ALL of pairs, unmatched internal and unmatched external rows.

    ``internal`` and ``external`` are staged ledgers (``stage_internal`` /
    ``stage_external``). ``run_ts`` pins ``reconciliation_timestamp`` for
    repeatable runs; by default it is the query's current timestamp.
    """
    # current_timestamp() is fixed once per query, so all branches share it.
    pairs = matched_pairs(internal, external, tolerance, labels, run_ts)
    left = unmatched_internal(internal, external, labels, id_check, run_ts)
    right = unmatched_external(internal, external, labels, id_check, run_ts)
    return pairs.unionByName(left).unionByName(right).select(*MART_COLUMNS)
