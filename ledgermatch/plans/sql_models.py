"""The staging views and the fact table as Spark SQL.

For users who keep their models as SQL text. Frames are handed to the statements
as named parameters and values as SQL literals, so nothing is pasted into the
text and no view is left behind unless ``register_staging`` is asked for one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgermatch.functions import StatusLabels

STAGE = """
SELECT transaction_id, to_timestamp_ntz(date, 'yyyy-MM-dd') AS transaction_date, customer_id, location_id, {amounts},
       :source AS source_system
FROM {raw}
"""
_INTERNAL_AMOUNTS = ("double(amount) AS gross_amount, double(fee) AS fee, double(amount) - double(fee) AS net_amount")
_EXTERNAL_AMOUNTS = "double(amount) AS net_amount"

FACT = """
WITH ours AS (SELECT *, date(transaction_date) AS day FROM {internal}),
theirs AS (SELECT *, date(transaction_date) AS day FROM {external}),
our_keys AS (SELECT customer_id, location_id, day, true AS paired FROM ours GROUP BY customer_id, location_id, day),
their_keys AS (SELECT customer_id, location_id, day, true AS paired FROM theirs GROUP BY customer_id, location_id, day),
our_rows AS (SELECT * FROM ours LEFT JOIN their_keys USING (customer_id, location_id, day)),
their_rows AS (SELECT * FROM theirs LEFT JOIN our_keys USING (customer_id, location_id, day)),
our_paired AS (SELECT DISTINCT transaction_id FROM our_rows WHERE paired),
their_paired AS (SELECT DISTINCT transaction_id FROM their_rows WHERE paired)
SELECT o.transaction_id AS internal_transaction_id, t.transaction_id AS external_transaction_id, o.transaction_date,
       customer_id, location_id, o.gross_amount AS internal_gross_amount, o.fee AS internal_fee,
       o.net_amount AS internal_net_amount, t.net_amount AS external_amount,
       abs(o.net_amount - t.net_amount) AS amount_difference,
       if(abs(o.net_amount - t.net_amount) <= :tolerance, :matched, :amount_variance) AS match_status
FROM ours o JOIN theirs t USING (customer_id, location_id, day)
UNION ALL
SELECT transaction_id, NULL, transaction_date, customer_id, location_id, gross_amount, fee, net_amount, NULL, NULL,
       :unmatched_internal
FROM our_rows LEFT ANTI JOIN our_paired USING (transaction_id) WHERE paired IS NULL OR transaction_id IS NULL
UNION ALL
SELECT NULL, transaction_id, transaction_date, customer_id, location_id, NULL, NULL, NULL, net_amount, NULL,
       :unmatched_external
FROM their_rows LEFT ANTI JOIN their_paired USING (transaction_id) WHERE paired IS NULL OR transaction_id IS NULL
"""


def staged(raw_internal: DataFrame, raw_external: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two staging models over raw frames."""
    def one(raw: DataFrame, amounts: str, source: str) -> DataFrame:
        return raw.sparkSession.sql(STAGE.replace("{amounts}", amounts), args={"source": source}, raw=raw)

    return one(raw_internal, _INTERNAL_AMOUNTS, "internal"), one(raw_external, _EXTERNAL_AMOUNTS, "external")


def register_staging(raw_internal: DataFrame, raw_external: DataFrame, internal_view: str = "stg_internal",
                     external_view: str = "stg_external") -> tuple[str, str]:
    """Keep the staging models as temporary views; returns their names."""
    for frame, view in zip(staged(raw_internal, raw_external), (internal_view, external_view)):
        frame.createOrReplaceTempView(view)
    return internal_view, external_view


def fct_reconciled_sql(internal: DataFrame, external: DataFrame, tolerance: float = 0.05,
                       labels: StatusLabels = StatusLabels()) -> DataFrame:
    """The fact table as one statement over two staged frames (without the run timestamp)."""
    values = {"tolerance": float(tolerance), "matched": labels.matched, "amount_variance": labels.amount_variance,
              "unmatched_internal": labels.unmatched_internal, "unmatched_external": labels.unmatched_external}
    return internal.sparkSession.sql(FACT, args=values, internal=internal, external=external)
