"""Column expressions shared by the batch and streaming operators."""

from ledgermatch.functions.expressions import (
    PANDAS_NA_TOKENS,
    StatusLabels,
    amount_bucket,
    amount_difference,
    amount_reach,
    day_bucket,
    day_distance,
    day_reach,
    micros_between,
    na_to_null,
    parse_datetime,
    status_expr,
    to_event_time,
    within_amount,
    within_days,
)

__all__ = [
    "PANDAS_NA_TOKENS",
    "StatusLabels",
    "amount_bucket",
    "amount_difference",
    "amount_reach",
    "day_bucket",
    "day_distance",
    "day_reach",
    "micros_between",
    "na_to_null",
    "parse_datetime",
    "status_expr",
    "to_event_time",
    "within_amount",
    "within_days",
]
