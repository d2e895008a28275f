"""Catalyst column expressions (no Python UDFs).

Every function returns a ``Column`` so that it stays inside whole-stage
codegen and can be pushed into joins as a residual predicate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The strings pandas' CSV reader turns into nulls by default
# (public pandas behaviour). Spark's CSV reader keeps them as text.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

_MICROS_PER_DAY = 86_400_000_000


@dataclass(frozen=True)
class StatusLabels:
    """Values of ``match_status``; override to reproduce other naming schemes."""

    matched: str = "MATCHED"
    amount_variance: str = "AMOUNT_VARIANCE"
    unmatched_internal: str = "UNMATCHED_INTERNAL"
    unmatched_external: str = "UNMATCHED_EXTERNAL"

    def all(self) -> tuple[str, str, str, str]:
        return (self.matched, self.amount_variance, self.unmatched_internal, self.unmatched_external)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_difference(a: Column | str, b: Column | str) -> Column:
    """``ABS(a - b)`` in IEEE double; no rounding before comparisons."""
    return F.abs(_col(a) - _col(b))


def within_amount(a: Column | str, b: Column | str, tolerance: float) -> Column:
    """``abs(a - b) <= tolerance``; null when either side is null."""
    return amount_difference(a, b) <= F.lit(float(tolerance))


def status_expr(a: Column | str, b: Column | str, tolerance: float,
                labels: StatusLabels = StatusLabels()) -> Column:
    """MATCHED when within tolerance, else AMOUNT_VARIANCE (null falls to the else branch)."""
    return F.when(within_amount(a, b, tolerance), F.lit(labels.matched)).otherwise(F.lit(labels.amount_variance))


def to_event_time(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Normalise a date / timestamp / string column to ``timestamp_ntz``.

    Strings are parsed leniently (ISO dates and date-times). Zone-free values
    keep day arithmetic free of daylight-saving shifts.
    """
    column = _col(c)
    if isinstance(dtype, T.TimestampNTZType):
        return column
    if isinstance(dtype, T.StringType):
        return F.to_timestamp_ntz(column)
    return column.cast("timestamp_ntz")


def micros_between(a: Column, b: Column) -> Column:
    """Signed ``a - b`` in microseconds for ``timestamp_ntz`` inputs."""
    return F.timestamp_diff("MICROSECOND", b, a)


def day_distance(a: Column, b: Column) -> Column:
    """Whole-day distance as pandas computes ``(a - b).dt.days.abs()``.

    ``.dt.days`` floors the signed difference, so -12 hours is day -1 and
    +12 hours is day 0; the absolute value is taken afterwards.
    """
    return F.abs(F.floor(micros_between(a, b) / F.lit(_MICROS_PER_DAY)))


def within_days(a: Column, b: Column, days: int) -> Column:
    return day_distance(a, b) <= F.lit(int(days))


def amount_bucket(amount: Column, tolerance: float) -> Column:
    """Whole number that differs by at most 1 for amounts within ``tolerance``.

    Buckets are sixteen tolerances wide. While a double's neighbours are no farther apart than
    the tolerance, each quotient's rounding is at most a sixteenth, so amounts within it have
    quotients no more than three sixteenths apart; beyond, only equal doubles are within it.
    """
    return F.floor(_amount_quotient(amount, tolerance))


def _amount_quotient(amount: Column, tolerance: float) -> Column:
    most = F.lit(2.0 ** 61)  # room for the neighbours; all beyond (and NaN) share the last bucket
    return F.least(F.greatest(amount.cast("double") / F.lit(16.0 * float(tolerance)), -most), most)


def amount_reach(amount: Column, tolerance: float) -> Column:
    """Array of the buckets that may hold amounts within ``tolerance``: its own, and a neighbour less than a quarter away."""
    at = _amount_quotient(amount, tolerance)
    own = F.floor(at)
    part = at - own
    cells = F.when(part < 0.25, F.array(own, own - 1)).when(part >= 0.75, F.array(own, own + 1)).otherwise(F.array(own))
    return F.when(amount.isNotNull(), cells)


def _day_cell(at: Column, days: int) -> Column:
    width = F.lit(4 * (int(days) + 1) * _MICROS_PER_DAY)
    return F.round((at - F.pmod(at, width)) / width).cast("bigint")  # the quotient is whole but for rounding


def _epoch_micros(ts: Column) -> Column:
    return micros_between(ts, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def day_bucket(ts: Column, days: int) -> Column:
    """Whole number that differs by at most 1 for timestamps ``within_days`` of each other; four times their span wide."""
    return _day_cell(_epoch_micros(ts), days)


def day_reach(ts: Column, days: int, of_first: bool) -> Column:
    """Array of the buckets that may hold partners of a timestamp: of a first one ``a`` those of ``b``, or the other way round.

    ``within_days(a, b, days)`` is ``-days <= (a - b) / 1 day < days + 1``.
    """
    before, after = (int(days) + 1) * _MICROS_PER_DAY - 1, int(days) * _MICROS_PER_DAY
    if not of_first:
        before, after = after, before
    at = _epoch_micros(ts)
    low, high = _day_cell(at - before, days), _day_cell(at + after, days)
    return F.when(ts.isNotNull(), F.when(low == high, F.array(low)).otherwise(F.array(low, high)))


def parse_datetime(c: Column | str, fmt: str = "yyyy-MM-dd", lenient: bool = False) -> Column:
    """``PARSE_DATETIME``: zone-free timestamp; malformed text fails unless lenient."""
    column = _col(c)
    if lenient:
        return F.try_to_timestamp(column, F.lit(fmt)).cast("timestamp_ntz")
    return F.to_timestamp_ntz(column, F.lit(fmt))


def na_to_null(c: Column | str, tokens: tuple[str, ...] = PANDAS_NA_TOKENS) -> Column:
    """Turn pandas-style NA tokens into nulls (apply before casts)."""
    column = _col(c)
    return F.when(column.isin(*tokens), F.lit(None).cast("string")).otherwise(column)
