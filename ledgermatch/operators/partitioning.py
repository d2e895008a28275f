"""Distinct keys that keep their column order."""

from __future__ import annotations

from pyspark.sql import DataFrame


def distinct_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of ``columns``, partitioned by them in this order.

    ``distinct()`` / ``dropDuplicates()`` group by a set of columns and lose
    their order; a join on the result would then re-key the other side's
    shuffle in that order and stop sharing it with sibling joins. Grouping
    explicitly keeps the order (the unused count is pruned away).
    """
    return df.groupBy(*columns).count().drop("count")
