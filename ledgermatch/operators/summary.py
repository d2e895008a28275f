"""Summaries over reconciliation results (counts, shares, rates, previews)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.functions import StatusLabels
from ledgermatch.operators.matching import BOTH, INDICATOR, LEFT_ONLY, RIGHT_ONLY


def status_counts(fct: DataFrame, status_col: str = "match_status") -> DataFrame:
    """COUNT(*) per status (partial aggregation before the shuffle)."""
    return fct.groupBy(status_col).agg(F.count(F.lit(1)).alias("count"))


def status_summary(fct: DataFrame, status_col: str = "match_status") -> DataFrame:
    """Count and percentage of total per status, largest first.

    The share uses a window over the aggregated rows; there is one row per
    status value (four labels), so the single-partition window is bounded.
    """
    counts = status_counts(fct, status_col)
    total = F.sum("count").over(Window.partitionBy())
    pct = F.round(F.col("count").cast("double") * F.lit(1e2) / total.cast("double"), 2)
    return counts.select(status_col, "count", pct.alias("percentage")).orderBy(F.desc("count"))


def match_rate(fct: DataFrame, labels: StatusLabels = StatusLabels(), status_col: str = "match_status") -> DataFrame:
    """One-row metrics: rows per status and the share of rows that matched."""
    s = F.col(status_col)
    row = fct.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(s == labels.matched).alias("n_matched"),
        F.count_if(s == labels.amount_variance).alias("n_amount_variance"),
        F.count_if(s == labels.unmatched_internal).alias("n_unmatched_internal"),
        F.count_if(s == labels.unmatched_external).alias("n_unmatched_external"),
    )
    return row.withColumn("match_rate", F.col("n_matched").cast("double") / F.col("n_rows").cast("double"))


def output_counts(classified: DataFrame) -> DataFrame:
    """Rows in each of the three outputs, counted in one pass over the classified frame."""
    m = F.col(INDICATOR)
    return classified.agg(
        F.count_if(m == BOTH).alias("matched"),
        F.count_if(m == LEFT_ONLY).alias("unmatched_internal"),
        F.count_if(m == RIGHT_ONLY).alias("unmatched_external"),
    )


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """Deterministic first-n rows (a top-k: each task keeps n rows, then they merge)."""
    return df.orderBy(*order_by).limit(n)
