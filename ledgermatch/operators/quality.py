"""Declarative data tests: unique, not_null, accepted_values, conservation.

Each test is a distributed aggregate returning a small result frame with
one row per tested column (``failures`` = number of offending values/rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.matching import BOTH, INDICATOR, LEFT_ONLY


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once, with their counts (nulls ignored)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def unique(df: DataFrame, column: str, table_name: str) -> DataFrame:
    """One row: how many values of ``column`` are duplicated."""
    return duplicate_values(df, column).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), "failures")


def not_null(df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """Null counts of several columns in a single pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(columns))
    return counts.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, failures)")).select(
        F.lit(table_name).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failures")


def accepted_values(df: DataFrame, column: str, values: Sequence[str], table_name: str) -> DataFrame:
    """Rows whose value is outside ``values`` (null is not a violation)."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return df.agg(F.count_if(bad).alias("failures")).select(
        F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("accepted_values").alias("test"), "failures")


def conservation(internal: DataFrame, classified: DataFrame, internal_id: str) -> DataFrame:
    """Do matched + unmatched internal account for every internal row?

    ``rows_conserved`` is the row-count identity, which holds only when keys
    are unique; ``ids_conserved`` counts distinct matched internal ids instead.
    """
    m = F.col(INDICATOR)
    none = F.lit(None).cast("long")
    side = internal.agg(F.count(F.lit(1)).alias("n_internal")).select(
        "n_internal", none.alias("n_matched_rows"), none.alias("n_matched_internal_ids"),
        none.alias("n_unmatched_internal"))
    outs = classified.agg(
        F.count_if(m == BOTH).alias("n_matched_rows"),
        F.count_distinct(F.when(m == BOTH, F.col(internal_id))).alias("n_matched_internal_ids"),
        F.count_if(m == LEFT_ONLY).alias("n_unmatched_internal"),
    ).select(none.alias("n_internal"), "n_matched_rows", "n_matched_internal_ids", "n_unmatched_internal")
    # Two one-row aggregates combined by a union and a max, not a join.
    cols = ["n_internal", "n_matched_rows", "n_matched_internal_ids", "n_unmatched_internal"]
    row = side.unionByName(outs).agg(*[F.max(c).alias(c) for c in cols])
    return row.select(
        *cols,
        ((F.col("n_matched_rows") + F.col("n_unmatched_internal")) == F.col("n_internal")).alias("rows_conserved"),
        ((F.col("n_matched_internal_ids") + F.col("n_unmatched_internal")) == F.col("n_internal"))
        .alias("ids_conserved"),
    )
