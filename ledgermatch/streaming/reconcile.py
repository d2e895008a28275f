"""Windowed stream-stream reconciliation.

Both sides are watermarked by the grace period and bucketed into windows;
a pair must share the keys and the window (and be within the amount
tolerance when one is set, which is classify semantics: a pair outside the
tolerance becomes two unmatched rows). Matched rows are emitted as soon as
both sides have arrived; unmatched rows are emitted when the watermark
passes the window's end and its state is dropped, so state stays bounded by
the open windows. With sliding windows a row belongs to several windows and
its matches are reported once per window.

With ``date_tolerance_days`` a pair need not share the window: its event times
must be within that many whole days (floored, as in the batch matcher), a range
condition on the two watermarked times that bounds the state all the same. A
row's window is then its own (a pair's is the internal row's).

A row without an event time is in no window. It can match nothing and is
reported as unmatched at once, with null window bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.matching import BOTH, INDICATOR, LEFT_ONLY, RIGHT_ONLY
from ledgermatch.spec import WindowSpec
from ledgermatch.streaming.windows import event_time, flatten_window, last_window_end, with_window


def _side(df: DataFrame, ts_col: str, spec: WindowSpec, prefix: str, by_time: bool = False) -> DataFrame:
    w = with_window(df, ts_col, spec)
    # Keep one event-time column (the window, or the time itself where events match
    # across windows); the raw time travels as a plain value.
    cols = [F.col("window").alias(f"{prefix}window")]
    if by_time:
        plain = F.struct((F.col("window.start") + F.expr("INTERVAL 0 SECONDS")).alias("start"),
                         (F.col("window.end") + F.expr("INTERVAL 0 SECONDS")).alias("end"))
        cols = [plain.alias(f"{prefix}window"), F.col(ts_col).alias(f"{prefix}time")]
    for c in df.columns:
        if c == ts_col:
            cols.append((F.col(c) + F.expr("INTERVAL 0 SECONDS")).alias(f"{prefix}{c}"))
        else:
            cols.append(F.col(c).alias(f"{prefix}{c}"))
    return w.select(cols)


def _timed(df: DataFrame, ts_col: str, spec: WindowSpec, prefix: str) -> DataFrame:
    """The event time as the watermarked column, in place of windows; beside it the columns of ``_side``."""
    df = event_time(df, ts_col).withWatermark(ts_col, spec.grace)
    plain = [(F.col(c) + F.expr("INTERVAL 0 SECONDS") if c == ts_col else F.col(c)).alias(f"{prefix}{c}") for c in df.columns]
    return df.select(F.col(ts_col).alias(f"{prefix}time"), *plain)


def _salted(df: DataFrame, prefix: str, buckets: int) -> DataFrame:
    """Each row in one bucket, chosen by a hash of its content (stable on retry)."""
    content = F.xxhash64(*[F.col(c) for c in df.columns if c not in (f"{prefix}window", f"{prefix}time")])
    return df.withColumn(f"{prefix}salt", F.pmod(content, F.lit(buckets)).cast("int"))


def _replicated(df: DataFrame, prefix: str, buckets: int) -> DataFrame:
    """Each row once per bucket."""
    return df.withColumn(f"{prefix}salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))


def reconcile_stream(internal: DataFrame, external: DataFrame, keys: Sequence[str], spec: WindowSpec,
                     internal_key: str = "amount", external_key: str = "net_amount",
                     amount_tolerance: float | None = None, ts_col: str = "ts",
                     how: str = "full_outer", salt_buckets: int = 1, date_tolerance_days: int = 0,
                     null_safe_keys: bool = True, pairs_once: bool = False) -> DataFrame:
    """Stream of reconciled rows with ``_merge`` in {both, left_only, right_only}.

    ``how="inner"`` emits matched pairs only; ``"full_outer"`` adds the
    unmatched rows of each closed window. Null keys match each other, as in the
    batch matcher, unless ``null_safe_keys`` is off.

    ``pairs_once`` (with ``how="inner"``) reports a pair of sliding windows once, in place of once
    for each window that holds both rows, and without a window. State has a row once, whatever
    the number of its windows: two rows share a window if the later one is in the last window
    of the earlier one. A pair is told by all its columns, so rows that are equal in all of them
    make one; it is kept in state only until the watermark has passed its time by a window and the grace period.

    ``salt_buckets > 1`` spreads a hot key's window state over that many
    state partitions. One join puts each internal row in one bucket and copies
    the external rows to every bucket, which yields the pairs and the
    internal-only rows exactly once. A second join does the mirror image and
    keeps only its external-only rows. The price is ``salt_buckets`` copies of
    the replicated side's state.
    """
    if how not in ("inner", "full_outer"):
        raise ValueError("how must be 'inner' or 'full_outer'")
    if pairs_once and (how != "inner" or date_tolerance_days > 0):
        raise ValueError("pairs_once goes with how='inner' and windows")
    if salt_buckets < 1:
        raise ValueError("salt_buckets must be at least 1")
    by_time = date_tolerance_days > 0
    if by_time and spec.type == "sliding":
        raise ValueError("a day tolerance needs tumbling windows: a sliding one would report each pair several times")
    side = _timed if pairs_once else partial(_side, by_time=by_time)
    left = side(internal.where(F.col(ts_col).isNotNull()), ts_col, spec, "i_")
    right = side(external.where(F.col(ts_col).isNotNull()), ts_col, spec, "e_")

    def condition(lf: DataFrame, rf: DataFrame, salted: bool) -> Column:
        # a stream join finds null keys equal by itself, so that has to be said where they are not to match
        plain = lambda a, b: (a == b) & a.isNotNull() & b.isNotNull()
        cond = [lf[f"i_{k}"].eqNullSafe(rf[f"e_{k}"]) if null_safe_keys else plain(lf[f"i_{k}"], rf[f"e_{k}"]) for k in keys]
        if pairs_once:
            # the last window that holds the earlier row holds the later one; the first two lines bound the state
            size = F.expr(f"INTERVAL {spec.size}")
            cond += [lf["i_time"] > rf["e_time"] - size, rf["e_time"] > lf["i_time"] - size,
                     last_window_end(F.least(lf["i_time"], rf["e_time"]), spec) > F.greatest(lf["i_time"], rf["e_time"])]
        elif by_time:
            # -days <= floor((internal - external) / 1 day) <= days
            day = lambda n: F.expr(f"INTERVAL {n} DAYS")
            cond += [lf["i_time"] >= rf["e_time"] - day(date_tolerance_days),
                     lf["i_time"] < rf["e_time"] + day(date_tolerance_days + 1)]
        else:
            cond.append(lf["i_window"] == rf["e_window"])
        if salted:
            cond.append(lf["i_salt"] == rf["e_salt"])
        if amount_tolerance is not None:
            cond.append(F.abs(lf[f"i_{internal_key}"] - rf[f"e_{external_key}"]) <= F.lit(float(amount_tolerance)))
        return reduce(lambda a, b: a & b, cond)

    if salt_buckets == 1:
        joined = left.join(right, condition(left, right, False), how)
    else:
        ls, rr = _salted(left, "i_", salt_buckets), _replicated(right, "e_", salt_buckets)
        joined = ls.join(rr, condition(ls, rr, True), "inner" if how == "inner" else "left_outer")
        joined = joined.drop("i_salt", "e_salt")
        if how == "full_outer":
            lr, rs = _replicated(left, "i_", salt_buckets), _salted(right, "e_", salt_buckets)
            right_only = (lr.join(rs, condition(lr, rs, True), "right_outer")
                          .where(F.col("i_window").isNull()).drop("i_salt", "e_salt"))
            joined = joined.unionByName(right_only)
    if pairs_once:
        # one side's time carries the watermark on; it must be the only column that does
        plain = [c for c in joined.columns if c not in ("i_time", "e_time")]
        none = F.lit(None).cast("struct<start:timestamp,end:timestamp>")
        joined = joined.select(F.col("i_time").alias("__time"), *plain).dropDuplicatesWithinWatermark(plain)
        joined = joined.select(none.alias("i_window"), none.alias("e_window"), *plain)
    present_i = F.lit(True) if pairs_once else F.col("i_window").isNotNull()
    present_e = F.lit(True) if pairs_once else F.col("e_window").isNotNull()
    tag = F.when(present_i & present_e, F.lit(BOTH)).when(present_i, F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY))
    out = [F.coalesce(F.col("i_window"), F.col("e_window")).alias("window")]
    # by presence, not by value: a null key of an internal row stays null
    out += [F.when(present_i, F.col(f"i_{k}")).otherwise(F.col(f"e_{k}")).alias(k) for k in keys]
    overlap = (set(internal.columns) & set(external.columns)) - set(keys)

    def named(side: str, c: str) -> Column:
        col = F.col(f"{side}_{c}")
        if c == ts_col:
            col = col.cast("timestamp_ntz")
        return col.alias(f"{c}_{'internal' if side == 'i' else 'external'}" if c in overlap else c)
    out += [named("i", c) for c in internal.columns if c not in keys]
    out += [named("e", c) for c in external.columns if c not in keys]
    out.append(tag.alias(INDICATOR))
    done = flatten_window(joined.select(out))
    if how == "inner":
        return done.drop("window_start", "window_end") if pairs_once else done
    return (done.unionByName(_timeless(internal, ts_col, LEFT_ONLY, done, keys, overlap, "internal"))
            .unionByName(_timeless(external, ts_col, RIGHT_ONLY, done, keys, overlap, "external")))


def _timeless(side: DataFrame, ts_col: str, tag: str, like: DataFrame, keys: Sequence[str], overlap: set[str],
              suffix: str) -> DataFrame:
    """Rows without an event time, in the layout of ``like``: unmatched, in no window."""
    rows = side.where(F.col(ts_col).isNull())
    own = {c if c in keys else f"{c}_{suffix}" if c in overlap else c: c for c in side.columns}
    cols = []
    for f in like.schema:
        value = F.lit(tag) if f.name == INDICATOR else F.col(own[f.name]) if f.name in own else F.lit(None)
        cols.append(value.cast(f.dataType).alias(f.name))
    return rows.select(cols)


def overall_metrics(classified: DataFrame) -> DataFrame:
    """One row over all windows: records, matched and unmatched counts, match rate."""
    return _metrics(classified.groupBy())


def _metrics(groups) -> DataFrame:
    m = F.col(INDICATOR)
    agg = groups.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(m == BOTH).alias("n_matched"),
        F.count_if(m == LEFT_ONLY).alias("n_unmatched_internal"),
        F.count_if(m == RIGHT_ONLY).alias("n_unmatched_external"),
    )
    return agg.withColumn("match_rate", F.col("n_matched").cast("double") / F.col("n_records").cast("double"))


def window_metrics(classified: DataFrame, watermark: str | None = None) -> DataFrame:
    """Per window: records, matched and unmatched counts, match rate, completion.

    A batch function over reconciled rows (for example the folders a stream
    appends to). ``watermark`` is the stream's event-time watermark (an ISO
    instant, as in the query's progress report): a window is ``complete`` once
    its end is at or before it, and its unmatched rows are then final.
    """
    agg = _metrics(classified.groupBy("window_start", "window_end"))
    if watermark is not None:
        # The watermark is an instant; window bounds are wall-clock in the session zone.
        wm = F.to_timestamp(F.lit(watermark)).cast("timestamp_ntz")
        agg = agg.withColumn("complete", F.col("window_end") <= wm)
    return agg
