"""Two-sided matching with an indicator column (full outer join semantics).

``outer_match`` returns every row of both sides: pairs that satisfy the
condition (``_merge = 'both'``), left rows without a partner (``left_only``)
and right rows without one (``right_only``). Keys compare null-safely, the
way pandas merges null keys.

Plan. A full outer sort-merge join cannot be split by AQE when a key is hot,
so the result is the union of three joins that can:

* pairs: inner join on the keys (plus an optional residual condition);
* ``left_only``: left-anti join of the left side against the right side's
  *distinct* keys (pre-aggregated map-side, so a hot key is one row per task);
* ``right_only``: the mirror image.

All three read one hash exchange per side (reused within the query), and a
filter on ``_merge`` prunes the branches it does not need, so ``matched``
alone never pays for the anti joins.

With tolerances, *bands* join the keys, one for each: the value's bucket, several
tolerances wide, so that two values within the tolerance are in the same or, near an
edge, in neighbouring buckets. Two bands make a grid of cells. One side of each join is
put into its cell and the neighbours that it reaches (about one and a half cells for a
band, two for two bands), the other only into its own, and the exact condition stays as a residual. So a key that is hot on both sides is
compared within neighbouring cells, not as a whole, also where its rows agree in one
of the two values; the anti joins' build sides are distinct (keys, values) rows there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.operators.partitioning import distinct_keys


BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left_only", "right_only"
INDICATOR = "_merge"


@dataclass(frozen=True)
class Band:
    """Buckets of one side's rows, from a resolver of its source columns."""

    #: The bucket of a row: a whole number, or null for a row that can match nothing.
    of: Callable[[Callable[[str], Column]], Column]
    #: Array of the other side's buckets that its partners may be in; null with ``of``.
    reach: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class MatchLayout:
    """Output naming of an outer match: keys once, overlaps suffixed."""

    keys: tuple[str, ...]
    left_out: tuple[tuple[str, str], ...]   # (source column, output name), in order
    right_out: tuple[tuple[str, str], ...]

    @property
    def columns(self) -> list[str]:
        return [o for _, o in self.left_out] + [o for _, o in self.right_out] + [INDICATOR]

    def output_name(self, side: str, column: str) -> str | None:
        pairs = self.left_out if side == "left" else self.right_out
        return next((o for s, o in pairs if s == column), None)


def _key_family(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "floating"
    if isinstance(dtype, T.NumericType):
        return "exact numeric"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    return dtype.simpleString()


def check_key_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Refuse keys whose types differ in kind (e.g. integer ids on one side, text on the other).

    Spark would cast one side silently and match '1001' with 1001 (or miss
    '01001'), or an integer with a floating-point number that merely rounds to
    it; the keys should be aligned explicitly instead. Whole and decimal numbers
    of different widths compare exactly and are allowed.
    """
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if _key_family(a) != _key_family(b):
            raise TypeError(f"join key {k!r} is {a.simpleString()} on the internal side and "
                            f"{b.simpleString()} on the external side; cast one side first")


def layout(left: DataFrame, right: DataFrame, keys: Sequence[str],
           suffixes: tuple[str, str] = ("_internal", "_external")) -> MatchLayout:
    for k in keys:
        if k not in left.columns or k not in right.columns:
            raise ValueError(f"join key {k!r} must exist on both sides")
    check_key_types(left, right, keys)
    # Names overlap as the session resolves them: by default whatever their case.
    exact = left.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    same = (lambda c: c) if exact else str.lower
    overlap = ({same(c) for c in left.columns} & {same(c) for c in right.columns}) - {same(k) for k in keys}
    left_out = tuple((c, c + suffixes[0] if same(c) in overlap else c) for c in left.columns)
    right_out = tuple((c, c + suffixes[1] if same(c) in overlap else c) for c in right.columns if c not in keys)
    return MatchLayout(tuple(keys), left_out, right_out)


def _lk(i: int) -> str:
    return f"__lk{i}"


def _rk(i: int) -> str:
    return f"__rk{i}"


def _default(dtype: T.DataType) -> Column:
    """A non-null stand-in of the key's type (Spark rewrites ``<=>`` the same way)."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.BinaryType):
        return F.lit("").cast("binary")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(0).cast("timestamp").cast(dtype)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    return F.lit(None).cast(dtype)


def _match_keys(frame: DataFrame, names: list[str], prefix: str, null_safe: bool) -> tuple[DataFrame, list[str]]:
    """Add the columns the join compares with plain equality.

    Null-safe keys become (coalesce(k, default), isnull(k)) pairs. Joining and
    de-duplicating on the same physical columns lets the distinct build side's
    exchange serve the join directly, and lets every branch share one exchange.
    """
    if not null_safe:
        return frame, names
    cols, out = [], []
    for i, n in enumerate(names):
        dtype = frame.schema[n].dataType
        cols += [F.coalesce(F.col(n), _default(dtype)).alias(f"{prefix}v{i}"),
                 F.col(n).isNull().alias(f"{prefix}n{i}")]
        out += [f"{prefix}v{i}", f"{prefix}n{i}"]
    return frame.select("*", *cols), out


def outer_match(left: DataFrame, right: DataFrame, keys: Sequence[str],
                residual: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
                residual_columns: tuple[Sequence[str], Sequence[str]] = ((), ()),
                suffixes: tuple[str, str] = ("_internal", "_external"),
                null_safe: bool = True,
                bands: Sequence[tuple[Band, Band]] = (),
                ) -> tuple[DataFrame, MatchLayout]:
    """Full outer join on ``keys`` (and ``residual``) with a ``_merge`` indicator.

    ``residual(l, r)`` builds an extra pair condition from two resolvers that
    map a source column name of the left / right side to a ``Column``; the
    columns it reads must be listed in ``residual_columns`` (left, right).
    Each of ``bands`` says for left and for right rows which bucket a row is in and which
    of the other side it reaches; wherever the residual holds, a row reaches the other's bucket.
    They read key and residual columns only.
    """
    lay = layout(left, right, keys, suffixes)
    n = len(keys)
    key_idx = {k: i for i, k in enumerate(keys)}

    # Side frames with internal names: keys as __lk / __rk, the rest as output names.
    lside = left.select([F.col(s).alias(_lk(key_idx[s]) if s in key_idx else o) for s, o in lay.left_out])
    rcols = [F.col(k).alias(_rk(i)) for i, k in enumerate(keys)]
    rside = right.select(rcols + [F.col(s).alias(o) for s, o in lay.right_out])
    lside, ljoin = _match_keys(lside, [_lk(i) for i in range(n)], "__lm", null_safe)
    rside, rjoin = _match_keys(rside, [_rk(i) for i in range(n)], "__rm", null_safe)

    def lref(frame: DataFrame) -> Callable[[str], Column]:
        return lambda c: frame[_lk(key_idx[c])] if c in key_idx else frame[lay.output_name("left", c)]

    def rref(frame: DataFrame) -> Callable[[str], Column]:
        return lambda c: frame[_rk(key_idx[c])] if c in key_idx else frame[lay.output_name("right", c)]

    l_band, r_band = [f"__lband{i}" for i in range(len(bands))], [f"__rband{i}" for i in range(len(bands))]
    for (of_left, of_right), a, b in zip(bands, l_band, r_band):
        lside, rside = lside.withColumn(a, of_left.of(lref(lside))), rside.withColumn(b, of_right.of(rref(rside)))

    def reaching(frame: DataFrame, names: list[str], side: int, ref) -> DataFrame:
        """Each row in the cells that its partners may be in; rows without a value are in none."""
        for band, name in zip(bands, names):
            frame = frame.withColumn(name, F.explode(band[side].reach(ref(frame))))
        return frame

    def condition(lf: DataFrame, rf: DataFrame) -> Column:
        parts = [lf[a] == rf[b] for a, b in zip(ljoin, rjoin)]
        parts += [lf[a] == rf[b] for a, b in zip(l_band, r_band)]
        if residual is not None:
            # A null residual fails in the inner and the anti join alike. Wrapped
            # in coalesce it is no longer null-intolerant, so Catalyst does not
            # push inferred IS NOT NULL filters into the pairs branch only, and
            # all branches keep one shared exchange per side.
            parts.append(F.coalesce(residual(lref(lf), rref(rf)), F.lit(False)))
        return reduce(lambda x, y: x & y, parts)

    # Build sides of the anti joins: distinct match keys (plus residual inputs),
    # aggregated map-side before the shuffle so a hot key shrinks to one row per task.
    l_extra = [lay.output_name("left", c) for c in residual_columns[0] if c not in key_idx]
    r_extra = [lay.output_name("right", c) for c in residual_columns[1] if c not in key_idx]
    lkeys = lside.select(ljoin + l_band + [_lk(key_idx[c]) for c in residual_columns[0] if c in key_idx] + l_extra)
    rkeys = rside.select(rjoin + r_band + [_rk(key_idx[c]) for c in residual_columns[1] if c in key_idx] + r_extra)
    lkeys, rkeys = distinct_keys(lkeys, lkeys.columns), distinct_keys(rkeys, rkeys.columns)
    rpairs = rside
    if bands:
        lkeys, rkeys, rpairs = reaching(lkeys, l_band, 0, lref), reaching(rkeys, r_band, 1, rref), reaching(rside, r_band, 1, rref)

    pairs = lside.join(rpairs, condition(lside, rpairs), "inner")
    lonly = lside.join(rkeys, condition(lside, rkeys), "left_anti")
    ronly = rside.join(lkeys, condition(lkeys, rside), "left_anti")

    ltypes = dict(lside.dtypes)
    rtypes = dict(rside.dtypes)

    def project(frame: DataFrame, has_left: bool, has_right: bool, tag: str) -> DataFrame:
        out = []
        for s, o in lay.left_out:
            if s in key_idx:
                i = key_idx[s]
                right_key = F.col(_rk(i)).cast(ltypes[_lk(i)])
                if has_left and has_right:
                    # The merged key, as pandas fills it; reading both sides also keeps
                    # the pairs' exchange identical to the anti joins' (shared shuffle).
                    src = F.coalesce(F.col(_lk(i)), right_key)
                else:
                    src = F.col(_lk(i)) if has_left else right_key
                out.append(src.alias(o))
            else:
                out.append((F.col(o) if has_left else F.lit(None).cast(ltypes[o])).alias(o))
        for _, o in lay.right_out:
            out.append((F.col(o) if has_right else F.lit(None).cast(rtypes[o])).alias(o))
        out.append(F.lit(tag).alias(INDICATOR))
        return frame.select(out)

    result = (project(pairs, True, True, BOTH)
              .unionByName(project(lonly, True, False, LEFT_ONLY))
              .unionByName(project(ronly, False, True, RIGHT_ONLY)))
    return result, lay
