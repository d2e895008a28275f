"""Column types of text, worked out over all rows by a lattice.

The lattice of types, narrowest first::

    nothing < boolean                       < text
    nothing < whole number < double         < text
    nothing < date < timestamp              < text

Each cell is in one place of it, and a column's type is the join of its cells'
places. Joins may be taken in any order, so each type is one flag, "every cell
fits", and all flags of all columns are one aggregate: partial in each task, one
row in the end. The scan reads the text once.

What a cell is:

* a whole number has an optional sign, no leading zero and fits 64 bits; text such as
  ``00123`` or ``+49`` is an id, not a number, and makes its column text, as it
  could not be written back;
* a double is a decimal number with a point or an exponent, likewise without a leading
  zero before other digits, or a whole number; one beyond 64 bits is text;
* booleans are true and false in any case; dates are ``yyyy-MM-dd``; timestamps add a
  time of day;
* nulls fit everywhere. A column of nothing else is text.

Declared keys are text whatever they hold: a key that happens to be numeric on one
side would not meet the other side's text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = r"^-?(0|[1-9][0-9]{0,18})$"
_DECIMAL = r"^-?(0|[1-9][0-9]*)?(\.[0-9]+|\.)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


def _whole(cell: Column) -> Column:
    return cell.rlike(_WHOLE) & cell.try_cast("bigint").isNotNull()


def _double(cell: Column) -> Column:
    # a whole number beyond 64 bits would lose digits
    return _whole(cell) | (cell.rlike(_DECIMAL) & cell.rlike("[.eE]") & cell.try_cast("double").isNotNull())


def _date(cell: Column) -> Column:
    return cell.rlike(_DATE) & cell.try_cast("date").isNotNull()


def _timestamp(cell: Column) -> Column:
    return _date(cell) | (cell.rlike(_TIME) & cell.try_cast("timestamp_ntz").isNotNull())


#: In the order in which a column's type is chosen: the first that every cell fits.
_LADDER = (
    (T.BooleanType(), lambda c: F.lower(c).isin("true", "false")),
    (T.LongType(), _whole),
    (T.DoubleType(), _double),
    (T.DateType(), _date),
    (T.TimestampNTZType(), _timestamp),
)


def type_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for each column and type whether all cells fit, and whether there is a cell at all."""
    out = []
    for i, c in enumerate(columns):
        cell = F.col(f"`{c}`")
        out.append((F.count(cell) > 0).alias(f"some{i}"))
        out += [F.coalesce(F.bool_and(F.when(cell.isNotNull(), fits(cell))), F.lit(True)).alias(f"fits{i}_{k}") for k, (_, fits) in enumerate(_LADDER)]
    return df.agg(*out)


def infer_types(df: DataFrame, keys: Sequence[str] = ()) -> T.StructType:
    """The schema of a frame of text columns; columns that are no text keep their types."""
    open_columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in keys]
    found = {}
    if open_columns:
        flags = type_flags(df, open_columns).first()
        for i, c in enumerate(open_columns):
            fitting = [dtype for k, (dtype, _) in enumerate(_LADDER) if flags[f"fits{i}_{k}"]]
            found[c] = fitting[0] if flags[f"some{i}"] and fitting else T.StringType()
    return T.StructType([T.StructField(f.name, found.get(f.name, f.dataType)) for f in df.schema])
