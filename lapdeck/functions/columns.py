"""Column-level helpers.  Every function returns a ``Column``; nothing here
triggers a job, so all of it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- S2
def nan_to_null(c: ColumnOrName) -> Column:
    """NaN -> NULL, so aggregates and comparisons follow missing-value rules
    (Spark treats NaN as a value larger than any number)."""
    col = _c(c)
    return F.when(~F.isnan(col), col)


def normalise_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`nan_to_null` to every float/double column (or the given
    ones).  Done once at the scan so no later operator sees a NaN."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (columns or floats) if c in floats]
    if not targets:
        return df
    return df.withColumns({c: nan_to_null(c) for c in targets})


# -------------------------------------------------------------------- P11
_PANDAS_DURATION = r"^\s*(-?\d+) days? "


def duration_seconds(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Duration -> seconds as double.

    * numeric columns pass through (NaN -> NULL);
    * ``interval day to second`` goes through decimal (a direct cast to
      double is rejected by the analyzer);
    * strings in pandas' text form (``0 days 01:20:27.511000``) or plain
      numbers are parsed; anything unparsable becomes NULL.
    """
    col = _c(c)
    if isinstance(dtype, T.DayTimeIntervalType):
        return col.cast("decimal(24,6)").cast("double")
    if isinstance(dtype, (T.NumericType,)):
        return nan_to_null(col.cast("double"))
    if isinstance(dtype, T.StringType):
        as_interval = F.regexp_replace(col, _PANDAS_DURATION, "$1 ").try_cast(
            "interval day to second")
        return F.coalesce(as_interval.cast("decimal(24,6)").cast("double"),
                          col.try_cast("double"))
    # unknown type: best effort numeric
    return nan_to_null(col.try_cast("double"))


def duration_text_seconds(c: ColumnOrName) -> Column:
    """Duration text -> seconds: ``[-]d days [+]hh:mm:ss[.f]`` (the days alone may be negative), ``[-]hh:mm:ss[.f]``, or a
    plain number of seconds; anything else is NULL."""
    col = F.trim(_c(c))
    rx = r"^(?:(-?\d+) days?(?: |$))?([+-]?)(?:(\d+):(\d+):(\d+(?:\.\d+)?))?$"

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(col, rx, i).try_cast("double"), F.lit(0.0))

    clock = part(3) * 3600 + part(4) * 60 + part(5)
    signed = F.when(F.regexp_extract(col, rx, 2) == "-", -clock).otherwise(clock)
    return F.when(F.regexp_like(col, F.lit(rx)) & (col != "") & (F.regexp_extract(col, rx, 0) != "-"), part(1) * 86400 + signed).otherwise(
        nan_to_null(col.try_cast("double")))


# --------------------------------------------------------------------- S6
def event_key(c: ColumnOrName) -> Column:
    """Storage key of an event name: lower case, spaces -> underscores."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))


# -------------------------------------------------------------------- V15
def upper_in_domain(c: ColumnOrName, domain: Sequence[str] | None = None) -> Column:
    """Upper-case a value; with a domain, only when the upper form is in it
    (unknown values are kept as they are)."""
    col = _c(c)
    up = F.upper(col)
    if domain is None:
        return up
    return F.when(up.isin(list(domain)), up).otherwise(col)


# --------------------------------------------------------------------- C9
def race_id(year: ColumnOrName, rnd: ColumnOrName) -> Column:
    """``{year}_R{round:02d}``; NULL when either part is NULL (only that row)."""
    y, r = _c(year), _c(rnd)
    return F.when(y.isNotNull() & r.isNotNull(),
                  F.format_string("%d_R%02d", y.cast("int"), r.cast("int")))


# ------------------------------------------------------------------ order
def struct_order(cols: Sequence[ColumnOrName]) -> Column:
    """A single sortable value for a multi-column order (lexicographic), used
    as the ordering argument of ``min_by`` / ``max_by``."""
    cols = [_c(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.struct(*cols)
