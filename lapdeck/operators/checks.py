"""Dataset-level quality checks (K1-K6).

Every check is an aggregate expression; :func:`run_checks` evaluates all
scalar checks of a dataset in ONE pass (one ``agg``), key-duplicate checks
in one extra ``groupBy`` each, and returns one row per check:

    check string, severity string, measured double, limit string, ok boolean
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_SCHEMA = "check string, severity string, measured double, limit string, ok boolean"


@dataclass(frozen=True)
class Check:
    kind: str                 # rowcount | duplicates | required | nulls | range
    name: str
    columns: tuple[str, ...] = field(default_factory=tuple)
    lo: float | None = None
    hi: float | None = None
    severity: str = "error"


def rowcount(name: str, lo: float | None, hi: float | None, severity="error") -> Check:
    return Check("rowcount", name, (), lo, hi, severity)


def rows_per_key(name: str, key: str, lo_per: float, hi_per: float,
                 severity="warning") -> Check:
    """K1 relative to a key count: rows within [lo_per * n, hi_per * n] where
    n = number of distinct ``key`` values (e.g. 15..25 drivers per race)."""
    return Check("rows_per_key", name, (key,), lo_per, hi_per, severity)


def duplicates(name: str, keys, severity="error") -> Check:
    return Check("duplicates", name, tuple(keys), None, None, severity)


def required(name: str, cols, severity="error") -> Check:
    return Check("required", name, tuple(cols), None, None, severity)


def nulls(name: str, col: str, max_share: float, severity="warning") -> Check:
    return Check("nulls", name, (col,), None, max_share, severity)


def in_range(name: str, col: str, lo: float | None, hi: float | None,
             severity="warning") -> Check:
    return Check("range", name, (col,), lo, hi, severity)


def _lim(lo, hi) -> str:
    return f"[{'' if lo is None else lo}, {'' if hi is None else hi}]"


def _scalar(c: Check, present: set[str], floats: set[str]) -> tuple[Column, Column, Column] | None:
    """(measured, ok, limit) for checks that are a plain aggregate."""
    if c.kind == "rows_per_key":
        if c.columns[0] not in present:
            return None
        m = F.count(F.lit(1)).cast("double")
        n = F.count_distinct(F.col(c.columns[0]))
        lo, hi = n * c.lo, n * c.hi
        return m, (m >= lo) & (m <= hi), F.format_string("[%s, %s]", lo.cast("bigint"),
                                                        hi.cast("bigint"))
    if c.kind == "rowcount":
        m = F.count(F.lit(1)).cast("double")
        ok = F.lit(True)
        if c.lo is not None:
            ok = ok & (m >= c.lo)
        if c.hi is not None:
            ok = ok & (m <= c.hi)
        return m, ok, F.lit(_lim(c.lo, c.hi))
    if c.kind == "nulls":
        col = c.columns[0]
        if col not in present:
            return None
        x = F.col(col)
        # NaN counts as missing (S2) for float columns
        isnull = x.isNull() | (F.isnan(x) if col in floats else F.lit(False))
        m = F.coalesce(F.avg(isnull.cast("double")), F.lit(0.0))
        # strictly greater than the threshold fails
        return m, m <= c.hi, F.lit(f"<= {c.hi}")
    if c.kind == "range":
        col = c.columns[0]
        if col not in present:
            return None
        # NaN is missing (S2), and missing values are not counted
        x = F.when(~F.isnan(col), F.col(col)) if col in floats else F.col(col)
        out = F.lit(False)
        if c.lo is not None:
            out = out | (x < c.lo)
        if c.hi is not None:
            out = out | (x > c.hi)
        m = F.count_if(F.coalesce(out, F.lit(False))).cast("double")
        return m, m == 0, F.lit(_lim(c.lo, c.hi))
    return None


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """K6: all checks of one dataset as one table."""
    from pyspark.sql import types as T
    present = set(df.columns)
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    spark = df.sparkSession
    parts: list[DataFrame] = []

    scalars = []
    for i, c in enumerate(checks):
        s = _scalar(c, present, floats)
        if s is not None:
            scalars.append((i, c, s))
    if scalars:
        aggs = []
        for i, c, (m, ok, lim) in scalars:
            aggs += [m.alias(f"m{i}"), ok.alias(f"ok{i}"), lim.alias(f"l{i}")]
        wide = df.agg(*aggs)
        rows = F.array(*[F.struct(F.lit(c.name).alias("check"),
                                  F.lit(c.severity).alias("severity"),
                                  F.col(f"m{i}").alias("measured"),
                                  F.col(f"l{i}").alias("limit"),
                                  F.col(f"ok{i}").alias("ok"))
                         for i, c, _s in scalars])
        parts.append(wide.select(F.inline(rows)))

    for c in checks:
        if c.kind == "duplicates":
            parts.append(duplicate_count(df, list(c.columns))
                         .select(F.lit(c.name).alias("check"),
                                 F.lit(c.severity).alias("severity"),
                                 F.col("duplicate_rows").cast("double").alias("measured"),
                                 F.lit("0").alias("limit"),
                                 (F.col("duplicate_rows") == 0).alias("ok")))
        elif c.kind == "required":
            missing = [x for x in c.columns if x not in present]
            parts.append(spark.createDataFrame(
                [(c.name, c.severity, float(len(missing)),
                  "missing: " + ",".join(missing), not missing)], CHECK_SCHEMA))
        elif c.kind in ("nulls", "range", "rows_per_key") and c.columns[0] not in present:
            parts.append(spark.createDataFrame(
                [(c.name, c.severity, None, f"column {c.columns[0]} absent", False)],
                CHECK_SCHEMA))
    if not parts:
        return spark.createDataFrame([], CHECK_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """K2: number of rows whose key occurs more than once (all copies counted).
    The groupBy pre-aggregates map-side, so a hot key costs one row per task."""
    return (df.groupBy(*keys).count()
            .filter(F.col("count") > 1)
            .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("duplicate_rows")))


def assert_checks(checks_df: DataFrame, severity: str = "error") -> None:
    """Raise when a check of the given severity failed (small result: one row
    per check)."""
    bad = checks_df.filter((F.col("severity") == severity) & ~F.col("ok")).collect()
    if bad:
        raise ValueError("failed checks: " + ", ".join(r["check"] for r in bad))
