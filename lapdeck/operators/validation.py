"""Row validation with rule sets as data.

A rule is (name, severity, predicate builder).  The builder receives the set
of columns present and returns a boolean ``Column`` that is TRUE when the row
passes; NULL counts as a failure for required fields.  :func:`validate` adds
two ``array<string>`` columns in a single projection (no UDF, no per-row
Python): ``errors`` (hard rules) and ``warnings`` (soft rules).  Rows are
never modified by validation; value normalisation is a separate operator
(:func:`normalise_values`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.functions.columns import upper_in_domain

Predicate = Callable[[set[str]], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Predicate
    severity: str = "error"      # error | warning
    column: str | None = None    # shown with its value in the message


# ----------------------------------------------------------- rule builders
def _val(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def required(c: str) -> Rule:
    return Rule(f"{c} is required", lambda p: F.col(c).isNotNull() if c in p else F.lit(False), column=c)


def required_all(cols: Sequence[str]) -> list[Rule]:
    return [required(c) for c in cols]


def in_range(c: str, lo: float | None, hi: float | None, optional: bool = False,
             integral: bool = False) -> Rule:
    """lo <= c <= hi; ``optional`` lets NULL (and an absent column) pass."""
    def pred(p: set[str]) -> Column:
        if c not in p:
            return F.lit(optional)
        x = F.col(c)
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (x >= lo)
        if hi is not None:
            ok = ok & (x <= hi)
        if integral:
            ok = ok & (x == F.floor(x))
        return (x.isNull() | ok) if optional else (x.isNotNull() & ok)
    kind = "optional " if optional else ""
    return Rule(f"{c} {kind}in [{lo}, {hi}]{' integral' if integral else ''}", pred, column=c)


def length_eq(c: str, n: int) -> Rule:
    return Rule(f"{c} length {n}",
                lambda p: (F.length(F.col(c)) == n) if c in p else F.lit(False), column=c)


def int_string_range(c: str, lo: int, hi: int) -> Rule:
    """String that parses as an integer within [lo, hi]."""
    return Rule(f"{c} integer in [{lo}, {hi}]",
                lambda p: F.col(c).try_cast("int").between(lo, hi) if c in p else F.lit(False),
                column=c)


def in_domain(c: str, domain: Sequence[str], severity: str = "warning",
              optional: bool = True) -> Rule:
    def pred(p: set[str]) -> Column:
        if c not in p:
            return F.lit(optional)
        x = F.col(c)
        ok = x.isin(list(domain))
        return (x.isNull() | ok) if optional else ok
    return Rule(f"{c} in domain", pred, severity, column=c)


def custom(name: str, pred: Predicate, severity: str = "error",
           column: str | None = None) -> Rule:
    return Rule(name, pred, severity, column)


# ---------------------------------------------------------------- operators
def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """V1 + V14: add ``errors`` and ``warnings`` arrays (one projection)."""
    present = set(df.columns)

    def msgs(sev: str) -> Column:
        items = []
        for r in rules:
            if r.severity != sev:
                continue
            # a hard rule must hold; a soft one is only broken by a value, never by NULL
            ok = F.coalesce(r.predicate(present), F.lit(sev == "warning"))
            text = (F.concat(F.lit(r.name + ": "), _val(r.column))
                    if r.column and r.column in present else F.lit(r.name))
            items.append(F.when(~ok, text))
        if not items:
            return F.array().cast("array<string>")
        return F.filter(F.array(*items), lambda x: x.isNotNull())

    return df.withColumns({"errors": msgs("error"), "warnings": msgs("warning")})


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """V1: (valid rows unchanged, invalid rows + ``errors``).  Both sides read
    the same lazily-defined input; persist it first if the source
    is expensive and both sides are consumed.  Rows are told apart by the hard rules
    alone: messages are made only for invalid rows, and only if they are read."""
    present = set(df.columns)
    hard = [F.coalesce(r.predicate(present), F.lit(False)) for r in rules if r.severity == "error"]
    passed = reduce(lambda a, b: a & b, hard, F.lit(True))
    valid = df.filter(passed).drop("errors", "warnings")
    invalid = validate(df.filter(~passed), rules).drop("warnings")
    return valid, invalid


def summary(validated: DataFrame) -> DataFrame:
    """V3: total, valid, invalid, validation_rate (0-100; 0 for empty)."""
    bad = F.size("errors") > 0
    s = validated.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(~bad).alias("valid_rows"),
                      F.count_if(bad).alias("invalid_rows"))
    rate = F.coalesce(F.try_divide(F.col("valid_rows") * 100.0, F.col("total_rows")),
                      F.lit(0.0))
    return s.withColumn("validation_rate", rate)


def first_errors(validated: DataFrame, order: Sequence[str], n: int = 10,
                 label: str | None = None) -> DataFrame:
    """V3: the first ``n`` error messages in row order ("<row>: <reason>")."""
    lab = F.col(label).cast("string") if label else F.concat_ws(
        ",", *[F.col(c).cast("string") for c in order])
    e = (validated.filter(F.size("errors") > 0)
         .select(*order, lab.alias("__row"), F.array_join("errors", "; ").alias("msg")))
    return (e.orderBy(*order).limit(n)
            .select(F.concat(F.lit("Row "), F.col("__row"), F.lit(": "), F.col("msg"))
                    .alias("error")))


def fail_fast(validated: DataFrame, order: Sequence[str]) -> None:
    """V2: raise ``ValueError`` with the error count and the first 5 messages.
    Only the count and five strings reach the driver."""
    n = validated.filter(F.size("errors") > 0).count()
    if n:
        first = [r["error"] for r in first_errors(validated, order, 5).collect()]
        raise ValueError(f"Validation failed with {n} errors:\n" + "\n".join(first))


def normalise_values(df: DataFrame, upper_cols: Sequence[str] = (),
                     domain_upper: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Upper-case codes; for ``domain_upper`` only when the upper form is
    a known value (others are kept as they are)."""
    cols = {c: F.upper(F.col(c)) for c in upper_cols if c in df.columns}
    for c, dom in (domain_upper or {}).items():
        if c in df.columns:
            cols[c] = upper_in_domain(c, dom)
    return df.withColumns(cols) if cols else df


def raise_on_invalid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """V2 inside the plan: the returned DataFrame fails at execution with the
    first invalid row's reasons (``raise_error``), without a separate count
    job -- usable in streaming queries where a driver-side check is not."""
    v = validate(df, rules)
    boom = F.when(F.size("errors") > 0,
                  F.raise_error(F.concat(F.lit("Validation failed: "),
                                         F.array_join("errors", "; "))))
    # the filter keeps every valid row; evaluating it on an invalid row raises
    return v.filter(boom.isNull()).drop("errors", "warnings")
