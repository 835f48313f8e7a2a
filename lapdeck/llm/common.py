"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.session import scratch_path

# A word is a run of anything but the six ASCII blanks (fixed by the operators' contracts).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files that outlive any executor, and leaves a plain scan, whose
    shuffled partitions AQE can split when they are skewed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def base32_of_hex(hex160: Column) -> Column:
    """RFC 4648 base32 of 40 hex digits: five hex digits are four base32 digits."""
    groups = [F.lpad(F.conv(F.substring(hex160, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def salted_min(rows: DataFrame, key: str, order: list[str], spread_by: str, salts: int = 128) -> DataFrame:
    """Attach to every row the struct ``first`` of its key's smallest ``order`` columns and the key's row count ``n_same``.

    A key may hold a third of all rows.  Rows are first grouped by (key, salt), then by key; the
    key's facts go back only to the salts it was seen with, so there are never more facts than
    rows, and no join task gets more than its share of the hottest key.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    part = salted.groupBy(key, "__salt").agg(F.min(F.struct(*order)).alias("__first"), F.count("*").alias("__n"))
    facts = part.groupBy(key).agg(F.min("__first").alias("first"), F.sum("__n").alias("n_same"),
                                  F.collect_list("__salt").alias("__salts"))
    facts = facts.withColumn("__salt", F.explode("__salts")).drop("__salts")
    return salted.join(facts, [key, "__salt"]).drop("__salt")


def smallest_hashes(df: DataFrame, at: Column, n: int, *ties: str) -> DataFrame:
    """About the ``n`` rows of smallest 64-bit hash ``at``, never more: a bounded, repeatable sample.

    A bound on the hash keeps all but about 1.5 n rows where they are, so that only those are
    sorted, however many partitions there are.
    """
    rows = df.count()
    edge = 2**63 - 1 if rows <= 2 * n else int(2**64 * (1.5 * n / rows)) - 2**63
    return df.filter(at <= F.lit(edge)).orderBy(at, *ties).limit(n)


def small_batches(spark, rows: int = 1_000, size: int = 4 << 20) -> None:
    """Send at most ``rows`` texts and about ``size`` bytes to a Python worker at once, so that very long texts fit in its memory.

    A setting of the session, which stays: results are read after the operator has returned, so it cannot be put back there.
    A smaller setting of the user's is left as it is.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(key, None) or ""
    if not given.rstrip("b").isdigit() or not 0 < int(given.rstrip("b")) <= size:
        spark.conf.set(key, str(size))
