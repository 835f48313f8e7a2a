"""Sinks (S4, S5, S6, S10, S11).

Writes are plain DataFrame writers: Parquet with a codec, CSV with header,
Hive-style partitions ``year=/event=/session=`` and dynamic partition
overwrite, so re-running a session replaces exactly its folders (idempotent
after an executor loss or a retried job).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapdeck.functions.columns import event_key

CODECS = ("snappy", "gzip", "brotli", "zstd", "none", "uncompressed")


def write_parquet(df: DataFrame, path: str, compression: str = "snappy",
                  mode: str = "overwrite", partition_by: Sequence[str] = ()) -> bool:
    """False (nothing written) for an empty frame; else write and True.
    ``isEmpty`` runs a LIMIT 1 job, not a count."""
    if compression not in CODECS:
        raise ValueError(f"unknown codec {compression}")
    if df.isEmpty():
        return False
    if partition_by:
        # REBALANCE: AQE sizes the write tasks per partition value and splits
        # a hot value over several tasks -- neither one task per session
        # (skew) nor one file per session per task (small files)
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        # replace only the partitions present in ``df`` whatever the session
        # default is (static overwrite would wipe every other session)
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return True


def csv_ready(df: DataFrame) -> DataFrame:
    """Intervals -> seconds, arrays -> joined strings (CSV has no such types)."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DayTimeIntervalType):
            cols[f.name] = F.col(f.name).cast("decimal(24,6)").cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            cols[f.name] = F.array_join(F.col(f.name).cast("array<string>"), ",")
    return df.withColumns(cols) if cols else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """CSV with a header."""
    if df.isEmpty():
        return False
    csv_ready(df).write.mode(mode).option("header", True).csv(path)
    return True


def with_session_keys(df: DataFrame, year: str = "year", event: str = "EventName",
                      session: str = "SessionName") -> DataFrame:
    """S6 key rule: event folder = lower case, spaces -> underscores."""
    return df.withColumns({"year": F.col(year).cast("int"),
                           "event": event_key(event), "session": F.col(session)})


def write_sessions(tables: dict[str, DataFrame | None], root: str,
                   compression: str = "snappy") -> dict[str, bool]:
    """S6 + S11: land each table under ``root/data_type=<t>/year=/event=/
    session=`` with dynamic partition overwrite (only touched sessions are
    replaced).  Returns a written flag per table; absent / empty -> False."""
    out = {}
    for name, df in tables.items():
        if df is None:
            out[name] = False
            continue
        out[name] = write_parquet(df, f"{root.rstrip('/')}/data_type={name}", compression,
                                  mode="overwrite", partition_by=("year", "event", "session"))
    return out


def write_sample(df: DataFrame, path: str, order: Sequence[str], n: int = 100) -> bool:
    """First ``n`` rows in key order as CSV (global top-n)."""
    return write_csv(df.orderBy(*order).limit(n).coalesce(1), path)


def delete_partition(spark: SparkSession, root: str, **keys: str | int) -> bool:
    """Delete one season / event / session folder through the Hadoop
    FileSystem API (works for any cluster filesystem)."""
    sub = "/".join(f"{k}={v}" for k, v in keys.items())
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{sub}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def append_ledger(attempts: DataFrame, path: str) -> DataFrame:
    """Append run attempts to the ledger at ``path`` and return the whole ledger.  Rows are never rewritten;
    columns that ``attempts`` lacks are null."""
    from lapdeck.operators.planning import LEDGER_SCHEMA
    fields = [c.split() for c in LEDGER_SCHEMA.split(", ")]
    row = [F.col(n).cast(t).alias(n) if n in attempts.columns else F.lit(None).cast(t).alias(n) for n, t in fields]
    attempts.select(*row).write.mode("append").parquet(path)
    return attempts.sparkSession.read.schema(LEDGER_SCHEMA).parquet(path)


def write_objects(df: DataFrame, root: str, data_type: str, keys: Sequence[str] = ("year", "event", "session"), fmt: str = "parquet",
                  shape: Callable[[DataFrame], DataFrame] = lambda dealt: dealt) -> int:
    """Land ``df`` as objects ``root/<year>/<event>/<session>/<type>.parquet``, one per value of ``keys``, by one write.

    All sessions are written at once, partitioned, to a hidden folder beside them (a hot session over several tasks and part files), and
    each session's folder then takes the place of its old one.  A run that fails before leaves every object as it was; one that
    fails between is repeated whole.  Objects of sessions without rows in ``df`` stay.  Returns the number of objects.
    ``shape`` makes the object's columns of those of ``df`` after these were dealt to the sessions and sorted: shuffle and sort carry the columns
    of ``df`` that it uses, not the wider ones that it makes.  It keeps ``keys``.
    """
    spark = df.sparkSession
    stage = f"{root.rstrip('/')}/_landing-{uuid.uuid4().hex}"
    shape(df.hint("rebalance", *keys).sortWithinPartitions(*keys)).write.partitionBy(*keys).format(fmt).save(stage)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(at(stage + "/*=*" * len(keys))) or []
    for status in found:  # names only: the rows stay where they were written
        path = status.getPath().toString()
        values = [unquote(part.split("=", 1)[1]) for part in path.rsplit("/", len(keys))[1:]]
        target = at("/".join([root.rstrip("/"), *values, f"{data_type}.parquet"]))
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(status.getPath(), target):
            raise OSError(f"cannot move {path} to {target.toString()}")
    fs.delete(at(stage), True)
    return len(found)
