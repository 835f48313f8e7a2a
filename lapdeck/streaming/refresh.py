"""Incremental refresh on file arrival.

The reference polls a bucket every 300 s, compares file counts and rebuilds
everything.  Here a Structured Streaming file source tracks which files are
new (its checkpoint is the cursor; a failed batch is retried from the same
cursor), and each micro-batch recomputes only the partitions its files
touch:

    new files -> touched partition keys -> semi-join with the whole landed
    table -> rebuild -> dynamic partition overwrite of those partitions

Rewriting a partition from the full landed data is idempotent, so a batch
replayed after an executor or driver loss gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lapdeck.operators.catalog import CRITICAL_TYPES, DATA_TYPES, completeness, parse_manifest
from lapdeck.operators.changes import manifest_diff
from lapdeck.sources.manifest import list_files
from lapdeck.sources.sinks import delete_partition


#: Touched partitions that are named in the scan's filter; beyond that they are joined.
NAMED = 1_000


def touched_rows(full: DataFrame, touched: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """The rows of ``full`` in the touched partitions.  Up to ``NAMED`` partitions become a filter on the partition columns, so
    that only their folders are read; more than that (a first run over everything) are joined.  Same rows either way."""
    named = touched.limit(NAMED + 1).collect()  # at most NAMED + 1 keys
    if len(named) > NAMED:
        return full.join(touched, list(partition_cols), "left_semi")
    one = [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_cols]) for r in named]
    return full.filter(reduce(or_, one)) if one else full.limit(0)


def refresh_batch(spark: SparkSession, batch: DataFrame, landing: str, schema: T.StructType,
                  target: str, partition_cols: Sequence[str],
                  rebuild: Callable[[DataFrame], DataFrame]) -> None:
    """One micro-batch: rebuild the partitions the batch touched."""
    touched = batch.select(*partition_cols).distinct()
    affected = touched_rows(spark.read.schema(schema).parquet(landing), touched, partition_cols)
    (rebuild(affected).hint("rebalance", *partition_cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(target))


def start_refresh(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                  checkpoint: str, partition_cols: Sequence[str],
                  rebuild: Callable[[DataFrame], DataFrame], available_now: bool = True,
                  interval: str = "300 seconds",
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the refresh stream.  ``available_now`` processes everything that
    has landed and stops (scheduled runs, tests); otherwise it polls every
    ``interval``.  ``checkpoint`` must be on shared storage."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing)

    def _batch(df: DataFrame, _epoch: int) -> None:
        refresh_batch(spark, df, landing, schema, target, partition_cols, rebuild)

    w = (stream.writeStream.foreachBatch(_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_available(spark: SparkSession, **kwargs) -> None:
    """Process all landed files now and wait for the stream to finish."""
    q = start_refresh(spark, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def start_catalog_refresh(spark: SparkSession, root: str, out: str, checkpoint: str,
                          glob: str = "*/*/*/*", as_of: str | None = None,
                          available_now: bool = True,
                          interval: str = "300 seconds") -> StreamingQuery:
    """T3 for landed sessions: whenever new Parquet objects appear under
    ``root`` (matched by ``glob``), rebuild the catalog and overwrite it at
    ``out``.  The file source's checkpoint is the cursor (the first run sees
    every existing file, later runs only new ones); the catalog is a small
    aggregate over the manifest, so a full rewrite is the idempotent unit.
    Only file metadata is read by the stream: the content column is dropped
    before anything else touches it."""
    from lapdeck.plans.motorsport import catalog_job
    stream = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.parquet")
              .load(f"{root.rstrip('/')}/{glob}")
              .select("path", "length", "modificationTime"))

    def _batch(df: DataFrame, _epoch: int) -> None:
        if df.isEmpty():
            return
        catalog_job(spark, root, as_of=as_of, out=out)

    w = stream.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def start_catalog_state(spark: SparkSession, root: str, target: str, checkpoint: str, glob: str = "*/*/*/*", available_now: bool = True,
                        interval: str = "300 seconds", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """T3 as keyed state: which tables each session has, kept by a streaming aggregate over the files' names.

    The state store holds one row per (year, event, session): a flag per table, the number of files and their bytes.  A micro-batch gives
    the rows of the sessions that its files touch (update mode), and only those sessions' folders of ``target`` are written; nothing
    is listed or built again.  State and cursor lie in ``checkpoint``; a batch that is repeated writes the same rows to the same folders.
    File bodies are not read.  Files that are deleted or rewritten in place are for :func:`refresh_changes`.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = parse_manifest(reader.load(f"{root.rstrip('/')}/{glob}").select("path", "length", "modificationTime"), root)
    keyed = files.select(F.col("year_part").try_cast("int").alias("year"), "event", "session", "data_type", "length", "modificationTime")
    keyed = keyed.filter(F.col("year").isNotNull() & F.col("session").isNotNull())
    has = [F.max(F.col("data_type") == t).alias(f"has_{t}") for t in DATA_TYPES]
    state = keyed.groupBy("year", "event", "session").agg(*has, F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("latest"))

    def _batch(touched: DataFrame, _epoch: int) -> None:
        rows = completeness(touched, DATA_TYPES, CRITICAL_TYPES)
        (rows.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "event", "session").parquet(target))

    w = state.writeStream.outputMode("update").foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def refresh_changes(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                    partition_cols: Sequence[str], rebuild: Callable[[DataFrame], DataFrame],
                    snapshots: str) -> dict[str, int]:
    """T3 by manifest: rebuild the partitions whose files are new, changed or gone since the last run.

    ``landing`` is partitioned by folder (``col=value``).  The manifest of the last run is kept at ``snapshots`` (append-only, on
    shared storage) and is written last, so a run that fails is repeated whole.  Partitions that
    have lost all their files are removed from ``target``.  Returns counts of what was done.
    """
    files = list_files(spark, landing, glob="part-*")
    parts = [F.url_decode(F.regexp_extract("path", f"/{c}=([^/]+)", 1)).cast(schema[c].dataType).alias(c) for c in partition_cols]
    try:
        kept = spark.read.schema("path string, length long, modificationTime timestamp, version int").parquet(snapshots)
        last = kept.agg(F.max("version")).first()[0]
        old = kept.filter(F.col("version") == last).drop("version")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last, old = 0, files.limit(0)
    changed = manifest_diff(old, files).filter("change <> 'unchanged'")
    touched = changed.select(*parts).distinct()
    there = files.select(*parts).distinct()
    done = {"touched": touched.count(), "removed": 0}
    if done["touched"]:
        affected = touched_rows(spark.read.schema(schema).parquet(landing), touched, partition_cols)
        (rebuild(affected).hint("rebalance", *partition_cols).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(target))
        for r in touched.join(there, list(partition_cols), "left_anti").toLocalIterator():  # folders to delete
            done["removed"] += delete_partition(spark, target, **{c: r[c] for c in partition_cols})
        files.withColumn("version", F.lit(last + 1)).write.mode("append").parquet(snapshots)
    return done
