"""Scans with gates (S1, S2, S3, S9); objects as they land are read by :mod:`lapdeck.sources.landed`.

* :func:`file_facts` reads Parquet *footers only*, in parallel: the list of
  paths is a DataFrame and each task opens its files' footers with pyarrow
  (``mapInPandas``), so a million files never pass through one process.
* :func:`gate_files` turns footer facts into (ok, reason) per file -- reasons
  ``missing`` (no such file), ``unreadable``, ``empty`` (0 rows),
  ``missing columns``.
* :func:`read_gated` keeps the rows of the files that passed (semi-join on
  the file path), with an explicit schema and NaN -> NULL normalisation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapdeck.functions.columns import normalise_missing

FACTS_SCHEMA = ("path string, exists boolean, readable boolean, num_rows long, "
                "columns array<string>")


def open_path(path: str):
    """(filesystem, path) to open a file in a task."""
    from urllib.parse import unquote, urlparse

    from pyarrow import fs as pafs
    u = urlparse(path)
    if u.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(u.path) if u.scheme else path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _footer_facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow as pa
    import pyarrow.parquet as pq

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            try:
                filesystem, p = open_path(path)
                with filesystem.open_input_file(p) as fh:
                    md = pq.ParquetFile(fh).metadata
                    rows.append((path, True, True, md.num_rows, list(md.schema.names)))
            except FileNotFoundError:
                rows.append((path, False, False, None, None))
            except pa.ArrowInvalid:  # not Parquet; any other error (credentials, scheme) is raised
                rows.append((path, True, False, None, None))
        yield pd.DataFrame(rows, columns=["path", "exists", "readable", "num_rows", "columns"])


def file_facts(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Footer facts per path (distributed; no file body is read)."""
    return (paths.select(F.col(path_col).alias("path"))
            .mapInPandas(_footer_facts, FACTS_SCHEMA))


def gate_files(facts: DataFrame, required: Sequence[str]) -> DataFrame:
    """S3: ok / reason per file; ``missing_columns`` lists what is absent."""
    req = F.array(*[F.lit(c) for c in required]).cast("array<string>")
    missing_cols = F.array_except(req, F.coalesce("columns", F.array().cast("array<string>")))
    reason = (F.when(~F.col("exists"), F.lit("missing"))
              .when(~F.col("readable"), F.lit("unreadable"))
              .when(F.col("num_rows") == 0, F.lit("empty"))
              .when(F.size(missing_cols) > 0, F.lit("missing columns")))
    return facts.withColumns({"missing_columns": missing_cols, "reason": reason,
                              "ok": reason.isNull()})


def _plain_path(path: Column, decode: bool = False) -> Column:
    """A file path without ``file:`` and, for the scan's URL form, decoded (``+`` is itself there)."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if decode else path
    return F.regexp_replace(plain, "^file:/+", "/")


def read_gated(spark: SparkSession, gated: DataFrame, schema: T.StructType,
               location: str | list[str], key_from_path: bool = True) -> DataFrame:
    """S1 + S2: rows of the files that passed the gate.

    ``location`` (a folder, glob or list of them) is scanned once with the
    explicit schema; rows are kept by a semi-join of their source file path
    against the accepted paths, so the accepted list stays a distributed
    DataFrame (never collected).  Unreadable files are skipped by the scan
    (``ignoreCorruptFiles``) and were already rejected by the gate.
    """
    locs = [location] if isinstance(location, str) else list(location)
    df = (spark.read.schema(schema).option("ignoreCorruptFiles", "true")
          .option("recursiveFileLookup", "true").parquet(*locs)
          .withColumn("source_path", _plain_path(F.col("_metadata.file_path"), decode=True)))
    ok = gated.filter("ok").select(_plain_path(F.col("path")).alias("source_path"))
    kept = df.join(ok, ["source_path"], "left_semi")
    if not key_from_path:
        kept = kept.drop("source_path")
    return normalise_missing(kept)


def read_sessions(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """S9 for the partitioned layout (``data_type=/year=/event=/session=``):
    partition columns come from discovery, filters on them prune folders."""
    return normalise_missing(
        spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/data_type={data_type}"))


def dataset_gate(spark: SparkSession, df: DataFrame | None, required: Sequence[str]) -> DataFrame:
    """S3 for a loaded table (schedule, circuits, session tables): one row
    (ok, reason, missing_columns, rows) with reason ``missing`` (no table),
    ``missing columns`` (checked on the schema, no job) or ``empty``."""
    schema = "ok boolean, reason string, missing_columns array<string>, rows long"
    if df is None:
        return spark.createDataFrame([(False, "missing", [], None)], schema)
    missing = [c for c in required if c not in df.columns]
    if missing:
        return spark.createDataFrame([(False, "missing columns", missing, None)], schema)
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    reason = F.when(F.col("rows") == 0, F.lit("empty"))
    return n.select(reason.isNull().alias("ok"), reason.alias("reason"),
                    F.array().cast("array<string>").alias("missing_columns"), "rows")
