"""Session files as they land: ``root/<year>/<event>/<session>/<type>.parquet``.

A landed object is one session's table, written by any version of the writer: nanosecond or microsecond timestamps,
durations, text, a column more or less, now and then a broken file.  One schema for all files cannot be declared to a Parquet
scan, so the files are grouped by their own:

1. Tasks read the files' footers (:func:`landed_footers`): rows, and the physical kind of every column.  The gate
   (:func:`landed_gate`) needs nothing else, and bad files never reach a scan.
2. Files whose declared columns have the same kinds are one group (as many as there are versions of the writer), and each
   group is one plain ``spark.read.schema(...).parquet(...)``: column pruning and filters reach it, and a filter on year, event
   or session prunes its files, as they come from the file's path.  Units and types are mapped by expressions.
3. The groups are united.  A group with a kind that has no expression (nested or binary columns) is decoded in tasks.

The paths go through the driver, as those of any Spark file scan do.  Datasets that lapdeck itself writes (``write_sessions``)
have one schema and are read with :func:`lapdeck.sources.readers.read_sessions`.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.functions.columns import duration_text_seconds, nan_to_null
from lapdeck.sources.readers import open_path

KEYS = "year int, event string, session string"

# Columns and kinds of the landed tables ("seconds" are durations).
_STAMP = {"EventName": "string", "SessionName": "string", "SessionDate": "timestamp"}
SCHEMAS: dict[str, dict[str, str]] = {
    "session_info": {"event_name": "string", "location": "string", "country": "string", "session_name": "string",
                     "session_date": "timestamp", "total_laps": "int", "event_format": "string", "round_number": "int",
                     "official_event_name": "string"},
    "results": {"DriverNumber": "string", "BroadcastName": "string", "Abbreviation": "string", "DriverId": "string",
                "TeamName": "string", "TeamColor": "string", "TeamId": "string", "FullName": "string", "Position": "double",
                "ClassifiedPosition": "string", "GridPosition": "double", "Q1": "seconds", "Q2": "seconds", "Q3": "seconds",
                "Time": "seconds", "Status": "string", "Points": "double", "Laps": "double"},
    "laps": {"Time": "seconds", "Driver": "string", "DriverNumber": "string", "LapTime": "seconds", "LapNumber": "double",
             "Stint": "double", "PitOutTime": "seconds", "PitInTime": "seconds", "Sector1Time": "seconds",
             "Sector2Time": "seconds", "Sector3Time": "seconds", "Compound": "string", "TyreLife": "double",
             "FreshTyre": "boolean", "Team": "string", "LapStartTime": "seconds", "TrackStatus": "string",
             "Position": "double", "Deleted": "boolean", "IsAccurate": "boolean", "LapTimeSeconds": "double"},
    "weather": {"Time": "seconds", "AirTemp": "double", "Humidity": "double", "Pressure": "double", "Rainfall": "boolean",
                "TrackTemp": "double", "WindDirection": "int", "WindSpeed": "double", **_STAMP},
    "race_control_messages": {"Time": "timestamp", "Category": "string", "Message": "string", "Lap": "int", **_STAMP},
    "session_status": {"Time": "seconds", "Status": "string", **_STAMP},
    "track_status": {"Time": "seconds", "Status": "string", "Message": "string", **_STAMP},
}
# Columns without which the jobs cannot use a file.
REQUIRED: dict[str, tuple[str, ...]] = {
    "session_info": ("session_date", "round_number"), "results": ("DriverNumber", "Position", "Status"),
    "laps": ("DriverNumber", "LapNumber"), "weather": ("Time", "AirTemp", "TrackTemp"),
    "race_control_messages": ("Time", "Message"), "session_status": ("Time", "Status"), "track_status": ("Time", "Status"),
}
# The same for the tables of a season, ``root/<year>/<type>.parquet``.
SEASON_REQUIRED: dict[str, tuple[str, ...]] = {
    "season_schedule": ("EventName", "Location", "Country", "EventFormat", "Season", "RoundNumber", "EventDate"),
    "circuits": ("circuitId", "circuitName", "locality", "country"),
}
_SPARK = {"string": "string", "double": "double", "int": "int", "boolean": "boolean", "seconds": "double", "timestamp": "timestamp_ntz"}
_ARROW = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_(), "seconds": pa.float64(),
          "timestamp": pa.timestamp("us")}
_PER_SECOND = {"s": 1, "ms": 1e3, "us": 1e6, "ns": 1e9}


def _seconds(col: pa.ChunkedArray) -> pd.Series:
    if pa.types.is_duration(col.type):
        return col.cast(pa.int64()).to_pandas() / _PER_SECOND[col.type.unit]
    if pa.types.is_integer(col.type):  # a bare INT64: nanoseconds, as the writer stores durations
        return col.to_pandas() / 1e9
    if pa.types.is_floating(col.type):
        return col.to_pandas()
    return pd.to_timedelta(col.to_pandas(), errors="coerce").dt.total_seconds()


def _timestamp(col: pa.ChunkedArray) -> pd.Series:
    s = col.to_pandas()
    s = pd.to_datetime(s, errors="coerce", utc=True) if not pa.types.is_integer(col.type) else pd.to_datetime(s, unit="ns", utc=True)
    return s.dt.tz_localize(None).astype("datetime64[us]")


def _convert(col: pa.ChunkedArray, kind: str) -> pa.Array:
    """A column in the declared kind; values that have no such form, and NaN, become null."""
    if pa.types.is_null(col.type):
        return pa.nulls(len(col), _ARROW[kind])
    if kind == "seconds":
        s = _seconds(col)
    elif kind == "timestamp":
        s = _timestamp(col)
    elif kind == "string":
        s = col.to_pandas()
        if s.dtype.kind in "if":
            s = s.map(lambda v: None if pd.isna(v) else str(int(v)) if float(v).is_integer() else str(v))
        else:
            s = s.map(lambda v: None if v is None or v is pd.NaT or v != v else str(v))
    elif kind == "boolean":
        s = col.to_pandas().map({True: True, False: False, "True": True, "False": False}).astype(object)
    else:
        s = pd.to_numeric(col.to_pandas(), errors="coerce")
        if kind == "int":
            s = s.where(s.notna() & np.isclose(s % 1, 0)).round().astype("Int32")
    return pa.array(s, _ARROW[kind], from_pandas=True)


# ------------------------------------------------------------------------------------- footers
FOOTER = f"path string, {KEYS}, readable boolean, rows long, columns array<struct<name: string, kind: string>>"
#: Filesystems whose files tasks can open at a place; objects on others are read whole for their footers.
RANGED = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def _kind(column: pa.DataType, leaf) -> str:
    """How a column is stored: a Spark type, ``duration <unit>``, ``nanos`` (a count), ``null``, or ``other``."""
    if pa.types.is_dictionary(column):
        column = column.value_type
    if leaf is None or pa.types.is_nested(column):
        return "other"
    if pa.types.is_timestamp(column):
        if leaf.physical_type == "INT96":
            return "timestamp"
        if json.loads(leaf.logical_type.to_json()).get("timeUnit") == "nanoseconds":
            return "nanos"
        return "timestamp" if column.tz else "timestamp_ntz"
    if pa.types.is_duration(column):
        return f"duration {column.unit}"
    if pa.types.is_decimal(column):
        return f"decimal({column.precision},{column.scale})"
    plain = {"bool": "boolean", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int",
             "uint32": "bigint", "uint64": "decimal(20,0)", "float": "float", "double": "double", "string": "string", "large_string": "string",
             "date32[day]": "date", "null": "null"}
    return plain.get(str(column), "other")


def _footer(file) -> tuple[bool, int | None, list[dict]]:
    """(readable, rows, columns) of an open file."""
    try:
        parquet = pq.ParquetFile(file)
    except (pa.ArrowInvalid, OSError):  # about the content only: the file could be opened
        return False, None, []
    leaves = [parquet.schema.column(i) for i in range(len(parquet.schema))]
    by_name = {x.path: x for x in leaves}
    names = [f.name for f in parquet.schema_arrow]
    twice = {n for n in names if sum(m.lower() == n.lower() for m in names) > 1}  # a Spark scan cannot tell them apart
    return True, parquet.metadata.num_rows, [{"name": f.name, "kind": "other" if f.name in twice else _kind(f.type, by_name.get(f.name))}
                                             for f in parquet.schema_arrow]


def _objects(spark: SparkSession, root: str, data_type: str, content: bool) -> DataFrame | None:
    """(path, year, event, session[, content]) of every object of one type; None if there is none."""
    reader = spark.read.format("binaryFile")
    try:
        files = reader.load(f"{root.rstrip('/')}/{'*' if data_type in SEASON_REQUIRED else '*/*/*'}/{data_type}.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files.select("path", *_keys_of(F.col("path"), data_type), *(["content"] if content else []))


def _keys_of(path: Column, data_type: str, decoded: Callable[[Column], Column] = lambda part: part) -> list[Column]:
    """Year, event and session of an object's path, or of a part file's in its folder.  Every row of a scan gets them, so the path is cut
    into its parts: a pattern would be tried from each place of it.  ``decoded`` is done to the parts that are kept."""
    parts, n = F.split(path, "/"), 1 if data_type in SEASON_REQUIRED else 3
    named = [F.get(parts, F.size(parts) - k) == f"{data_type}.parquet" for k in (2, 1)]
    at = F.when(named[0], F.size(parts) - 2).when(named[1], F.size(parts) - 1)
    year = decoded(F.get(parts, at - n)).try_cast("int").alias("year")
    if data_type in SEASON_REQUIRED:
        return [year, F.lit(None).cast("string").alias("event"), F.lit(None).cast("string").alias("session")]
    return [year, *[F.coalesce(decoded(F.get(parts, at - k)), F.lit("")).alias(c) for k, c in ((2, "event"), (1, "session"))]]


def landed_footers(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """(path, year, event, session, readable, rows, columns) of every object of one type; only footers are read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    scheme = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    whole = scheme not in RANGED
    files = _objects(spark, root, data_type, content=whole)
    if files is None:
        return spark.createDataFrame([], FOOTER)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = []
            for r in batch.to_pylist():
                if whole:
                    seen.append(_footer(io.BytesIO(r["content"])))
                else:
                    filesystem, path = open_path(r["path"])
                    with filesystem.open_input_file(path) as file:
                        seen.append(_footer(file))
            columns = pa.array([c for *_, c in seen], pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string())])))
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("path", "year", "event", "session")}, "readable": pa.array([x[0] for x in seen], pa.bool_()),
                "rows": pa.array([x[1] for x in seen], pa.int64()), "columns": columns})

    return files.mapInArrow(look, FOOTER)


def landed_gate(spark: SparkSession, root: str, data_type: str, required: Sequence[str] | None = None, footers: DataFrame | None = None) -> DataFrame:
    """S3: (path, year, event, session, ok, reason, missing_columns, rows) of every object of one type; the reason is
    ``unreadable``, ``empty`` or ``missing columns``."""
    need = (REQUIRED | SEASON_REQUIRED)[data_type] if required is None else required
    foot = landed_footers(spark, root, data_type) if footers is None else footers
    needed = F.array(*[F.lit(c) for c in need]).cast("array<string>")
    missing = F.array_except(needed, F.transform("columns", lambda c: c["name"]))
    reason = F.when(~F.col("readable"), "unreadable").when(F.col("rows") == 0, "empty").when(F.size(missing) > 0, "missing columns")
    return foot.select("path", "year", "event", "session", reason.isNull().alias("ok"), reason.alias("reason"),
                       F.when(reason == "missing columns", missing).otherwise(F.array().cast("array<string>")).alias("missing_columns"),
                       F.when(reason.isNull(), F.col("rows")).alias("rows"))


def season_gate(spark: SparkSession, root: str, data_type: str, required: Sequence[str] | None = None) -> DataFrame:
    """S3 for ``season_schedule`` and ``circuits``: as :func:`landed_gate`, one object per year."""
    return landed_gate(spark, root, data_type, required).drop("event", "session")


# --------------------------------------------------------------------------------------- rows
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _stored_type(kind: str) -> str:
    return "bigint" if kind == "nanos" or kind.startswith("duration") else "string" if kind == "null" else kind


def _instant(micros: Column) -> Column:
    """Microseconds since 1970 as a time without zone."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), micros.cast("decimal(24,6)") / 1_000_000)


def _native(c: Column, kind: str, want: str) -> Column | None:
    """A stored column in the declared kind as an expression, None if there is none.  Values without such a form are null."""
    number = kind in _NUMBERS or kind.startswith("decimal")
    if kind == "null":
        return F.lit(None).cast(_SPARK[want])
    if want == "seconds":
        if kind.startswith("duration"):
            return c.cast("double") / _PER_SECOND[kind.split()[1]]
        if kind == "bigint":  # as the writer stores durations: nanoseconds
            return c / 1e9
        if kind in ("float", "double"):
            return nan_to_null(c.cast("double"))
        return duration_text_seconds(c) if kind == "string" else None
    if want == "timestamp":
        if kind == "timestamp_ntz":
            return c
        if kind == "timestamp":
            return _instant(F.unix_micros(c))
        if kind in ("nanos", "bigint"):
            return _instant((c - F.pmod(c, F.lit(1000))) / 1000)
        if kind == "date":
            return c.cast("timestamp_ntz")
        if kind == "string":  # with a zone: that instant in UTC
            return F.when(F.regexp_like(c, F.lit(r"\d(Z|[+-]\d{2}:?\d{2})\s*$")), _instant(F.unix_micros(c.try_cast("timestamp")))).otherwise(c.try_cast("timestamp_ntz"))
        return None
    if want == "string":
        if kind in ("float", "double"):
            return F.when(c == F.floor(c), c.cast("bigint").cast("string")).when(~F.isnan(c), c.cast("string"))
        if kind == "boolean":
            return F.when(c, "True").when(~c, "False")
        return c.cast("string") if number or kind in ("string", "date") else None
    if want == "boolean":
        return c if kind == "boolean" else F.when(c == 1, True).when(c == 0, False) if number else \
            F.when(c == "True", True).when(c == "False", False) if kind == "string" else None
    if not (number or kind in ("string", "boolean")):
        return None
    d = nan_to_null(c.try_cast("double") if kind == "string" else c.cast("double"))
    return d if want == "double" else F.when(F.abs(d - F.round(d)) <= 1e-8, F.round(d).cast("int"))


def _as_path(path: str) -> str:
    """A path for a reader, which would take it for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_landed(spark: SparkSession, root: str, data_type: str, required: Sequence[str] | None = None, footers: DataFrame | None = None) -> DataFrame:
    """Rows of every usable object of one type, in its declared schema, with year, event and session.

    Columns that a file lacks are null (unless ``required``: then the file gives no rows); columns that are
    not declared are left out; NaN is null.  No object at all gives an empty table.  ``footers`` saves a second look at them.
    """
    kinds = SCHEMAS[data_type]
    foot = landed_footers(spark, root, data_type) if footers is None else footers
    good = landed_gate(spark, root, data_type, required, foot).filter("ok").select("path")
    declared = F.filter("columns", lambda c: c["name"].isin(list(kinds)))
    group = F.array_join(F.array_sort(F.transform(declared, lambda c: F.concat_ws(":", c["name"], c["kind"]))), ";")
    groups: dict[str, list[str]] = {}
    for r in foot.join(good, "path", "left_semi").select(group.alias("group"), "path").toLocalIterator():
        groups.setdefault(r["group"], []).append(r["path"])
    parts = [_group_scan(spark, data_type, dict(x.rsplit(":", 1) for x in text.split(";") if x), sorted(groups[text])) for text in sorted(groups)]
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{c} {_SPARK[k]}" for c, k in kinds.items()) + ", " + KEYS)
    return reduce(DataFrame.unionByName, parts)


def _group_scan(spark: SparkSession, data_type: str, stored: dict[str, str], paths: list[str]) -> DataFrame:
    """The rows of files that store the declared columns in the same way."""
    kinds = SCHEMAS[data_type]
    columns = {c: _native(F.col(c), stored[c], k) if c in stored else F.lit(None).cast(_SPARK[k]) for c, k in kinds.items()}
    if not stored or any(c is None for c in columns.values()):
        return _decoded(spark, data_type, paths)
    schema = ", ".join(f"{c} {_stored_type(k)}" for c, k in stored.items() if k != "null") or f"{next(iter(stored))} string"
    scan = spark.read.schema(schema).parquet(*map(_as_path, paths))
    keys = _keys_of(F.col("_metadata.file_path"), data_type, lambda part: F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))))
    return scan.select(*[x.alias(c) for c, x in columns.items()], *keys)


def _decoded(spark: SparkSession, data_type: str, paths: list[str]) -> DataFrame:
    """The rows of files with columns that no expression converts, decoded in tasks."""
    kinds = SCHEMAS[data_type]
    files = spark.read.format("binaryFile").load([_as_path(p) for p in paths]).select("content", *_keys_of(F.col("path"), data_type))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                file = pq.ParquetFile(io.BytesIO(r["content"]))
                table = file.read([c for c in kinds if c in file.schema_arrow.names])
                cols = {c: _convert(table.column(c), k) if c in table.column_names else pa.nulls(len(table), _ARROW[k])
                        for c, k in kinds.items()}
                n = file.metadata.num_rows
                cols |= {"year": pa.array([r["year"]] * n, pa.int32()), "event": pa.array([r["event"]] * n), "session": pa.array([r["session"]] * n)}
                yield pa.RecordBatch.from_pydict(cols)

    return files.mapInArrow(decode, ", ".join(f"{c} {_SPARK[k]}" for c, k in kinds.items()) + ", " + KEYS)


def session_reasons(gate: DataFrame) -> DataFrame:
    """One reason per session that has no usable object."""
    keys = ["year", "event", "session"]
    per = gate.groupBy(*keys).agg(F.bool_or("ok").alias("usable"), F.min("reason").alias("reason"))
    return per.filter(~F.col("usable")).select(*keys, "reason")
