"""Change detection over file manifests.

A manifest is a DataFrame (path, length, modificationTime, year_part); two
snapshots are compared with one full outer join on the path, so new, deleted
and modified files (size or mtime differs) are all detected -- the
reference only compares two totals and never sees modifications.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucket_state(files: DataFrame, year_col: str = "year_part") -> DataFrame:
    """Files per numeric year plus the total (rollup; total row has
    ``year`` NULL and ``is_total``)."""
    y = F.col(year_col).try_cast("int")
    numeric = files.withColumn("year", y)
    out = numeric.rollup("year").agg(F.count(F.lit(1)).alias("files"),
                                     F.grouping("year").alias("__g"))
    # non-numeric first parts count in the total only (as in the reference)
    return (out.filter((F.col("__g") == 1) | F.col("year").isNotNull())
            .select("year", (F.col("__g") == 1).alias("is_total"), "files"))


def manifest_diff(old: DataFrame, new: DataFrame, key: str = "path",
                  compare: tuple[str, ...] = ("length", "modificationTime")) -> DataFrame:
    """One row per path in either snapshot with ``change`` in
    new / deleted / modified / unchanged."""
    o = old.select(F.col(key).alias("__old"), *[F.col(c).alias(f"old_{c}") for c in compare], F.lit(True).alias("__in_old"))
    n = new.select(F.col(key).alias("__new"), *[F.col(c).alias(f"new_{c}") for c in compare], F.lit(True).alias("__in_new"))
    # NULL paths match each other
    j = o.join(n, F.col("__old").eqNullSafe(F.col("__new")), "full_outer").withColumn(key, F.coalesce("__old", "__new"))
    in_old, in_new = F.col("__in_old").isNotNull(), F.col("__in_new").isNotNull()
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    change = (F.when(~in_old, F.lit("new")).when(~in_new, F.lit("deleted"))
              .when(differs, F.lit("modified")).otherwise(F.lit("unchanged")))
    return j.select(key, change.alias("change"),
                    *[f"old_{c}" for c in compare], *[f"new_{c}" for c in compare])


def diff_counts(diff: DataFrame) -> DataFrame:
    """T2 summary from the per-path diff (one aggregate, no re-scan of the
    snapshots): totals of both snapshots, the reference's total-based new /
    deleted (max(0, +-delta)) and the exact per-path counts."""
    c = F.col("change")
    agg = diff.agg(F.count_if(c != "new").alias("old_total"),
                   F.count_if(c != "deleted").alias("new_total"),
                   F.count_if(c == "new").alias("new_files"),
                   F.count_if(c == "deleted").alias("deleted_files"),
                   F.count_if(c == "modified").alias("modified_files"))
    n_old, n_new = F.col("old_total"), F.col("new_total")
    return agg.select(
        "old_total", "new_total",
        F.greatest(n_new - n_old, F.lit(0)).alias("total_delta_new"),
        F.greatest(n_old - n_new, F.lit(0)).alias("total_delta_deleted"),
        "new_files", "deleted_files", "modified_files",
        ((F.col("new_files") + F.col("deleted_files") + F.col("modified_files")) > 0)
        .alias("changed"))
