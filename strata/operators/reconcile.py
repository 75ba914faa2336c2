"""Row-count reconciliation between a source and the table loaded from it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import key_list


def reconcile_counts(source: DataFrame, target: DataFrame, keys: str | Iterable[str] | None = None) -> DataFrame:
    """One report row: row counts of both sides and whether they agree.

    Counting rows moves one number per task. With ``keys`` the distinct keys
    are counted too, which shuffles them once. Raising on a mismatch is the
    caller's choice: after an upsert, dropped source duplicates and kept target
    rows make the row counts differ legitimately.
    """
    if keys is None:
        tagged = source.select(F.lit(True).alias("src")).unionByName(target.select(F.lit(False).alias("src")))
        counts = tagged.agg(F.count_if("src").alias("source_rows"), F.count_if(~F.col("src")).alias("target_rows"))
        return counts.withColumn("rows_match", F.col("source_rows") == F.col("target_rows"))
    keys = key_list(keys)
    k = F.struct(*keys)
    both = source.select(F.lit(True).alias("src"), k.alias("k")).unionByName(
        target.select(F.lit(False).alias("src"), k.alias("k"))
    )
    # Rows per (side, key) first: duplicates collapse map-side, so a hot key
    # costs one row per task; then one small global aggregate.
    per_key = both.groupBy("src", "k").agg(F.count(F.lit(1)).alias("n"))
    src = F.col("src")
    counts = per_key.agg(
        F.coalesce(F.sum(F.when(src, F.col("n"))), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(F.when(~src, F.col("n"))), F.lit(0)).alias("target_rows"),
        F.count(F.when(src, 1)).alias("source_keys"),
        F.count(F.when(~src, 1)).alias("target_keys"),
    )
    return counts.withColumns(
        {
            "rows_match": F.col("source_rows") == F.col("target_rows"),
            "keys_match": F.col("source_keys") == F.col("target_keys"),
        }
    )


def assert_counts_match(report: DataFrame, on: str = "rows_match") -> None:
    """Raise with both numbers when the report says the counts differ."""
    row = report.first()
    if not row[on]:
        raise AssertionError(
            f"{on} is false: {row['source_rows']} rows in the source, {row['target_rows']} in the table"
        )
