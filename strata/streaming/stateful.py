"""Streams that keep what they know in a state store.

``incremental_load`` rewrites its table with every batch. Here Spark's state
store holds the state, a batch reads and writes only its own rows, and the
output is appended:

- ``append_first_seen``: of rows that are sent again (same keys) the first one
  is appended; keys are forgotten once the watermark has passed them, so the
  state is bounded by the rows of ``delay``;
- ``append_latest``: a changelog of the newest row of each key: a batch appends
  the keys whose newest row it changed. ``read_latest`` is the table. The state
  has a row for each key, as the table has.

Both are file-source streams that process what is there and stop; the checkpoint
holds the consumed files and the state, in the shared folder the caller names. A
batch that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.keys import key_list


def _files(spark: SparkSession, source_dir: str, schema: StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source_dir)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def append_first_seen(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    keys: str | Iterable[str],
    event_time: str,
    delay: str,
    table: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Append new files' rows to ``table``, each key once within ``delay``; returns the table.

    Rows that come later than ``delay`` behind the newest event are dropped, as
    their keys may be forgotten. Which of the rows of a key is the first is
    decided by the batch; they should be copies.
    """
    rows = _files(spark, source_dir, schema, files_per_batch)
    timed = rows.withColumn("__event_time", F.col(event_time).cast("timestamp")).withWatermark("__event_time", delay)
    once = timed.dropDuplicatesWithinWatermark(key_list(keys)).drop("__event_time")
    _finish(once.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table))
    return spark.read.schema(schema).parquet(table)


def append_latest(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    keys: str | Iterable[str],
    order_by: Iterable[str],
    changelog: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Append to ``changelog`` the keys whose newest row (by ``order_by``) new files change; returns the newest rows.

    Rows are ordered by ``order_by`` and then by their other columns, so the
    result doesn't depend on how files are batched.
    """
    keys, order = key_list(keys), list(order_by)
    rest = [c for c in schema.names if c not in keys and c not in order]
    newest = _files(spark, source_dir, schema, files_per_batch).groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("newest"))

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changelog.rstrip('/')}/batch={n}")

    _finish(newest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return read_latest(spark, changelog, keys, schema)


def read_latest(spark: SparkSession, changelog: str, keys: str | Iterable[str], schema: StructType) -> DataFrame:
    """The newest row of each key, from the last batch that changed it."""
    keys = key_list(keys)
    rows = spark.read.parquet(changelog)
    last = rows.groupBy(*keys).agg(F.max_by("newest", F.col("batch").cast("long")).alias("newest"))
    return last.select(*keys, "newest.*").select(*schema.names)
