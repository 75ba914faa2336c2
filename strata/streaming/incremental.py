"""Incremental loads with Structured Streaming.

The warehouse's scheduled loads (upsert into the ingestion table, SCD2 into a
dimension) are the same operators applied to each new batch of source files.
``incremental_load`` runs them as a file-source stream with ``foreachBatch``:

- the stream's checkpoint records which files were consumed, so a restarted
  job continues where it stopped;
- a batch reads the table's newest version and writes the next one to its own
  directory; a log says which checkpoint and batch made which version, so a
  batch that is replayed after a failure writes the same version again from the
  same input, and a new checkpoint over an existing table goes on from it;
- ``trigger(availableNow=True)`` processes what is there and stops, which is
  how a scheduled run uses it; a run that finds no new files returns the newest
  version. Versions older than the last ``keep_versions`` are removed.

Every batch writes the whole table, as any parquet table does that has no
transaction log; a table too large for that is stored bucketed, or as Delta.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.keys import key_list
from strata.operators.dedupe import latest_per_key
from strata.operators.merge import assert_unique_keys, merge
from strata.operators.scd2 import scd2_apply, scd2_seed
from strata.sources import sinks

Step = Callable[[DataFrame | None, DataFrame, int], DataFrame]

LOG = "checkpoint string, batch long, version long"


def version_path(table_root: str, n: int) -> str:
    return f"{table_root.rstrip('/')}/version={n:09d}"


def upsert_step(keys: str | Iterable[str], order_by: Iterable[str] | None = None) -> Step:
    """Keyed upsert of each batch; with ``order_by`` only newer rows replace older ones.

    Without ``order_by`` a key that occurs twice in a batch raises, in the
    first batch too.
    """
    keys = key_list(keys)

    def step(current: DataFrame | None, batch: DataFrame, _n: int) -> DataFrame:
        if order_by is None:
            return assert_unique_keys(batch, keys, "first batch") if current is None else merge(current, batch, keys)
        order = list(order_by)
        newest = latest_per_key(batch, keys, order)
        if current is None:
            return newest

        def newer(t, s):
            return F.struct(*[s(c) for c in order]) > F.struct(*[t(c) for c in order])

        return merge(current, newest, keys, when_changed=newer)

    return step


def scd2_step(keys: str | Iterable[str], effective_date: Callable[[int], dt.date]) -> Step:
    """SCD2 load of each batch (a full snapshot) on the date given for the batch."""

    def step(current: DataFrame | None, batch: DataFrame, n: int) -> DataFrame:
        if current is None:
            return scd2_seed(assert_unique_keys(batch, keys, "first batch"), keys)
        return scd2_apply(current, batch, effective_date(n), keys)

    return step


def incremental_load(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    initial: DataFrame | None,
    table_root: str,
    checkpoint: str,
    step: Step,
    files_per_batch: int | None = None,
    keep_versions: int = 2,
) -> str:
    """Apply ``step`` to every batch of new parquet files; return the newest version's path.

    ``initial`` is the table before the first version; ``None`` lets the first
    batch create it.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)

    def apply(batch: DataFrame, n: int) -> None:
        session = batch.sparkSession
        done = _log(session, table_root)
        own = [v for c, b, v in done if (c, b) == (checkpoint, n)]
        last = max((v for _, _, v in done), default=-1)
        version = own[0] if own else last + 1
        current = session.read.parquet(version_path(table_root, version - 1)) if version else initial
        step(current, batch, n).write.mode("overwrite").parquet(version_path(table_root, version))
        if not own:
            entry = session.createDataFrame([(checkpoint, n, version)], LOG)
            entry.coalesce(1).write.mode("append").parquet(_log_path(table_root))
            # the version before stays for a replay of this batch
            if version >= max(2, keep_versions):
                sinks.remove(session, version_path(table_root, version - max(2, keep_versions)))

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return latest_version(spark, table_root)


def _log_path(table_root: str) -> str:
    return f"{table_root.rstrip('/')}/_versions"


def _log(spark: SparkSession, table_root: str) -> list[tuple[str, int, int]]:
    """(checkpoint, batch, version) of every finished version: one row for a batch ever run."""
    if not sinks.exists(spark, _log_path(table_root)):
        return []
    return [tuple(r) for r in spark.read.schema(LOG).parquet(_log_path(table_root)).collect()]


def latest_version(spark: SparkSession, table_root: str) -> str:
    """Path of the newest finished version (also when a run found no new files)."""
    versions = [v for _, _, v in _log(spark, table_root)]
    if not versions:
        raise RuntimeError(f"no version of {table_root} has been written")
    return version_path(table_root, max(versions))
