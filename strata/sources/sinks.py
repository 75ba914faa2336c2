"""Table sinks.

Parquet has no transaction log, and a job that reads a path and overwrites the
same path loses the data. So a table that changes (merge, SCD2) is written as a
new snapshot directory and the caller moves on to the new path; a plain
overwrite is only for paths the job does not read. Snapshot locations live
under the checkpoint folder named by the session, which a cluster's machines
share. ``publish`` keeps a pointer from a table's name to its current snapshot
and removes old ones. With Delta on the classpath, ``fmt="delta"`` works
unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir, fresh_table_path


def create_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write only when nothing exists at ``path`` (mode ``ignore``)."""
    df.write.mode("ignore").format(fmt).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = ()) -> None:
    """Replace the table at ``path``; ``df`` must not read from ``path``."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Iterable[str], fmt: str = "parquet") -> None:
    """Replace only the partitions ``df`` has rows for; other partitions stay.

    Dynamic partition overwrite: a period-keyed mart partitioned by its period
    takes a run in time proportional to the run, not to the whole mart.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows; a job that runs again adds them again. ``append_load`` is for jobs that may."""
    df.write.mode("append").format(fmt).save(path)


def append_load(df: DataFrame, path: str, load: str | int, column: str = "load_id", fmt: str = "parquet") -> None:
    """Add a load's rows as the partition of its id; the same load again replaces its own rows.

    Loads of other ids are not touched, so a job that failed, or that a scheduler
    starts twice, can just run again. A load without rows leaves what is there.
    """
    if column in df.columns:
        raise ValueError(f"the rows already have a column {column!r}")
    overwrite_partitions(df.withColumn(column, F.lit(load)), path, [column], fmt)


def write_snapshot(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    max_records_per_file: int | None = None,
) -> str:
    """Write ``df`` to a fresh location and return it (one write, one commit).

    The write also cuts the lineage: the next step reads the files back. File
    sizes follow the last stage's partitions, which AQE coalesces;
    ``max_records_per_file`` caps a file where a partition is large.
    """
    path = fresh_table_path(spark, name)
    w = df.write.mode("errorifexists").format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_bucketed(
    spark: SparkSession, df: DataFrame, name: str, keys: Iterable[str], buckets: int, fmt: str = "parquet"
) -> str:
    """Write ``df`` as a catalog table bucketed and sorted by ``keys``; return its name.

    A table keyed like this is read already hash-partitioned, so merges and
    joins on the keys (``merge(..., co_partitions=buckets)``) do not shuffle
    it. Files live under the shared checkpoint folder.
    """
    keys = list(keys)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (
        df.write.format(fmt)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", fresh_table_path(spark, name))
        .saveAsTable(table)
    )
    return table


def default_buckets(spark: SparkSession, rows: int = 0, rows_per_bucket: int = 1) -> int:
    """As many buckets as the session shuffles into, which its owner sets by the size of the data.

    With ``rows`` they are more where a bucket would hold over ``rows_per_bucket``.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_bucket))


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Remove a table of ``write_bucketed`` from the catalog, and its files."""
    where = [r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r.col_name == "Location"]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for path in where:
        remove(spark, path)


# --- tables with a name -----------------------------------------------------------


def _pointer(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/current/{name}"


def snapshots(spark: SparkSession, name: str) -> list[str]:
    """Locations of a named table's snapshots, the current one last."""
    try:
        rows = spark.read.schema("version long, path string").parquet(_pointer(spark, name)).orderBy("version").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r.path for r in rows]


def publish(spark: SparkSession, name: str, df: DataFrame, keep: int = 2, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as the current snapshot of ``name`` and return it; older ones than ``keep`` are removed.

    The pointer moves after the write is complete, so a job that fails leaves
    the table as it was. One job at a time writes a name, as schedulers do.
    """
    path = write_snapshot(spark, df, name, fmt)
    old = snapshots(spark, name)
    stay = [*old, path][-keep:]
    rows = [(k, p) for k, p in enumerate(stay)]
    spark.createDataFrame(rows, "version long, path string").coalesce(1).write.mode("overwrite").parquet(_pointer(spark, name))
    for gone in old:
        if gone not in stay:
            remove(spark, gone)
    return read_snapshot(spark, path, fmt)


def current(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame | None:
    """The current snapshot of ``name``; None before the first ``publish``."""
    paths = snapshots(spark, name)
    return read_snapshot(spark, paths[-1], fmt) if paths else None


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def signature(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of the files under ``path``: changes whenever they do."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a snapshot that this package wrote, in whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
