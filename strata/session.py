"""Session helpers: one place for the settings every job in this package expects.

Library code never builds its own session; callers pass one in. ``get_spark`` is
for tests, the bench and local runs. On a cluster the platform's session is used
as is; only settings that are unset are filled in.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: ANSI types, runtime re-planning (partition
# coalescing, skew-join splitting, runtime broadcast only below the size bound),
# and UTC so that epoch-millisecond conversions are stable.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    master = master or os.environ.get("STRATA_MASTER", "local[8]")
    cores = _cores(master)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in SESSION_DEFAULTS on a session someone else built."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written tables.

    Read from the session (``spark.checkpoint.dir`` or a directory set on the
    context). Only on a local master, as in tests, a scratch folder is made when
    nothing is set; a cluster has to name a folder that its machines share.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all machines of the cluster share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def fresh_table_path(spark: SparkSession, name: str) -> str:
    """A new, never-used table location under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def _cores(master: str) -> int:
    inside = master[master.find("[") + 1 : master.find("]")] if "[" in master else "1"
    if inside in ("*", ""):
        return os.cpu_count() or 1
    try:
        return int(inside.split(",")[0])
    except ValueError:
        return os.cpu_count() or 1


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and continue from the files.

    For loops that apply an operator many times in one job (a run of SCD2
    loads, for example): the plan stops growing and a lost executor does not
    send the recomputation back to the first step.
    """
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)
