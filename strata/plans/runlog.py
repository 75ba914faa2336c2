"""Run-log tables from nested run records: jobs log and tasks log.

Columns of a job and a task log. Epoch milliseconds become timestamps; a
missing result state means SUCCESS (a parameter); an end time of 0 (run not finished) becomes null instead of 1970.
Logs are then upserted: jobs on ``job_run_id``, tasks on
(``job_run_id``, ``task_key``) after keeping the latest start per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.sources.runs import from_epoch_ms

# Job id -> job name of the warehouse's three workflows, and the
# status of a run or task that reports no result state.
JOB_NAMES = {0: "ingestion", 1: "processing", 2: "monitoring"}
DEFAULT_STATUS = "SUCCESS"


def job_names(spark: SparkSession, mapping: Mapping[int, str] = JOB_NAMES) -> DataFrame:
    return spark.createDataFrame([(int(k), v) for k, v in mapping.items()], "job_id long, job_name string")


def _ts(ms: F.Column) -> F.Column:
    return F.when(ms > 0, from_epoch_ms(ms))


def flatten_jobs(runs: DataFrame, names: DataFrame, default_status: str = DEFAULT_STATUS) -> DataFrame:
    """One row per run: job_run_id, job_id, job_name, date, start/end time, duration (s), status.

    Whether the name lookup is broadcast is left to its size.
    """
    start, end = F.col("start_time"), F.col("end_time")
    jobs = runs.select(
        F.col("run_id").alias("job_run_id"),
        "job_id",
        _ts(start).alias("start_time"),
        _ts(end).alias("end_time"),
        F.when(end > 0, (end - start).cast("double") / F.lit(1000.0)).alias("duration"),
        F.coalesce(F.col("state.result_state"), F.lit(default_status)).alias("status"),
    )
    return jobs.join(names, "job_id", "left").select(
        "job_run_id",
        "job_id",
        "job_name",
        F.to_date("start_time").alias("date"),
        "start_time",
        "end_time",
        "duration",
        "status",
    )


def flatten_tasks(runs: DataFrame, default_status: str = DEFAULT_STATUS) -> DataFrame:
    """One row per task entry: task_key, job_run_id, start_time, end_time, status."""
    t = runs.select(F.col("run_id").alias("job_run_id"), F.explode("tasks").alias("t"))
    return t.select(
        F.col("t.task_key").alias("task_key"),
        "job_run_id",
        _ts(F.col("t.start_time")).alias("start_time"),
        _ts(F.col("t.end_time")).alias("end_time"),
        F.coalesce(F.col("t.state.result_state"), F.lit(default_status)).alias("status"),
    )


def latest_tasks(tasks: DataFrame) -> DataFrame:
    """Latest start per (task_key, job_run_id); ties broken by end time, then status."""
    return latest_per_key(tasks, ["task_key", "job_run_id"], ["start_time", "end_time", "status"])
