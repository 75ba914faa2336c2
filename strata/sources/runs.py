"""Nested job-run records (run with ``state`` and a ``tasks`` array).

Run listings arrive as JSON lines; ``read_runs_json`` reads them with a fixed
schema (no inference, no driver-side dict building). ``runs_from_events``
derives such records from the ``events`` table for tests and queries: the
events of one user on one day form a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

STATE = StructType([StructField("result_state", StringType())])
TASK = StructType(
    [
        StructField("task_key", StringType()),
        StructField("start_time", LongType()),
        StructField("end_time", LongType()),
        StructField("state", STATE),
    ]
)
RUN_SCHEMA = StructType(
    [
        StructField("run_id", LongType()),
        StructField("job_id", LongType()),
        StructField("start_time", LongType()),
        StructField("end_time", LongType()),
        StructField("state", STATE),
        StructField("tasks", ArrayType(TASK)),
    ]
)


def read_runs_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).json(path)


# Fixed value: the Unix epoch as a wall-clock timestamp (zone-free).
EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_ms(ts: str, zone_free: bool = True) -> F.Column:
    """Epoch milliseconds of a timestamp column, truncated.

    A ``timestamp_ntz`` wall clock is read as UTC without going through the
    session time zone; with ``zone_free=False`` the column is an instant
    (``timestamp``) and ``unix_millis`` is used.
    """
    if zone_free:
        return F.timestamp_diff("MILLISECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), F.col(ts))
    return F.unix_millis(F.col(ts))


def from_epoch_ms(ms: F.Column) -> F.Column:
    """Wall-clock UTC ``timestamp_ntz`` of epoch milliseconds (zone-free)."""
    return F.timestamp_add("MILLISECOND", ms, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def runs_from_events(events: DataFrame) -> DataFrame:
    """One run per user and day; one task per event.

    run_id = first event id of the run, job_id = user % 3; run state is null
    (still running) for users divisible by 7, FAILED for users divisible by 5,
    else SUCCESS; a task FAILED for 'error' events, else no state.
    """
    zone_free = dict(events.dtypes)["ts"] == "timestamp_ntz"
    e = events.select(
        "user_id",
        "event_id",
        F.col("ts").cast("date").alias("day"),
        F.struct(
            F.col("event_type").alias("task_key"),
            epoch_ms("ts", zone_free).alias("start_time"),
            (epoch_ms("ts", zone_free) + 1000).alias("end_time"),
            F.struct(F.when(F.col("event_type") == "error", "FAILED").alias("result_state")).alias("state"),
        ).alias("task"),
    )
    runs = e.groupBy("user_id", "day").agg(
        F.min("event_id").alias("run_id"),
        F.min("task.start_time").alias("start_time"),
        F.max("task.start_time").alias("end_time"),
        F.collect_list("task").alias("tasks"),
    )
    u = F.col("user_id")
    state = F.when(u % 7 == 0, F.lit(None)).when(u % 5 == 0, "FAILED").otherwise("SUCCESS")
    return runs.select(
        "run_id",
        (u % 3).alias("job_id"),
        "start_time",
        "end_time",
        F.struct(state.cast("string").alias("result_state")).alias("state"),
        "tasks",
    )
