"""Run listings whose records drift: read as VARIANT, with what can't be read kept apart.

A fixed schema turns a field that has moved or changed its type into null. Here
a line is parsed without a schema; each field is taken from the first of its
known places that fits its type, and a line that is no JSON object or has no run
id is a rejected row, with the line and the reason, not a row of nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where listings have had a field, and as which type; the first that fits is taken.
PLACES = {
    "run_id": (("$.run_id", "bigint"), ("$.id", "bigint")),
    "job_id": (("$.job_id", "bigint"), ("$.job.id", "bigint")),
    "start_time": (("$.start_time", "bigint"), ("$.times.start", "bigint"), ("$.start_time", "timestamp")),
    "end_time": (("$.end_time", "bigint"), ("$.times.end", "bigint"), ("$.end_time", "timestamp")),
    "result_state": (("$.state.result_state", "string"), ("$.result_state", "string"), ("$.status", "string")),
}
TASK_PLACES = {
    "task_key": (("$.task_key", "string"), ("$.key", "string")),
    "start_time": PLACES["start_time"],
    "end_time": PLACES["end_time"],
    "result_state": PLACES["result_state"],
}


def _taken(record: Column, places: Sequence[tuple[str, str]]) -> Column:
    found = []
    for path, kind in places:
        value = F.try_variant_get(record, path, kind)
        found.append(F.unix_millis(value) if kind == "timestamp" else value)
    return F.coalesce(*found)


def parsed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``lines`` with ``record`` (variant; null if the line is no JSON) and ``rejected``, the reason or null."""
    record = F.try_parse_json(F.col(value))
    rows = lines.withColumn("record", record)
    kind = F.schema_of_variant("record")
    reason = (
        F.when(F.col("record").isNull(), "no JSON")
        .when(~F.startswith(kind, F.lit("OBJECT")), "no object")
        .when(_taken(F.col("record"), PLACES["run_id"]).isNull(), "no run id")
    )
    return rows.withColumn("rejected", reason)


def runs_of(lines: DataFrame, value: str = "value") -> DataFrame:
    """Runs in the shape of ``read_runs_json`` from the lines that are none of the rejected ones."""
    good = parsed_lines(lines, value).where("rejected IS NULL")
    r = F.col("record")

    def task(t: Column) -> Column:
        own = {k: _taken(t, places) for k, places in TASK_PLACES.items()}
        state = F.struct(own["result_state"].alias("result_state"))
        return F.struct(own["task_key"].alias("task_key"), own["start_time"].alias("start_time"), own["end_time"].alias("end_time"), state.alias("state"))

    tasks = F.coalesce(F.try_variant_get(r, "$.tasks", "array<variant>"), F.try_variant_get(r, "$.steps", "array<variant>"))
    return good.select(
        *[_taken(r, PLACES[c]).alias(c) for c in ("run_id", "job_id", "start_time", "end_time")],
        F.struct(_taken(r, PLACES["result_state"]).alias("result_state")).alias("state"),
        F.transform(tasks, task).alias("tasks"),
    )


def rejected_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines that are no runs, with the reason."""
    return parsed_lines(lines, value).where("rejected IS NOT NULL").select(value, "rejected")
