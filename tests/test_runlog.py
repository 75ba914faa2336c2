"""Run-log flattening from nested JSON run records."""

import datetime as dt
import json

from strata.plans.runlog import flatten_jobs, flatten_tasks, job_names, latest_tasks
from strata.session import fresh_table_path
from strata.sources.runs import read_runs_json

RUNS = [
    {"run_id": 11, "job_id": 1, "start_time": 1704067200000, "end_time": 1704067265500,
     "state": {"result_state": "FAILED"},
     "tasks": [
         {"task_key": "load", "start_time": 1704067200000, "end_time": 1704067201000, "state": {}},
         {"task_key": "load", "start_time": 1704067210000, "end_time": 1704067211000,
          "state": {"result_state": "FAILED"}},
         {"task_key": "check", "start_time": 1704067220000, "end_time": 1704067221000, "state": {}},
     ]},
    {"run_id": 12, "job_id": 2, "start_time": 1704067300000, "end_time": 0, "state": {}},
]


def _runs(spark):
    path = fresh_table_path(spark, "runs_json")
    spark.sparkContext.parallelize([json.dumps(r) for r in RUNS], 1).saveAsTextFile(path)
    return read_runs_json(spark, path)


def test_jobs(spark):
    jobs = {r.job_run_id: r for r in flatten_jobs(_runs(spark), job_names(spark)).collect()}
    assert jobs[11].job_name == "processing" and jobs[11].status == "FAILED"
    assert jobs[11].duration == 65.5 and jobs[11].date == dt.date(2024, 1, 1)
    assert jobs[11].start_time == dt.datetime(2024, 1, 1, 0, 0, 0)
    assert jobs[12].status == "SUCCESS" and jobs[12].end_time is None and jobs[12].duration is None
    assert jobs[12].job_name == "monitoring"


def test_tasks_latest_per_key(spark):
    tasks = flatten_tasks(_runs(spark))
    assert tasks.count() == 3
    latest = {(r.task_key, r.job_run_id): r for r in latest_tasks(tasks).collect()}
    assert set(latest) == {("load", 11), ("check", 11)}
    assert latest[("load", 11)].status == "FAILED"
    assert latest[("check", 11)].status == "SUCCESS"
