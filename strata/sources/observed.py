"""Writes that measure what they write.

``write_observed`` stores a DataFrame as a snapshot and returns metrics that the
write itself has taken (``DataFrame.observe``), so a load's counts need no second
scan of the table.

The metrics are taken in the job's last stage, from the rows as they go into
the files: a task that is run again there counts once. Measure the rows that are
written (flag them before, as ``merge_actions`` does), not an input above a
shuffle, whose tasks may run again after an executor is lost and count twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import ACTION
from strata.sources import sinks


def write_observed(
    spark: SparkSession, df: DataFrame, name: str, metrics: Mapping[str, Column], drop: tuple[str, ...] = (), fmt: str = "parquet"
) -> tuple[str, dict]:
    """Path of the new snapshot and the metrics, aggregates over the rows; ``drop``: columns to measure but not to write."""
    taken = Observation()
    observed = df.observe(taken, *[m.alias(k) for k, m in metrics.items()]).drop(*drop)
    path = sinks.write_snapshot(spark, observed, name, fmt)
    return path, dict(taken.get)


def write_merged(spark: SparkSession, actions: DataFrame, name: str, invalid: Column | None = None, fmt: str = "parquet") -> tuple[str, dict]:
    """Store the result of ``merge_actions``; returns its path and how many rows were inserted, updated, kept, absent, and invalid."""
    done = {f"{a}_rows": F.count_if(F.col(ACTION) == a) for a in ("insert", "update", "keep", "absent")}
    metrics = {"table_rows": F.count(F.lit(1)), **done, "invalid_rows": F.count_if(F.lit(False) if invalid is None else invalid)}
    return write_observed(spark, actions, name, metrics, (ACTION,), fmt)
