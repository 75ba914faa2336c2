"""The warehouse's scheduled jobs, one function per job.

Each function takes the table as it stands (``current``; ``None`` on the
first run, where the job creates the table) and the new input, and returns
the table's next state as a DataFrame. ``run_job`` writes that state as a new
snapshot and returns its path, so a job never overwrites the path it reads.

=========================  ====================================================
job                        what it does
=========================  ====================================================
``ingest_upsert``          deduplicate the source on its key, then full upsert
``process_fact``           fingerprint non-key columns; update rows whose hash changed, insert new
``process_dimension``      (optionally clean strings and flag validity), then SCD2
``process_orderdetails``   roll order lines up to (order, item); update quantity if changed
``merge_mart``             replace the measures of the periods (mart grain) a run covers
``write_mart_periods``     the same on a mart partitioned by period: only the run's periods are written
``merge_touched``          merge that reads and writes only the partitions its source has rows for
``run_mart_job``           a mart written as SQL, stored with an overwrite or a period-merge sink
=========================  ====================================================
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.cleaning import clean_strings
from strata.functions.fingerprint import with_row_hash
from strata.functions.keys import key_list
from strata.operators.dedupe import dedupe_key
from strata.operators.merge import assert_unique_keys, merge
from strata.operators.scd2 import scd2_apply, scd2_seed
from strata.plans.marts import run_mart
from strata.sources import sinks
from strata.sources.fixtures import rollup_orderdetails


def ingest_upsert(
    current: DataFrame | None,
    source: DataFrame,
    keys: str | Iterable[str] = "id",
    order_by: Iterable[str] | None = None,
    co_partitions: int | None = None,
) -> DataFrame:
    """Source deduplicated on the key (survivor by ``order_by``), then upserted."""
    fresh = dedupe_key(source, keys, order_by)
    if current is None:
        return fresh
    return merge(current, fresh, keys, co_partitions=co_partitions, extra="drop")


def process_fact(
    current: DataFrame | None,
    source: DataFrame,
    keys: str | Iterable[str] = "id",
    co_partitions: int | None = None,
) -> DataFrame:
    """Fact with a ``hash`` of its non-key columns; only changed rows are rewritten.

    Values are cast to the table's types before they are hashed; a key that
    occurs twice raises, on the first load too.
    """
    keys = key_list(keys)
    if current is None:
        return with_row_hash(assert_unique_keys(source, keys, "fact source"), exclude=keys)
    types = dict(current.dtypes)
    typed = source.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in source.columns])
    return merge(current, with_row_hash(typed, exclude=keys), keys, when_changed="hash", co_partitions=co_partitions)


def process_dimension(
    current: DataFrame | None,
    source: DataFrame,
    effective_date: dt.date | str | None = None,
    keys: str | Iterable[str] = "id",
    clean: bool = False,
    co_partitions: int | None = None,
) -> DataFrame:
    """SCD2 dimension; with ``clean`` the strings are cleaned and ``validFlag`` added first."""
    keys = key_list(keys)
    rows = clean_strings(source, exclude=keys) if clean else source
    if current is None:
        return scd2_seed(assert_unique_keys(rows, keys, "dimension source"), keys)
    return scd2_apply(current, rows, effective_date, keys, co_partitions=co_partitions)


def process_orderdetails(current: DataFrame | None, raw_lines: DataFrame) -> DataFrame:
    """Order lines summed per (order, item); a changed total updates only ``totalQuantity``."""
    rolled = rollup_orderdetails(raw_lines)
    return rolled if current is None else merge_quantities(current, rolled)


def merge_quantities(current: DataFrame, rolled: DataFrame) -> DataFrame:
    """Rolled-up order lines merged by (order, item): known rows get a changed ``totalQuantity``, new ones come whole.

    Lines have an order and an item; a null in either raises, so the join is on
    plain keys and the partitioning of the roll-up serves it.
    """
    return merge(
        current,
        rolled,
        ["orderId", "itemId"],
        when_changed="totalQuantity",
        update_cols=["totalQuantity"],
        refuse_null_keys=True,
    )


def merge_mart(current: DataFrame | None, mart: DataFrame, grain: str | Iterable[str] = "ReportingPeriod") -> DataFrame:
    """Period-keyed mart: the run's rows replace the stored rows of the same grain."""
    return mart if current is None else merge(current, mart, grain)


def write_mart_periods(
    spark: SparkSession,
    mart: DataFrame,
    path: str,
    period: str = "ReportingPeriod",
    grain: str | Iterable[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Store a period-keyed mart partitioned by its period and return the table.

    The partitioned form of ``merge_mart``: the run's rows replace stored rows
    of the same ``grain`` (the period alone unless told otherwise), stored rows
    of other grains in the same periods stay, and only the periods that the run
    touches are read and written.
    """
    keys = key_list(grain) if grain is not None else [period]
    if period not in keys:
        raise ValueError(f"the grain {keys} has to hold the period {period!r}")
    if keys != [period] and sinks.exists(spark, path):
        return merge_touched(spark, path, mart, keys, period, fmt)
    # One task per period writes one file per partition (a mart is aggregated,
    # so a period holds few rows), instead of every task writing to every period.
    sinks.overwrite_partitions(mart.repartition(period), path, [period], fmt)
    return spark.read.schema(mart.schema).format(fmt).load(path)


def merge_touched(
    spark: SparkSession, path: str, source: DataFrame, keys: str | Iterable[str], part: str, fmt: str = "parquet", **options
) -> DataFrame:
    """Merge into a table partitioned by ``part``, reading and writing only the partitions the source has rows for.

    ``part`` follows from the key (a range of ids, the day of an event), or is a
    part of it: a row stays in its partition for good. Which partitions are
    touched is found from the source when the job runs; the other files are
    neither read nor written. Returns the table.
    """
    keys = key_list(keys)
    stored = spark.read.schema(source.schema).format(fmt).load(path)
    touched = stored.join(source.select(part).distinct(), part, "left_semi").select(*source.columns)
    # merged partitions are written elsewhere first, as a job can't overwrite what it reads
    aside = sinks.write_snapshot(spark, merge(touched, source, list(dict.fromkeys([*keys, part])), **options), "touched", fmt)
    state = spark.read.schema(source.schema).format(fmt).load(aside)
    sinks.overwrite_partitions(state.repartition(part), path, [part], fmt)
    sinks.remove(spark, aside)
    return spark.read.schema(source.schema).format(fmt).load(path)


def run_mart_job(
    spark: SparkSession,
    sql: str,
    sources: Mapping[str, DataFrame],
    params: Mapping[str, dt.date | str | int] | None,
    table: str,
    sink: str = "overwrite",
    current_path: str | None = None,
    grain: str | Iterable[str] = "ReportingPeriod",
    fmt: str = "parquet",
) -> str:
    """Run a mart written as SQL and store it; return the new snapshot's path.

    ``sink="overwrite"`` replaces the mart, ``sink="merge"`` merges the run into
    the mart at ``current_path`` on its grain (created when there is none).
    """
    mart = run_mart(spark, sql, sources, params)
    if sink == "overwrite":
        state = mart
    elif sink == "merge":
        current = None if current_path is None else spark.read.format(fmt).load(current_path)
        state = merge_mart(current, mart, grain)
    else:
        raise ValueError(f"unknown mart sink {sink!r}")
    return sinks.write_snapshot(spark, state, table, fmt)


def run_job(
    spark: SparkSession,
    state: DataFrame,
    table: str,
    fmt: str = "parquet",
    bucket_by: Iterable[str] | None = None,
    buckets: int | None = None,
) -> str:
    """Write the job's result as a new snapshot of ``table``; return its path.

    With ``bucket_by`` and ``buckets`` the snapshot is a catalog table bucketed
    by the keys (its name is returned; read it with ``spark.table``), so the
    next run merges into it with ``co_partitions=buckets`` without shuffling it.
    """
    if bucket_by:
        if not buckets:
            raise ValueError("a bucketed table needs its number of buckets, chosen by its size")
        return sinks.write_bucketed(spark, state, table, list(bucket_by), buckets, fmt)
    return sinks.write_snapshot(spark, state, table, fmt)
