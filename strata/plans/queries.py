"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each reads the driver's tables (or what Spark derives from them) whole; the
fixed dates live in ``strata.plans.warehouse``. Keys that exercise a sink
write to fresh locations under the session's checkpoint folder and return
the table read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.cleaning import clean_strings, string_columns, valid_flag
from strata.functions.dates import is_open, within
from strata.functions.fingerprint import fingerprint, hashed_columns, with_row_hash
from strata.functions.keys import surrogate_key
from strata.operators.dedupe import dedupe_key, latest_per_key
from strata.operators.merge import merge
from strata.operators.reconcile import reconcile_counts
from strata.operators.scd2 import as_of_join, scd2_apply, scd2_as_of, scd2_current, scd2_seed
from strata.plans import layers, marts, periods, runlog, upkeep
from strata.plans.warehouse import CHANGE_DAY, LATER_DATE, RANGE_BEG, RANGE_END, REPORT_DATE, Warehouse
from strata.session import fresh_table_path
from strata.sources import sinks
from strata.sources.fixtures import Store, rollup_orderdetails
from strata.sources.runs import read_runs_json, runs_from_events
from strata.sources.tables import read_sources
from strata.streaming.incremental import incremental_load, upsert_step

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the test scenarios.
PERIOD_FILTER = (dt.date(1997, 1, 1), dt.date(1998, 12, 31))
# The mart merged into: run up to the middle of June 1999, then the next run from June 1999.
EARLIER_RUN = (dt.date(1995, 1, 1), dt.date(1999, 6, 15))
LATER_RUN = (dt.date(1999, 6, 1), dt.date(2001, 12, 31))
# Earlier loads: order lines shipped before 1998, events before 16 January 2024.
EARLIER_SHIP_DAY = "1998-01-01"
EARLIER_EVENTS = "2024-01-16"
# When the rows of an earlier and of a later load were written: a column that a
# merge only sets where it takes a row from the source.
FIRST_LOAD = dt.date(2000, 1, 1)
SECOND_LOAD = dt.date(2000, 6, 1)
# New customers and daily orders: an earlier run and a later one that overlaps it.
EARLIER_MONTHS = (dt.date(1995, 1, 1), dt.date(1995, 6, 20))
LATER_MONTHS = (dt.date(1995, 6, 15), dt.date(1995, 12, 31))
EARLIER_DAYS = (dt.date(1996, 3, 15), dt.date(1998, 2, 10))
LATER_DAYS = (dt.date(1998, 2, 5), dt.date(1999, 10, 20))


# --- step 1: flagship ---------------------------------------------------------------


def mart_city_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return marts.city_sales(w.fct_orders, w.dim_addresses, w.orderdetails_by_order, w.dim_items, REPORT_DATE)


# --- step 2: read side --------------------------------------------------------------


def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    a = scd2_current(w.dim_addresses)
    o = w.fct_orders
    return o.join(a, o.addressId == a.id).select(
        o.id.alias("orderId"), "customerId", "city", "state", "country"
    )


def mart_geo_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return marts.geo_orders(w.fct_orders, w.dim_addresses)


def mart_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return marts.product_performance(w.fct_orderdetails, w.dim_items, REPORT_DATE)


def mart_city_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return marts.city_delivery(w.dim_addresses, w.fct_orders, REPORT_DATE)


def mart_vip_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return marts.vip_cities(w.dim_customers, w.fct_orders, w.dim_addresses, REPORT_DATE)


def mart_orders_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.orders_monthly(Store(spark, sf_dir).fct_orders, RANGE_BEG, RANGE_END)


def mart_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    return marts.new_customers_monthly(w.dim_customers, RANGE_BEG, RANGE_END, REPORT_DATE)


def mart_orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.orders_daily(Store(spark, sf_dir).fct_orders, RANGE_BEG, RANGE_END)


def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Store(spark, sf_dir).fct_orders.filter(within("deliveryDate", *PERIOD_FILTER))


def orderdetails_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Store(spark, sf_dir).fct_orderdetails


def surrogate_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Store(spark, sf_dir).raw_orderdetails
    return raw.select(surrogate_key("itemId", "orderId").alias("id"), "orderId", "itemId", "quantity")


# --- step 3: cleaning -------------------------------------------------------------


def clean_strings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(Store(spark, sf_dir).addresses)


def valid_flag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Store(spark, sf_dir).addresses
    return a.select("id", valid_flag(a, string_columns(a)).alias("validFlag"))


def mart_valid_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.valid_addresses(Warehouse(spark, sf_dir).dim_addresses, REPORT_DATE)


# --- step 4: fingerprint and dedup ---------------------------------------------------


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Store(spark, sf_dir).customers
    cols = hashed_columns(c)
    return c.select(
        "id",
        fingerprint(cols, null_marker=None).alias("hash_plain"),
        fingerprint(cols).alias("hash"),
    )


def dedupe_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_key(Store(spark, sf_dir).customers_dup, "id", order_by=["load_no"])


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Store(spark, sf_dir).raw("events")
    return latest_per_key(events, ["event_type", "user_id"], ["ts", "event_id"])


# --- step 5: merge ------------------------------------------------------------------


def upsert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Store(spark, sf_dir)
    return merge(s.customers_s1, dedupe_key(s.customers_s2, "id"), "id")


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-detecting upsert into a table stored bucketed by id: the table is merged in place."""
    s = Store(spark, sf_dir)
    buckets = sinks.default_buckets(spark)
    first = with_row_hash(s.customers_s1).withColumn("loaded_on", F.lit(FIRST_LOAD))
    table = sinks.write_bucketed(spark, first, "customers", ["id"], buckets)
    second = with_row_hash(s.customers_s2).withColumn("loaded_on", F.lit(SECOND_LOAD))
    merged = merge(spark.table(table), second, "id", when_changed="hash", co_partitions=buckets)
    out = sinks.read_snapshot(spark, sinks.write_snapshot(spark, merged, "customers"))
    sinks.drop_bucketed(spark, table)
    return out


def _tasks_log(events: DataFrame) -> DataFrame:
    return runlog.latest_tasks(runlog.flatten_tasks(runs_from_events(events)))


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of an earlier listing, and of a later one that leaves some users out."""
    events = Store(spark, sf_dir).raw("events")
    earlier = events.filter(F.col("ts") < F.lit(EARLIER_EVENTS).cast("timestamp_ntz"))
    return earlier, events.filter(F.col("user_id") % 11 != 3)


def upsert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks log's own load day survives; runs that are no longer listed stay."""
    earlier, later = _listings(spark, sf_dir)
    stored = _tasks_log(earlier).withColumn("loaded_on", F.lit(FIRST_LOAD))
    return merge(stored, _tasks_log(later), ["job_run_id", "task_key"])


def upsert_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loaded_on`` isn't part of the hash: it only moves where the hash differs."""
    s = Store(spark, sf_dir)
    stored = with_row_hash(s.customers_s1).withColumn("loaded_on", F.lit(FIRST_LOAD))
    fresh = with_row_hash(s.customers_s2).withColumn("loaded_on", F.lit(SECOND_LOAD))
    return merge(stored, fresh, "id", when_changed="hash")


def upsert_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the quantity of known rows is set; new rows come whole, and rows of unlisted items stay."""
    s = Store(spark, sf_dir)
    stored = rollup_orderdetails(s.raw_orderdetails_shipped_before(EARLIER_SHIP_DAY)).withColumn("loaded_on", F.lit(FIRST_LOAD))
    fresh = s.fct_orderdetails.filter(F.col("itemId") % 13 != 5).withColumn("loaded_on", F.lit(SECOND_LOAD))
    return layers.merge_quantities(stored, fresh)


def mart_new_customers_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New customers merged at the mart's whole grain, in the partitions of the months a run covers."""
    w = Warehouse(spark, sf_dir)
    path = fresh_table_path(spark, "dm_new_customers_by_period")
    grain = ["ReportingPeriod", "type", "status"]
    for beg, exp, day in ((*EARLIER_MONTHS, REPORT_DATE), (*LATER_MONTHS, LATER_DATE)):
        run = marts.new_customers_monthly(w.dim_customers, beg, exp, day)
        out = layers.write_mart_periods(spark, run, path, grain=grain)
    return out.select(*grain, "NewCustomerNumber")


def mart_orders_daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily orders: two overlapping runs merged into a table addressed by its name."""
    orders = Store(spark, sf_dir).fct_orders
    name = f"agg_orders_daily_{uuid.uuid4().hex}"
    for days in (EARLIER_DAYS, LATER_DAYS):
        run = marts.orders_daily(orders, *days)
        sinks.publish(spark, name, layers.merge_mart(sinks.current(spark, name), run))
    return sinks.current(spark, name)


# A mart as its owner writes it: SQL over named sources with typed parameters.
ORDERS_BY_STATE_SQL = """
with valid as (select id, state from dim_addresses where :report_date >= beg_date and :report_date < exp_date)
select v.state, count_if(o.deliveredOn is not null) as Delivered, count(*) as Orders
from valid v join fct_orders o on o.addressId = v.id
where o.deliveryDate >= :first_day
group by v.state
"""


def mart_runner_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart job from SQL text: sources read by name from a layer, result stored and read back."""
    w = Warehouse(spark, sf_dir)
    base = fresh_table_path(spark, "processing")
    sinks.overwrite(w.dim_addresses, f"{base}/dim_addresses.parquet")
    sinks.overwrite(w.fct_orders, f"{base}/fct_orders.parquet")
    sources = read_sources(spark, base, "dim_addresses, fct_orders", register=False)  # the runner registers them while it needs them
    params = {"report_date": LATER_DATE, "first_day": RANGE_BEG}
    return sinks.read_snapshot(spark, layers.run_mart_job(spark, ORDERS_BY_STATE_SQL, sources, params, "dm_orders_by_state"))


def mart_merge_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly orders mart: first run creates the table, second run merges by period."""
    orders = Store(spark, sf_dir).fct_orders
    path = fresh_table_path(spark, "dm_orders_monthly")
    sinks.create_if_absent(marts.orders_monthly(orders, *EARLIER_RUN), path)
    current = sinks.read_snapshot(spark, path)
    merged = merge(current, marts.orders_monthly(orders, *LATER_RUN), "ReportingPeriod")
    return sinks.read_snapshot(spark, sinks.write_snapshot(spark, merged, "dm_orders_monthly"))


def mart_period_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly orders mart partitioned by period: the second run rewrites only its months."""
    orders = Store(spark, sf_dir).fct_orders
    path = fresh_table_path(spark, "dm_orders_monthly_by_period")
    layers.write_mart_periods(spark, marts.orders_monthly(orders, *EARLIER_RUN), path)
    return layers.write_mart_periods(spark, marts.orders_monthly(orders, *LATER_RUN), path)


# --- step 6: history ----------------------------------------------------------------


def scd2_seed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_seed(Store(spark, sf_dir).customers_s1)


def scd2_apply_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load applied anew by every run; the marts read the stored table."""
    return Warehouse(spark, sf_dir).customers_after_two_loads()


def scd2_current_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_current(Warehouse(spark, sf_dir).dim_customers)


def scd2_third_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third load and its same-day correction over a stored table that has closed history."""
    return Warehouse(spark, sf_dir).customers_after_third_load()


def scd2_default_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without a date takes the current one, the same for all rows: days since it are zero."""
    s = Store(spark, sf_dir)
    dim = scd2_apply(scd2_seed(s.customers_s1), s.customers_s2)
    days = F.when(F.col("beg_date") > F.lit(SECOND_LOAD), F.datediff(F.current_date(), "beg_date"))
    return dim.select("id", "type", "status", days.alias("days_since"), is_open().alias("is_open"))


def asof_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_as_of(Warehouse(spark, sf_dir).dim_customers_third, REPORT_DATE)


def asof_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_as_of(Warehouse(spark, sf_dir).dim_customers_third, CHANGE_DAY)


def asof_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_as_of(Warehouse(spark, sf_dir).dim_customers_third, LATER_DATE)


def asof_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_as_of(Warehouse(spark, sf_dir).dim_customers_third, CHANGE_DAY, inclusive=True)


def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir)
    orders = w.fct_orders
    j = as_of_join(orders, w.dim_customers, "customerId", REPORT_DATE)
    return j.select(
        orders.id.alias("orderId"), "customerId", "type", "status", "deliveryDate", "beg_date"
    )


# --- step 7: operations -------------------------------------------------------------


def bootstrap_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Store(spark, sf_dir)
    path = fresh_table_path(spark, "customers")
    sinks.create_if_absent(s.customers_s1, path)
    sinks.create_if_absent(s.customers_s2, path)  # table exists: nothing written
    return sinks.read_snapshot(spark, path)


def ingest_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Store(spark, sf_dir)
    path = fresh_table_path(spark, "customers")
    sinks.overwrite(s.customers_s1, path)
    sinks.overwrite(s.customers_s2, path)
    return sinks.read_snapshot(spark, path)


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load written, the second load's rows appended (sink A6)."""
    dup = Store(spark, sf_dir).customers_dup
    path = fresh_table_path(spark, "customers_loads")
    sinks.overwrite(dup.filter(F.col("load_no") == 1), path)
    sinks.append(dup.filter(F.col("load_no") == 2), path)
    return sinks.read_snapshot(spark, path)


def reconcile_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = Store(spark, sf_dir).customers_dup
    return reconcile_counts(source, dedupe_key(source, "id", order_by=["load_no"]))


def reconcile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = Store(spark, sf_dir).customers_dup
    return reconcile_counts(source, dedupe_key(source, "id", order_by=["load_no"]), "id")


def reporting_periods_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Store(spark, sf_dir).raw("orders")
    calendar = orders.select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    return periods.reporting_periods(calendar)


def period_rollup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.period_rollup(Store(spark, sf_dir).fct_orders, "deliveryDate", measure="Orders_Number")


# --- step 8: run log ----------------------------------------------------------------


def runlog_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_from_events(Store(spark, sf_dir).raw("events"))
    return runlog.flatten_jobs(runs, runlog.job_names(spark))


def runlog_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs log from a run listing stored as nested JSON, read with its fixed schema."""
    path = fresh_table_path(spark, "runs_json")
    runs_from_events(Store(spark, sf_dir).raw("events")).write.json(path)
    return runlog.flatten_jobs(read_runs_json(spark, path), runlog.job_names(spark))


def runlog_jobs_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs log of an earlier listing, upserted on ``job_run_id`` with a later one."""
    earlier, later = _listings(spark, sf_dir)
    names = runlog.job_names(spark)
    stored = runlog.flatten_jobs(runs_from_events(earlier), names).withColumn("loaded_on", F.lit(FIRST_LOAD))
    return merge(stored, runlog.flatten_jobs(runs_from_events(later), names), "job_run_id")


def runlog_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tasks_log(Store(spark, sf_dir).raw("events"))


# --- incremental (Structured Streaming) -------------------------------------------


def stream_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per (event_type, user) kept up to date by a file stream over ``events``, a file at a time."""
    events = Store(spark, sf_dir).raw("events")
    arrived = fresh_table_path(spark, "events_in")
    events.repartition(3, "event_id").write.parquet(arrived)
    out = incremental_load(
        spark,
        arrived,
        events.schema,
        initial=None,
        table_root=fresh_table_path(spark, "latest_events"),
        checkpoint=fresh_table_path(spark, "latest_events_checkpoint"),
        step=upsert_step(["event_type", "user_id"], order_by=["ts", "event_id"]),
        files_per_batch=1,
    )
    return spark.read.parquet(out)


QUERIES: dict[str, Query] = {
    "mart_city_sales": mart_city_sales,
    "join_inner": join_inner,
    "mart_geo_orders": mart_geo_orders,
    "mart_product_performance": mart_product_performance,
    "mart_city_delivery": mart_city_delivery,
    "mart_vip_cities": mart_vip_cities,
    "mart_orders_monthly": mart_orders_monthly,
    "mart_new_customers": mart_new_customers,
    "mart_orders_daily": mart_orders_daily,
    "period_filter": period_filter,
    "orderdetails_rollup": orderdetails_rollup,
    "surrogate_key": surrogate_key_q,
    "clean_strings": clean_strings_q,
    "valid_flag": valid_flag_q,
    "mart_valid_addresses": mart_valid_addresses,
    "row_hash": row_hash,
    "dedupe_key": dedupe_key_q,
    "dedupe_latest": dedupe_latest,
    "upsert_all": upsert_all,
    "upsert_bucketed": upsert_bucketed,
    "upsert_composite": upsert_composite,
    "upsert_if_changed": upsert_if_changed,
    "upsert_column": upsert_column,
    "mart_merge_period": mart_merge_period,
    "mart_period_partitions": mart_period_partitions,
    "scd2_seed": scd2_seed_q,
    "scd2_apply": scd2_apply_q,
    "scd2_current": scd2_current_q,
    "scd2_third_load": scd2_third_load,
    "scd2_default_date": scd2_default_date,
    "asof_before": asof_before,
    "asof_after": asof_after,
    "asof_dim": asof_dim,
    "asof_inclusive": asof_inclusive,
    "asof_join": asof_join,
    "bootstrap_ignore": bootstrap_ignore,
    "ingest_overwrite": ingest_overwrite,
    "append_load": append_load,
    "reconcile_counts": reconcile_counts_q,
    "reconcile_keys": reconcile_keys,
    "reporting_periods": reporting_periods_q,
    "period_rollup": period_rollup_q,
    "runlog_jobs": runlog_jobs,
    "runlog_tasks": runlog_tasks,
    "runlog_jobs_upsert": runlog_jobs_upsert,
    "runlog_from_json": runlog_from_json,
    "mart_new_customers_merge": mart_new_customers_merge,
    "mart_orders_daily_merge": mart_orders_daily_merge,
    "mart_runner_sql": mart_runner_sql,
    "stream_latest_events": stream_latest_events,
    **upkeep.QUERIES,
}
