"""Queries over tables that change: as-of by the row's own date, late loads, marts and sets kept up, differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import is_open, month_label, within
from strata.functions.fingerprint import with_row_hash
from strata.functions.numeric import ratio_half_up
from strata.operators.asof import as_of_join_by_date
from strata.operators.deltas import ROWS, apply_changes, state_changes, state_of
from strata.operators.digest import differences
from strata.operators.distinct import distinct_counts, distinct_state
from strata.operators.merge import merge_actions, merge_changes
from strata.operators.scd2 import scd2_apply, scd2_as_of
from strata.operators.splice import scd2_replay, scd2_splice
from strata.plans import layers, marts, periods, runlog
from strata.plans.marts import REVENUE
from strata.plans.warehouse import REPORT_DATE, RETIRED_DATE, THIRD_DATE, Warehouse
from strata.session import fresh_table_path
from strata.sources import sinks
from strata.sources.drifting import rejected_lines, runs_of
from strata.sources.fixtures import Store, rollup_orderdetails
from strata.sources.observed import write_merged
from strata.sources.runs import from_epoch_ms, runs_from_events
from strata.streaming.stateful import append_first_seen, append_latest

# Fixed values of the test scenarios: when the loads were made, and the one that came late.
SEED_DATE, EFFECTIVE_DATE, LATE_DATE, FOURTH_DATE = dt.date(2000, 1, 15), dt.date(2000, 6, 1), dt.date(2000, 7, 15), dt.date(2000, 12, 1)
# An earlier state of the orders: placed before 1999, and delivered as far as known by 1998.
PLACED_BEFORE, KNOWN_BEFORE = dt.date(1999, 1, 1), dt.date(1998, 1, 1)
EARLIER_SHIP_DAY = "1998-01-01"
FIRST_LOAD, SECOND_LOAD, RANGE = dt.date(2000, 1, 1), dt.date(2000, 6, 1), 100
EARLIER_RUN = (dt.date(1995, 1, 1), dt.date(1999, 6, 15))
LATER_RUN = (dt.date(1999, 6, 1), dt.date(2001, 12, 31))


# --- as-of by the fact's own date -------------------------------------------------------


def asof_by_fact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its customer as of the planned delivery; none where the customer was closed then."""
    w = Warehouse(spark, sf_dir)
    columns = {"type": "type", "status": "status", "beg_date": "valid_from"}
    j = as_of_join_by_date(w.fct_orders, w.dim_customers_third, "customerId", "deliveryDate", columns, how="left")
    return j.select(F.col("id").alias("orderId"), "customerId", "deliveryDate", *columns.values())


def mart_sales_on_the_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by month and city, each order at the prices and the address of its planned delivery day."""
    w = Warehouse(spark, sf_dir)
    orders = w.fct_orders.select(F.col("id").alias("orderId"), "addressId", "deliveryDate")
    placed = as_of_join_by_date(orders, w.dim_addresses, "addressId", "deliveryDate", {"city": "city"})
    lines = placed.join(w.orderdetails_by_order.select("orderId", "itemId", "totalQuantity"), "orderId")
    # one row for each item, city and day that it was ordered
    sold = lines.groupBy("itemId", "city", "deliveryDate").agg(F.sum("totalQuantity").alias("units"))
    priced = as_of_join_by_date(sold, w.dim_items, "itemId", "deliveryDate", {"price": "price"})
    return priced.groupBy(month_label("deliveryDate").alias("ReportingPeriod"), "city").agg(
        F.sum("units").cast("decimal(38,2)").alias("TotalUnits"), F.sum(F.col("units") * F.col("price")).cast(REVENUE).alias("TotalRevenue")
    )


# --- loads out of order -----------------------------------------------------------------


def scd2_late_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of July that arrives after the one of September, over a table with closed versions."""
    w = Warehouse(spark, sf_dir)
    two = w.dim_customers
    retired = F.when(is_open() & (F.col("id") % 17 == 5), F.lit(RETIRED_DATE)).otherwise(F.col("exp_date"))
    three = scd2_apply(two.withColumn("exp_date", retired), w.store.customers_s3, THIRD_DATE)
    return scd2_splice(three, w.store.customers_late, LATE_DATE, next_load=THIRD_DATE)


def scd2_replay_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension from four loads at once, the latest first."""
    s = Store(spark, sf_dir)
    loads = [(FOURTH_DATE, s.customers_s4), (EFFECTIVE_DATE, s.customers_s2), (THIRD_DATE, s.customers_s3), (SEED_DATE, s.customers_s1)]
    dated = [df.withColumn("loaded_on", F.lit(day)) for day, df in loads]
    every = dated[0]
    for df in dated[1:]:
        every = every.unionByName(df)
    return scd2_replay(every, "loaded_on")


# --- marts kept up by change sets -------------------------------------------------------


def mart_city_delivery_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City delivery of an earlier state of the orders, brought up to date by what a later load changes."""
    w = Warehouse(spark, sf_dir)
    orders = w.fct_orders
    known = F.when(F.col("deliveredOn") < F.lit(KNOWN_BEFORE), F.col("deliveredOn"))
    stored = orders.filter(F.col("deliveryDate") < F.lit(PLACED_BEFORE)).withColumn("deliveredOn", known)
    fresh = orders.filter(F.col("id") % 13 != 5)
    ad = scd2_as_of(w.dim_addresses, REPORT_DATE).select(F.col("id").alias("addressId"), "city")
    measures = {"days": F.datediff("deliveredOn", "deliveryDate"), "delivered": F.when(F.col("deliveredOn").isNotNull(), 1)}

    def with_city(rows: DataFrame) -> DataFrame:
        return rows.join(ad, "addressId")

    state = state_of(with_city(stored), ["city"], measures)
    state = apply_changes(state, with_city(merge_changes(stored, fresh, "id")), ["city"], measures)
    mean = ratio_half_up(F.col("days") * 24, F.col("delivered"), 2)
    return state.select("city", F.col(ROWS).alias("OrdersCount"), mean.alias("AvgHoursDelivery"))


def mart_city_sales_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City sales brought up to date by changed order lines: a state by order, and on it the one by city."""
    w = Warehouse(spark, sf_dir)
    stored = rollup_orderdetails(w.store.raw_orderdetails_shipped_before(EARLIER_SHIP_DAY))
    fresh = w.fct_orderdetails.filter(F.col("itemId") % 13 != 5)
    it = scd2_as_of(w.dim_items, REPORT_DATE).select(F.col("id").alias("itemId"), "price")
    ad = scd2_as_of(w.dim_addresses, REPORT_DATE).select(F.col("id").alias("addressId"), "city")
    delivered = w.fct_orders.filter(F.col("deliveredOn").isNotNull()).select(F.col("id").alias("orderId"), "addressId")
    sold: dict[str, Column] = {"revenue": F.col("totalQuantity") * F.col("price")}

    def priced(lines: DataFrame) -> DataFrame:
        return lines.join(it, "itemId").join(delivered, "orderId").join(ad, "addressId")

    changes = merge_changes(stored, fresh, ["orderId", "itemId"], when_changed="totalQuantity", update_cols=["totalQuantity"], refuse_null_keys=True)
    by_order = state_of(priced(stored), ["orderId", "city"], sold)
    by_city = state_of(by_order, ["city"], {"revenue": F.col("revenue")})
    of_orders = state_changes(by_order, priced(changes), ["orderId", "city"], sold)
    by_city = apply_changes(by_city, of_orders, ["city"], {"revenue": F.col("revenue")})
    return by_city.select("city", F.col(ROWS).alias("TotalOrders"), F.col("revenue").cast(REVENUE).alias("TotalRevenue"))


# --- distinct counts over periods -------------------------------------------------------


def mart_customers_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ordering customers by month, quarter and year, from stored sets of months that two runs wrote."""
    orders = Store(spark, sf_dir).fct_orders
    path = fresh_table_path(spark, "customers_by_month")
    for run in (EARLIER_RUN, LATER_RUN):
        rows = orders.filter(within("deliveryDate", *run))
        months = distinct_state(rows, [F.trunc("deliveryDate", "MM").alias("month")], "customerId")
        sets = layers.write_mart_periods(spark, months, path, period="month")
    out = None
    for frequency, unit in (("monthly", "MM"), ("quarterly", "QUARTER"), ("yearly", "YEAR")):
        counts = distinct_counts(sets, [F.trunc("month", unit).alias("beg_date")], "Customers").withColumn("frequency", F.lit(frequency))
        out = counts if out is None else out.unionByName(counts)
    return out


# --- where tables differ ----------------------------------------------------------------


def reconcile_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which customers a faulty copy of the second load lacks, has changed, has twice, or has kept from the first."""
    s = Store(spark, sf_dir)
    copied = s.customers_s2.filter(F.col("id") % 97 != 3).withColumn("status", F.when(F.col("id") % 89 == 5, "LOST").otherwise(F.col("status")))
    twice = copied.filter(F.col("id") % 101 == 7)
    kept = s.customers_s1.filter(F.col("id") % 50 == 49)
    return differences(s.customers_s2, copied.unionByName(twice).unionByName(kept), "id")


# --- loads that measure themselves, and touch what they change --------------------------


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load did, as the write itself counted it: rows inserted, updated, kept, absent, and without a first order."""
    s = Store(spark, sf_dir)
    actions = merge_actions(with_row_hash(s.customers_s1), with_row_hash(s.customers_s2), "id", when_changed="hash")
    _, report = write_merged(spark, actions, "customers", invalid=F.col("createdOn").isNull())
    return spark.createDataFrame([tuple(report.values())], ", ".join(f"{k} long" for k in report))


def upsert_touched_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that lists some ranges of ids, merged into a table partitioned by these; other partitions stay as they are."""
    s = Store(spark, sf_dir)
    span = F.floor(F.col("id") / RANGE).cast("long").alias("id_range")
    path = fresh_table_path(spark, "customers_by_range")
    stored = with_row_hash(s.customers_s1).withColumn("loaded_on", F.lit(FIRST_LOAD)).select("*", span)
    sinks.overwrite(stored.repartition("id_range"), path, partition_by=["id_range"])
    fresh = with_row_hash(s.customers_s2).withColumn("loaded_on", F.lit(SECOND_LOAD)).select("*", span)
    listed = fresh.filter(F.col("id_range") % 5 == 1)
    return layers.merge_touched(spark, path, listed, "id", "id_range", when_changed="hash").drop("id_range")


def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads appended, the second one twice, as by a job that is started again: its rows are there once."""
    dup = Store(spark, sf_dir).customers_dup
    path = fresh_table_path(spark, "customers_loads")
    for load in (1, 2, 2):
        sinks.append_load(dup.filter(F.col("load_no") == load), path, load)
    return spark.read.parquet(path).select(*dup.columns)


def mart_city_sales_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City sales over orders and order lines that are stored bucketed by the order: neither is shuffled."""
    w = Warehouse(spark, sf_dir)
    # a bucket is read by one task, so their number follows the lines; dealt like that, each bucket is one sorted file
    buckets = w.order_partitions
    orders = sinks.write_bucketed(spark, w.fct_orders.repartition(buckets, "id"), "fct_orders", ["id"], buckets)
    lines = sinks.write_bucketed(spark, w.orderdetails_by_order, "fct_orderdetails", ["orderId"], buckets)
    mart = marts.city_sales(spark.table(orders), w.dim_addresses, spark.table(lines), w.dim_items, REPORT_DATE)
    out = sinks.read_snapshot(spark, sinks.write_snapshot(spark, mart, "dm_city_sales"))
    for table in (orders, lines):
        sinks.drop_bucketed(spark, table)
    return out


# --- run listings that drift ------------------------------------------------------------


def drifting_lines(events: DataFrame) -> DataFrame:
    """The run listing as lines of text, in the shapes it had over the years, some of them broken."""
    runs = runs_from_events(events)
    r, shape = F.col("run_id"), F.col("run_id") % 6
    iso = [F.concat(F.date_format(from_epoch_ms(F.col(c)), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")).alias(c) for c in ("start_time", "end_time")]
    times = F.struct(F.col("start_time").alias("start"), F.col("end_time").alias("end")).alias("times")
    state = F.col("state.result_state")
    line = (
        F.when(shape == 0, F.to_json(F.struct("run_id", "job_id", "start_time", "end_time", "state")))
        .when(shape == 1, F.to_json(F.struct(r.alias("id"), F.struct(F.col("job_id").alias("id")).alias("job"), times, state.alias("status"))))
        .when(shape == 2, F.to_json(F.struct("run_id", "job_id", *iso, state.alias("result_state"))))
        .when(shape == 3, F.concat(F.lit('{"run_id": '), r.cast("string"), F.lit(", broken")))
        .when(shape == 4, F.to_json(F.struct("job_id", "start_time", "end_time")))
        .otherwise(F.to_json(F.struct(r.cast("string").alias("run_id"), "job_id", "start_time", "end_time", "state", F.lit(1).alias("extra"))))
    )
    return runs.select(r.alias("of_run"), line.alias("value"))


def runlog_from_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs log of a drifting listing, read from text files, and its rejected lines with the reason."""
    path = fresh_table_path(spark, "runs_text")
    drifting_lines(Store(spark, sf_dir).raw("events")).select("value").write.text(path)
    lines = spark.read.text(path)
    jobs = runlog.flatten_jobs(runs_of(lines), runlog.job_names(spark)).withColumns({"line": F.lit(None).cast("string"), "rejected": F.lit(None).cast("string")})
    return jobs.unionByName(rejected_lines(lines).withColumnRenamed("value", "line"), allowMissingColumns=True)


# --- streams with a state store ---------------------------------------------------------


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that a source sends again are appended once, by a stream that forgets keys behind its watermark."""
    events = Store(spark, sf_dir).raw("events")
    arrived = fresh_table_path(spark, "events_sent")
    again = events.filter(F.col("event_type") == "error")
    events.unionByName(again).repartition(3, "user_id").write.parquet(arrived)
    return append_first_seen(
        spark, arrived, events.schema, "event_id", "ts", "40 days", fresh_table_path(spark, "events_once"), fresh_table_path(spark, "events_once_checkpoint"), files_per_batch=1
    )


def stream_latest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per (event_type, user) from a changelog that a stateful stream appends to."""
    events = Store(spark, sf_dir).raw("events")
    arrived = fresh_table_path(spark, "events_in")
    events.repartition(3, "event_id").write.parquet(arrived)
    return append_latest(
        spark, arrived, events.schema, ["event_type", "user_id"], ["ts", "event_id"], fresh_table_path(spark, "latest_log"), fresh_table_path(spark, "latest_checkpoint"), files_per_batch=1
    )


# --- periods without rows ---------------------------------------------------------------


def period_rollup_filled_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by city and period of every frequency, 0 where a city had none."""
    w = Warehouse(spark, sf_dir)
    ad = scd2_as_of(w.dim_addresses, REPORT_DATE).select(F.col("id").alias("addressId"), "city")
    return periods.period_rollup_filled(w.fct_orders.join(ad, "addressId"), "deliveryDate", ["city"], measure="Orders_Number")


QUERIES = {
    "asof_by_fact_date": asof_by_fact_date,
    "mart_sales_on_the_day": mart_sales_on_the_day,
    "scd2_late_load": scd2_late_load,
    "scd2_replay": scd2_replay_q,
    "mart_city_delivery_kept_up": mart_city_delivery_kept_up,
    "mart_city_sales_kept_up": mart_city_sales_kept_up,
    "mart_customers_distinct": mart_customers_distinct,
    "reconcile_differences": reconcile_differences,
    "load_report": load_report,
    "upsert_touched_ranges": upsert_touched_ranges,
    "append_rerun": append_rerun,
    "mart_city_sales_bucketed": mart_city_sales_bucketed,
    "runlog_from_drifting": runlog_from_drifting,
    "stream_first_seen": stream_first_seen,
    "stream_latest_changes": stream_latest_changes,
    "period_rollup_filled": period_rollup_filled_q,
}
