"""The aggregation layer: each mart is a function of DataFrames and typed dates.

Dimensions are SCD2 tables (``hash, beg_date, exp_date``); ``report_date``
picks the version valid on that day (half-open unless ``inclusive``). Where a
fact is much larger than the result, it is aggregated before it is joined
(order lines to orders, orders to (customer, address) pairs), so the joins
move pre-reduced rows and the partial aggregates collapse hot keys map-side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import as_date, day_label, month_label, within
from strata.functions.numeric import ratio_half_up
from strata.operators.scd2 import scd2_as_of
from strata.sources.tables import register_views

REVENUE = "decimal(38,4)"
UNITS = "decimal(38,2)"

# The VIP customer status and the labels of the validity mart.
VIP = "VIP"
VALID = "Valid"
INVALID = "Invalid"


def city_sales(
    orders: DataFrame,
    addresses: DataFrame,
    orderdetails: DataFrame,
    items: DataFrame,
    report_date: dt.date | str,
    inclusive: bool = False,
) -> DataFrame:
    """Delivered orders by city: distinct orders and revenue (quantity x as-of price)."""
    it = scd2_as_of(items, report_date, inclusive).select(F.col("id").alias("itemId"), "price")
    ad = scd2_as_of(addresses, report_date, inclusive).select(F.col("id").alias("addressId"), "city")
    delivered = orders.filter(F.col("deliveredOn").isNotNull()).select(
        F.col("id").alias("orderId"), "addressId"
    )
    # Orders meet their lines first, partitioned by orderId: lines of
    # undelivered orders are gone before anything is priced, and where items
    # are small enough to be broadcast the rows stay where they are for the sum
    # per order and city, so the lines move once.
    lines = orderdetails.select("orderId", "itemId", "totalQuantity")
    per_order = (
        delivered.join(ad, "addressId")
        .join(lines, "orderId")
        .join(it, "itemId")
        .groupBy("orderId", "city")
        .agg(F.sum(F.col("totalQuantity") * F.col("price")).alias("revenue"))
    )
    return per_order.groupBy("city").agg(
        F.count(F.lit(1)).alias("TotalOrders"), F.sum("revenue").cast(REVENUE).alias("TotalRevenue")
    )


def vip_cities(
    customers: DataFrame,
    orders: DataFrame,
    addresses: DataFrame,
    report_date: dt.date | str,
    k: int = 5,
    inclusive: bool = False,
) -> DataFrame:
    """Top ``k`` cities by distinct VIP customers who ordered to an address there."""
    vip = (
        scd2_as_of(customers, report_date, inclusive)
        .filter(F.col("status") == VIP)
        .select(F.col("id").alias("customerId"))
    )
    ad = scd2_as_of(addresses, report_date, inclusive).select(F.col("id").alias("addressId"), "city")
    # VIPs first: the orders move once, by customer, and that partitioning
    # serves the distinct pairs; only those reach the addresses.
    per_city = (
        orders.select("customerId", "addressId")
        .join(vip, "customerId")
        .distinct()
        .join(ad, "addressId")
        .select("city", "customerId")
        .distinct()
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("NumberOfVIPCustomers"))
    )
    return per_city.orderBy(F.col("NumberOfVIPCustomers").desc(), F.col("city").asc()).limit(k)


def valid_addresses(addresses: DataFrame, report_date: dt.date | str, inclusive: bool = False) -> DataFrame:
    """Address versions valid on the day, counted as 'Valid' / 'Invalid'."""
    label = F.when(F.col("validFlag") == 1, VALID).otherwise(INVALID)
    return (
        scd2_as_of(addresses, report_date, inclusive)
        .groupBy(label.alias("validFlag"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def city_delivery(
    addresses: DataFrame, orders: DataFrame, report_date: dt.date | str, inclusive: bool = False
) -> DataFrame:
    """Orders per city and mean delivery delay in hours (2 decimals).

    Undelivered orders count as orders but stay out of the mean.
    """
    ad = scd2_as_of(addresses, report_date, inclusive).select(F.col("id").alias("addressId"), "city")
    delay = F.datediff("deliveredOn", "deliveryDate")
    # Sums and counts per address first (exact): one row of an address is moved
    # for each task, however many orders it has.
    per_address = orders.groupBy("addressId").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(delay).alias("days"), F.count(delay).alias("delivered")
    )
    return (
        per_address.join(ad, "addressId")
        .groupBy("city")
        .agg(
            F.sum("orders").alias("OrdersCount"),
            ratio_half_up(F.sum("days") * 24, F.sum("delivered"), 2).alias("AvgHoursDelivery"),
        )
    )


def new_customers_monthly(
    customers: DataFrame,
    beg_date: dt.date | str,
    exp_date: dt.date | str,
    report_date: dt.date | str,
    inclusive: bool = False,
) -> DataFrame:
    """Customers created in [beg, exp] by month, type and status, as of the report day."""
    return (
        scd2_as_of(customers, report_date, inclusive)
        .filter(within("createdOn", beg_date, exp_date))
        .groupBy(month_label("createdOn").alias("ReportingPeriod"), "type", "status")
        .agg(F.count(F.lit(1)).alias("NewCustomerNumber"))
    )


def orders_monthly(orders: DataFrame, beg_date: dt.date | str, exp_date: dt.date | str) -> DataFrame:
    """Orders per planned-delivery month within [beg, exp]."""
    return (
        orders.filter(within("deliveryDate", beg_date, exp_date))
        .groupBy(month_label("deliveryDate").alias("ReportingPeriod"))
        .agg(F.count(F.lit(1)).alias("Orders_Number"))
    )


def orders_daily(orders: DataFrame, beg_date: dt.date | str, exp_date: dt.date | str) -> DataFrame:
    """Orders per planned-delivery day within [beg, exp] (``ReportingPeriod`` = yyyy-MM-dd)."""
    return (
        orders.filter(within("deliveryDate", beg_date, exp_date))
        .groupBy(day_label("deliveryDate").alias("ReportingPeriod"))
        .agg(F.count(F.lit(1)).alias("Orders_Number"))
    )


def geo_orders(
    orders: DataFrame, addresses: DataFrame, report_date: dt.date | str | None = None
) -> DataFrame:
    """Distinct orders by country and state.

    Without ``report_date`` every version of an address joins, so an order
    counts in each state its address ever had.
    """
    ad = addresses if report_date is None else scd2_as_of(addresses, report_date)
    ad = ad.select(F.col("id").alias("addressId"), "country", "state")
    return (
        orders.select("id", "addressId")
        .join(ad, "addressId")
        .groupBy("country", "state")
        .agg(F.count_distinct("id").alias("OrdersCount"))
    )


def product_performance(
    orderdetails: DataFrame, items: DataFrame, report_date: dt.date | str, inclusive: bool = False
) -> DataFrame:
    """Units and revenue by product code and description, at the as-of price.

    Order lines are summed per item first (exact: one price per item version),
    so only one row per item reaches the join.
    """
    units = orderdetails.groupBy("itemId").agg(F.sum("totalQuantity").alias("units"))
    it = scd2_as_of(items, report_date, inclusive)
    return (
        units.join(it, units.itemId == it.id)
        .groupBy("Codes", "Descriptions")
        .agg(
            F.sum("units").cast(UNITS).alias("TotalUnitsSold"),
            F.sum(F.col("units") * F.col("price")).cast(REVENUE).alias("TotalRevenue"),
        )
    )


def run_mart(
    spark: SparkSession,
    sql: str,
    sources: Mapping[str, DataFrame],
    params: Mapping[str, dt.date | str | int] | None = None,
) -> DataFrame:
    """Run a mart written as SQL text over named sources.

    Sources are registered as temp views under their names; parameters are
    bound as literals of their Python type (``:report_date``), never formatted
    into the text. Views that the session had under these names are put back.
    """
    if not sql or not sql.strip():
        raise ValueError("mart SQL is empty")
    before = {n: spark.table(n) for n in sources if any(t.isTemporary and t.name == n for t in spark.catalog.listTables())}
    register_views(sources)
    try:
        return spark.sql(sql, args=dict(params or {}))
    finally:
        for name in sources:
            spark.catalog.dropTempView(name)
        register_views(before)
