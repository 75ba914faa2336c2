"""The online store's raw tables, derived by Spark from the driver's testdata.

The warehouse works on customers, addresses, items, orders and order details
(plus job-run logs). The testdata is a TPC-H-like star schema, so each store
table is a projection of it; every definition here has a DuckDB twin in
``strata.plans.oracle`` and both run over the whole input tables.

Snapshots (``customers_s1`` -> ``customers_s2``, ``items`` -> ``items_s2``)
stand for two consecutive loads of a source: ids that change, appear or
disappear between the loads are chosen by a rule on the id.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key
from strata.sources.tables import read_table

MONEY = "decimal(18,2)"


def _to_date(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("date")


class Store:
    """Lazy DataFrames of the store tables for one testdata directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # --- ingestion-layer sources -------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        """id, type, status, createdOn (first order day; null without an order)."""
        first_order = self.raw("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("first_order")
        )
        c = self.raw("customer")
        return c.join(first_order, c.c_custkey == first_order.o_custkey, "left").select(
            c.c_custkey.alias("id"),
            c.c_mktsegment.alias("type"),
            F.when(c.c_acctbal > 9000, "VIP").otherwise("REGULAR").alias("status"),
            _to_date("first_order").alias("createdOn"),
        )

    @cached_property
    def addresses(self) -> DataFrame:
        """id, city, state, country: raw strings, some of them not clean."""
        c, n, r = self.raw("customer"), self.raw("nation"), self.raw("region")
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                c.c_custkey.alias("id"),
                F.when(c.c_custkey % 4 == 0, n.n_name)
                .otherwise(F.replace(n.n_name, F.lit("NATION_"), F.lit("Nation ")))
                .alias("city"),
                F.concat(F.lit("S"), (c.c_custkey % 3).cast("string")).alias("state"),
                F.concat(
                    F.upper(F.substring(r.r_name, 1, 1)), F.lower(F.expr("substr(r_name, 2)"))
                ).alias("country"),
            )
        )

    @cached_property
    def items(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            p.p_partkey.alias("id"),
            p.p_brand.alias("Codes"),
            p.p_name.alias("Descriptions"),
            p.p_retailprice.cast(MONEY).alias("price"),
        )

    @cached_property
    def fct_orders(self) -> DataFrame:
        """Planned delivery 30 days after the order; finished orders delivered 0-59 days after it."""
        o = self.raw("orders")
        day = _to_date("o_orderdate")
        return o.select(
            o.o_orderkey.alias("id"),
            o.o_custkey.alias("customerId"),
            o.o_custkey.alias("addressId"),
            F.date_add(day, 30).alias("deliveryDate"),
            F.when(o.o_orderstatus == "F", F.date_add(day, (o.o_orderkey % 60).cast("int"))).alias(
                "deliveredOn"
            ),
        )

    @cached_property
    def raw_orderdetails(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(
            li.l_orderkey.alias("orderId"),
            li.l_partkey.alias("itemId"),
            li.l_quantity.cast(MONEY).alias("quantity"),
        )

    def raw_orderdetails_shipped_before(self, day: str) -> DataFrame:
        """An earlier load of the order details: lines shipped before ``day``."""
        li = self.raw("lineitem")
        return li.filter(li.l_shipdate < F.lit(day).cast("timestamp_ntz")).select(
            li.l_orderkey.alias("orderId"),
            li.l_partkey.alias("itemId"),
            li.l_quantity.cast(MONEY).alias("quantity"),
        )

    @cached_property
    def fct_orderdetails(self) -> DataFrame:
        return rollup_orderdetails(self.raw_orderdetails)

    # --- two loads of one source ---------------------------------------------------

    @cached_property
    def customers_s1(self) -> DataFrame:
        return self.customers.filter(F.col("id") % 50 != 7)

    @cached_property
    def customers_s2(self) -> DataFrame:
        c = self.customers
        return c.filter(c.id % 25 != 24).select(
            "id",
            F.when(c.id % 10 == 0, "PREMIUM").otherwise(c.type).alias("type"),
            F.when(c.id % 10 == 3, "VIP").otherwise(c.status).alias("status"),
            "createdOn",
        )

    @cached_property
    def customers_s3(self) -> DataFrame:
        """A third load: every twelfth customer changes its type, every ninth isn't listed."""
        c = self.customers_s2
        return c.filter(c.id % 9 != 8).withColumn("type", F.when(c.id % 12 == 0, "PARTNER").otherwise(c.type))

    @cached_property
    def customers_s4(self) -> DataFrame:
        """The third load corrected on the same day."""
        c = self.customers_s3
        return c.withColumn("type", F.when(c.id % 24 == 0, "CORRECTED").otherwise(c.type))

    @cached_property
    def customers_late(self) -> DataFrame:
        """A load between the second and the third that arrives after both: some types of its own, some that
        the third load tells too, and customers that no other load lists."""
        c = self.customers_s2
        listed = c.filter(c.id % 7 != 6).withColumn("type", F.when(c.id % 6 == 1, "LATE").when(c.id % 24 == 0, "PARTNER").otherwise(c.type))
        unknown = self.customers.filter(F.col("id") % 40 == 3).withColumn("id", F.col("id") + 1_000_000)
        return listed.unionByName(unknown)

    @cached_property
    def addresses_s2(self) -> DataFrame:
        """A second load of addresses: every eighth has moved to another state and city."""
        a = self.addresses
        moved = a.id % 8 == 1
        return a.select(
            "id",
            F.when(moved, "Newtown").otherwise(a.city).alias("city"),
            F.when(moved, "S9").otherwise(a.state).alias("state"),
            "country",
        )

    @cached_property
    def items_s2(self) -> DataFrame:
        i = self.items
        raised = (i.price * F.lit(1.10).cast("decimal(4,2)")).cast(MONEY)
        return i.select(
            "id", "Codes", "Descriptions", F.when(i.id % 20 == 0, raised).otherwise(i.price).alias("price")
        )

    @cached_property
    def customers_dup(self) -> DataFrame:
        """A source with repeated keys: a second load of every hundredth customer."""
        c = self.customers
        first = c.withColumn("load_no", F.lit(1))
        again = c.filter(c.id % 100 == 0).select(
            "id", F.lit("DUP").alias("type"), "status", "createdOn", F.lit(2).alias("load_no")
        )
        return first.unionByName(again)


def rollup_orderdetails(raw: DataFrame) -> DataFrame:
    """Order lines -> one row per (order, item) with the summed quantity and a label id."""
    summed = raw.groupBy("orderId", "itemId").agg(F.sum("quantity").cast(MONEY).alias("totalQuantity"))
    return summed.select(
        surrogate_key("itemId", "orderId").alias("id"), "orderId", "itemId", "totalQuantity"
    )
