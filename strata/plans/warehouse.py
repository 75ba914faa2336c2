"""The processing layer of the store, derived from the ingestion tables.

The dimensions are SCD2 tables: the first load is seeded, the second applied on
``EFFECTIVE_DATE`` (addresses are cleaned and flagged first). Each is written
as a snapshot once for a state of its input files and read back by every mart,
as a scheduled job would leave it, so its size is known and as-of bounds reach
its scan. Facts are the ingestion tables as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.cleaning import clean_strings
from strata.functions.dates import is_open
from strata.operators.scd2 import scd2_apply, scd2_seed
from strata.sources import sinks
from strata.sources.fixtures import Store, rollup_orderdetails
from strata.sources.tables import table_path

# The day the second load is applied, and the days of the third
# load and of the closing of some versions between the two.
EFFECTIVE_DATE = dt.date(2000, 6, 1)
RETIRED_DATE = dt.date(2000, 7, 1)
THIRD_DATE = dt.date(2000, 9, 1)
# Report days: before the second load (the as-of marts), on the day itself
# (where half-open and closed ranges differ) and after all loads.
REPORT_DATE = dt.date(2000, 5, 31)
CHANGE_DAY = EFFECTIVE_DATE
LATER_DATE = dt.date(2001, 1, 1)
# Reporting range: inside the days that the data cover.
RANGE_BEG = dt.date(1996, 3, 15)
RANGE_END = dt.date(1999, 10, 20)
# Fixed value: the order lines that one task rolls up and joins, in under 1 GB of hash tables and sorts.
LINES_PER_TASK = 1_000_000


# Where a dimension was written, by application, inputs and their files' state.
_WRITTEN: dict[tuple, tuple[str, StructType]] = {}


class Warehouse:
    """Dimensions written on first use, and again when the files they come from change."""

    def __init__(self, spark: SparkSession, sf_dir: str, effective_date: dt.date = EFFECTIVE_DATE):
        self.spark = spark
        self.store = Store(spark, sf_dir)
        self.effective_date = effective_date

    def _stored(self, name: str, tables: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
        files = tuple(sinks.signature(self.spark, table_path(self.store.sf_dir, t)) for t in tables)
        key = (self.spark.sparkContext.applicationId, name, self.effective_date, files)
        path, schema = _WRITTEN.get(key, (None, None))
        if path is None or not sinks.exists(self.spark, path):
            df = build()
            path, schema = _WRITTEN[key] = sinks.write_snapshot(self.spark, df, name), df.schema
        return self.spark.read.schema(schema).parquet(path)

    def customers_after_two_loads(self) -> DataFrame:
        s = self.store
        return scd2_apply(scd2_seed(s.customers_s1), s.customers_s2, self.effective_date)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._stored("dim_customers", ("customer", "orders"), self.customers_after_two_loads)

    @cached_property
    def dim_items(self) -> DataFrame:
        s = self.store
        return self._stored("dim_items", ("part",), lambda: scd2_apply(scd2_seed(s.items), s.items_s2, self.effective_date))

    @cached_property
    def dim_addresses(self) -> DataFrame:
        def build() -> DataFrame:
            first = scd2_seed(clean_strings(self.store.addresses))
            return scd2_apply(first, clean_strings(self.store.addresses_s2), self.effective_date)

        return self._stored("dim_addresses", ("customer", "nation", "region"), build)

    @cached_property
    def dim_customers_third(self) -> DataFrame:
        return self._stored("dim_customers_third", ("customer", "orders"), self.customers_after_third_load)

    def customers_after_third_load(self) -> DataFrame:
        """Customers after a third load and its correction on the same day, over a table with closed history.

        Between the loads every seventeenth id lost its open version, so it
        returns with the third one. The table is stored bucketed by id: both
        loads merge into it in place. The result is a snapshot; the bucketed
        tables of the way there are removed.
        """
        buckets = sinks.default_buckets(self.spark)
        two = self.customers_after_two_loads()
        retired = F.when(is_open() & (F.col("id") % 17 == 5), F.lit(RETIRED_DATE)).otherwise(F.col("exp_date"))
        first = sinks.write_bucketed(self.spark, two.withColumn("exp_date", retired), "dim_customers", ["id"], buckets)
        third = scd2_apply(self.spark.table(first), self.store.customers_s3, THIRD_DATE, co_partitions=buckets)
        second = sinks.write_bucketed(self.spark, third, "dim_customers", ["id"], buckets)
        fourth = scd2_apply(self.spark.table(second), self.store.customers_s4, THIRD_DATE, co_partitions=buckets)
        out = sinks.read_snapshot(self.spark, sinks.write_snapshot(self.spark, fourth, "dim_customers"))
        for table in (first, second):
            sinks.drop_bucketed(self.spark, table)
        return out

    @property
    def fct_orders(self) -> DataFrame:
        return self.store.fct_orders

    @property
    def fct_orderdetails(self) -> DataFrame:
        return self.store.fct_orderdetails

    @cached_property
    def order_line_count(self) -> int:
        """Rows of the order lines, from the footers of their files."""
        return self.store.raw("lineitem").count()

    @property
    def order_partitions(self) -> int:
        """Partitions or buckets by order: as many as the session shuffles into, more where one would hold too many lines."""
        return sinks.default_buckets(self.spark, self.order_line_count, LINES_PER_TASK)

    @property
    def orderdetails_by_order(self) -> DataFrame:
        """The same rows, clustered by order: one shuffle of the lines serves the roll-up and joins to orders.

        Lines are few bytes in a shuffle and many in hash tables, so partitions
        coalesced by shuffled bytes would need gigabytes of a task. Lines that
        fill more than one task are dealt into a number of partitions by their rows.
        """
        lines = self.store.raw_orderdetails
        if self.order_line_count <= LINES_PER_TASK:
            return rollup_orderdetails(lines.repartition("orderId"))
        return rollup_orderdetails(lines.repartition(self.order_partitions, "orderId"))
