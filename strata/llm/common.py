"""Shared pieces of the operators: table access, tables written in the shared folder, running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import fresh_table_path

# Fixed value: the characters that separate words, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared checkpoint folder.

    Cuts the lineage, so a lost executor costs a re-read; and a join with the
    written table has plain exchanges on both sides, which adaptive execution
    can split when one key is hot (it cannot split a side that is itself an
    aggregate on the join key). The shuffle files of the run that wrote it are
    removed with it, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = fresh_table_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        # a plan takes the setting when it is made, so it is made anew here
        df.select("*").write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; null counts as no text."""
    # every word but one at the very start follows a separator
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def running_total(
    df: DataFrame,
    by: Sequence[str],
    slot: str,
    order: Sequence[Column],
    value: str,
    out: str,
) -> DataFrame:
    """Exclusive running sum of ``value`` within ``by``, in the order of ``slot`` then ``order``.

    No task sees a whole group: sums per (by, slot) are taken first, their
    running total gives each slot its start, and only rows of one slot are
    ordered together. ``slot`` has to ascend with the wanted order and to be
    fine enough for a slot's rows to fit a task. ``by`` must not be null.
    """
    keys = [*by, slot]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = df.withColumn("_upto", F.sum(value).over(within))
    return inner.join(starts, keys).withColumn(out, F.col("_start") + F.col("_upto") - F.col(value)).drop("_start", "_upto")


def counted(df: DataFrame) -> DataFrame:
    """Equal rows as one with their number, ``copies``; combined in the tasks first, so a hot row is no large group."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def copied(df: DataFrame, place: str, step: Column) -> DataFrame:
    """The rows of ``counted`` again, each ``step`` behind the one before it at ``place``."""
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    rows = df.withColumn("_nth", nth)
    return rows.withColumn(place, F.col(place) + F.col("_nth") * step).drop("_nth", "copies")


def slots_for(rows: int) -> int:
    """About the square root of ``rows``, a power of two: as many slots as rows in each, so neither end grows fast."""
    return 1 << (max(rows, 1).bit_length() // 2)
