"""Table scans and view registration.

A table is a parquet directory (or file) named after the table under a base
location, as in each layer of the warehouse. Scans stay lazy so that Catalyst
can prune columns and push filters into the parquet reader.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, name: str) -> str:
    base = base.rstrip("/")
    return f"{base}/{name}" if name.endswith(".parquet") else f"{base}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan of ``name`` under ``base`` (``<base>/<name>.parquet``), as it is now."""
    return spark.read.parquet(table_path(base, name))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """One temp view per source, named after the table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_sources(spark: SparkSession, base: str, names: str | Iterable[str], register: bool = True) -> dict[str, DataFrame]:
    """Comma-separated (or listed) source names -> DataFrames, registered as views.

    Views replace those the session has under these names; without ``register``
    the session stays as it is.
    """
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    tables = {n: read_table(spark, base, n) for n in names}
    if register:
        register_views(tables)
    return tables
