"""Deterministic deduplication on a key.

``row_number() = 1`` over a key window; Spark plans this with a
``WindowGroupLimit`` before the shuffle, so every map task keeps one row per
key and a hot key is reduced map-side instead of landing whole on one task.
Ties are broken by explicit columns, so a recomputed partition (after an
executor loss) yields the same survivor.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strata.functions.fingerprint import fingerprint
from strata.functions.keys import key_list


def _order(cols: Iterable[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def latest_per_key(
    df: DataFrame, keys: str | Iterable[str], order_by: Iterable[str | Column]
) -> DataFrame:
    """One row per key: the first by ``order_by`` (strings mean descending)."""
    keys = key_list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order(order_by))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def dedupe_key(
    df: DataFrame, keys: str | Iterable[str], order_by: Iterable[str | Column] | None = None
) -> DataFrame:
    """``dropDuplicates(keys)`` with a defined survivor.

    With ``order_by`` the first row by it wins (strings mean descending, e.g. a
    load number). Without one, rows are ordered by all their columns (map
    columns, which have no order, by their fingerprint), so the survivor does
    not depend on input order; only identical rows tie.
    """
    keys = key_list(keys)
    if order_by is None:
        plain = [F.col(f.name).asc_nulls_first() for f in df.schema.fields if not isinstance(f.dataType, MapType)]
        maps = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]
        order_by = plain + ([fingerprint(maps).asc()] if maps else [])
    return latest_per_key(df, keys, order_by)
