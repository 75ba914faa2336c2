"""Exact distinct counts that add up over periods.

Counts of distinct ids can't be summed over months; sets can be united. A state
holds for each group, such as a month, the set of its ids as bitmaps of 32,768
ids each. States of months give those of quarters and years by a bitwise or, and
the counts by counting bits, without the facts; a month that is loaded again
replaces its own bitmaps.

Ids are whole numbers; a bitmap takes 4 KB however few ids it has, so they
should be dense, as surrogate keys are. Null ids are not counted. Everything is
an aggregate that combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "id_bucket", "id_bits"


def distinct_state(rows: DataFrame, grain: Sequence[str | Column], id_column: str) -> DataFrame:
    """The sets of ids by ``grain``."""
    known = rows.where(F.col(id_column).isNotNull())
    bit = F.bitmap_bit_position(F.col(id_column).cast("long"))
    return known.groupBy(*grain, F.bitmap_bucket_number(F.col(id_column).cast("long")).alias(BUCKET)).agg(F.bitmap_construct_agg(bit).alias(BITS))


def united(state: DataFrame, grain: Sequence[str | Column]) -> DataFrame:
    """The sets by a coarser ``grain``."""
    return state.groupBy(*grain, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(state: DataFrame, grain: Sequence[str | Column], name: str) -> DataFrame:
    """How many different ids each group of ``grain`` has."""
    sets = united(state, grain)
    by = [c for c in sets.columns if c not in (BUCKET, BITS)]
    return sets.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))
