"""Slowly changing dimension, type 2, applied in one pass; as-of reads and joins.

A dimension row is a version: its columns, a ``hash`` of the non-key columns,
``beg_date`` and ``exp_date`` (``4444-01-01`` while open). ``scd2_apply``
takes the table and a full snapshot of the source and returns the new table:

======================================================  =========================================
case                                                    rows out
======================================================  =========================================
closed version                                          as is (never joined, never shuffled)
open version, id absent from source or hash equal       as is
id new, no history                                      source row, beg 1980-01-01
id new, closed history exists                           source row, beg = effective date
hash differs, open version began on the effective date  source row replaces it (same-day fix)
hash differs                                            old row closed on the effective date,
                                                        source row open from it
======================================================  =========================================

Running it twice with the same source and date returns the same table, also
where ids are null: a null id is a key like any other (``null_keys="match"``) or
refused (``"refuse"``). Rows deleted upstream stay open. Only open versions (at
most one per id) and the source meet in the full outer join, so a key with a
long history cannot skew it; of the closed history a distinct list of ids is
asked, to tell a returning id from a new one. Loads that are dated before an
open version began are for ``strata.operators.splice``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import BEGINNING, OPEN_END, as_date, as_of, is_open
from strata.functions.fingerprint import NULL_MARKER, SEPARATOR, fingerprint
from strata.functions.keys import comparable, key_list
from strata.operators.merge import assert_unique_keys

HISTORY = ("hash", "beg_date", "exp_date")


def _attributes(df: DataFrame, keys: list[str]) -> list[str]:
    low = {k.lower() for k in keys} | set(HISTORY)
    return [c for c in df.columns if c.lower() not in low]


def scd2_seed(
    df: DataFrame,
    keys: str | Iterable[str] = "id",
    beg: dt.date | str = BEGINNING,
    null_marker: str | None = NULL_MARKER,
) -> DataFrame:
    """First load: every row open since the beginning of history."""
    keys = key_list(keys)
    return df.withColumns(
        {
            "hash": fingerprint(_attributes(df, keys), SEPARATOR, null_marker),
            "beg_date": F.lit(as_date(beg)),
            "exp_date": F.lit(OPEN_END),
        }
    )


def typed_source(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_marker: str | None,
    validate: bool,
    null_keys: str,
    prefix: str,
) -> tuple[DataFrame, list[str]]:
    """The source in the table's types with its hash and the columns to join on; a repeated or refused id raises."""
    attrs = _attributes(target, keys)
    types = dict(target.dtypes)
    src = source.select(*[F.col(c).cast(types[c]).alias(c) for c in keys + attrs])
    src = src.withColumn("hash", fingerprint(attrs, SEPARATOR, null_marker))
    on = list(keys)
    if null_keys == "match":
        columns = comparable(src, keys, prefix)
        src, on = src.withColumns(columns), list(columns)
    elif null_keys == "refuse":
        known = reduce(and_, [F.col(k).isNotNull() for k in keys])
        src = src.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(F.lit("dimension source has a null id"))))
    else:
        raise ValueError(f"unknown choice for null ids: {null_keys!r}")
    if validate:
        src = assert_unique_keys(src, on, "dimension source")
    return src, on


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    effective_date: dt.date | str | None = None,
    keys: str | Iterable[str] = "id",
    *,
    null_marker: str | None = NULL_MARKER,
    validate: bool = True,
    co_partitions: int | None = None,
    null_keys: str | None = None,
) -> DataFrame:
    """New state of the dimension after loading ``source`` on ``effective_date``.

    Without a date it is the session's current date, read once, so that every
    row of the load gets the same one. Source values are cast to the table's
    types before they are hashed, so equal values hash alike.
    ``co_partitions``: bucket count of a dimension stored bucketed by the keys
    (``sinks.write_bucketed``); the source is hash-partitioned to match, so the
    dimension is read in place and never shuffled. ``null_keys``: "match" makes
    null an id like any other; "refuse", the default with ``co_partitions``
    (buckets are found by plain equality), raises on one in the source.
    """
    keys = key_list(keys)
    if effective_date is None:
        effective_date = target.sparkSession.range(1).select(F.current_date()).first()[0]
    null_keys = null_keys or ("refuse" if co_partitions else "match")
    if co_partitions and null_keys == "match":
        raise ValueError("a bucketed dimension can't match null ids")
    eff = F.lit(as_date(effective_date))
    out_cols = target.columns

    if co_partitions:
        source = source.repartition(co_partitions, *keys)
    types = dict(target.dtypes)
    src, on = typed_source(target, source, keys, null_marker, validate, null_keys, "__key_")
    if null_keys == "match":
        columns = comparable(target, keys, "__key_")
        target = target.withColumns(columns)
    cur = target.filter(is_open())
    hist = target.filter(~is_open())
    hist_ids = hist.select(*on).distinct().withColumn("__history", F.lit(True))

    # Each side travels as one struct in the target's column order and types;
    # a source row gets its dates later.
    no_date = F.lit(None).cast("date")
    t = cur.select(*on, F.struct(*out_cols).alias("__t"))
    s_fields = [no_date.alias(c) if c in ("beg_date", "exp_date") else F.col(c).cast(types[c]).alias(c) for c in out_cols]
    s = src.join(hist_ids, on, "left").select(*on, F.struct(*s_fields).alias("__s"), "__history")
    j = t.join(s, on, "full_outer")

    t_here, s_here = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    changed = t_here & s_here & (F.col("__t.hash") != F.col("__s.hash"))
    # A load dated before the open version began would rewrite history: refuse it.
    in_order = F.when(
        changed & (F.col("__t.beg_date") > eff),
        F.raise_error(F.lit("effective date is before the start of the open version")),
    ).otherwise(F.lit(True))

    old = F.col("__t").withField("exp_date", F.when(changed, eff).otherwise(F.col("__t.exp_date")))
    new_beg = F.when(t_here | F.col("__history"), eff).otherwise(F.lit(BEGINNING))
    new = F.col("__s").withField("beg_date", new_beg).withField("exp_date", F.lit(OPEN_END))
    keep_old = t_here & ~(changed & (F.col("__t.beg_date") == eff))
    emit_new = s_here & (~t_here | changed)
    versions = F.array(F.when(keep_old, old), F.when(emit_new, new))
    rows = j.filter(in_order).select(F.inline(F.filter(versions, lambda v: v.isNotNull())))
    return hist.select(*out_cols).unionByName(rows)


def scd2_current(dim: DataFrame) -> DataFrame:
    """Open versions: one row per live id."""
    return dim.filter(is_open())


def scd2_as_of(dim: DataFrame, report_date: dt.date | str, inclusive: bool = False) -> DataFrame:
    """Versions valid on ``report_date`` (half-open by default, ``BETWEEN`` if inclusive)."""
    return dim.filter(as_of(report_date, inclusive))


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    report_date: dt.date | str,
    dim_key: str = "id",
    inclusive: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Equi join on the key with the version valid on ``report_date``.

    The range part is a filter on the dimension alone, so on a stored dimension
    it is pushed into the scan and the join itself stays an equi join.
    """
    d = scd2_as_of(dim, report_date, inclusive)
    return fact.join(d, fact[fact_key] == d[dim_key], how)
