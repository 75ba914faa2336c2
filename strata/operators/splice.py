"""History from loads that come in any order.

``scd2_splice`` applies a load dated ``effective_date`` to a table that later
loads have already been applied to. A load tells an id's values from its date
on, until the next load (``next_load``) told them anew. So of each id only the
version that is valid on the date is touched:

- the load has its values: nothing changes;
- otherwise it is cut: up to the date it stays, then come the load's values, and
  from the next load on it is valid again, if it still was then;
- an id between two of its versions gets one that lasts to the next one;
- an id without any version is new and open since the beginning of history, as
  in ``scd2_apply``.

Versions of one id that touch and have one hash then are one version: the load's
may continue the one before it or be continued by the one behind it.

With ``next_load=None`` the load is the latest, and the result that of
``scd2_apply``. If every load lists all ids, loads spliced in any order give the
table that they give in order.

``scd2_replay`` builds the table from all loads at once, each row with its
load's date: a version begins where the hash differs from the load before.

The result reads its table several times: write it, or cut its lineage, before
another load is applied to it.

The version to cut is found by a filter on the date, at most one row of an id;
neighbours are found by an equi-join of the other versions with the changed ids,
which adaptive execution can split where one id has a long history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.dates import BEGINNING, OPEN_END, as_date, as_of
from strata.functions.fingerprint import NULL_MARKER, SEPARATOR, fingerprint
from strata.functions.keys import comparable, key_list
from strata.operators.merge import assert_unique_keys
from strata.operators.scd2 import HISTORY, typed_source


def scd2_splice(
    target: DataFrame,
    source: DataFrame,
    effective_date: dt.date | str,
    next_load: dt.date | str | None = None,
    keys: str | Iterable[str] = "id",
    *,
    null_marker: str | None = NULL_MARKER,
    validate: bool = True,
) -> DataFrame:
    """New state of the dimension after a load of ``effective_date``, the next one applied being ``next_load``.

    Null ids match each other, as in ``scd2_apply``. A version of an id must not
    overlap another of its versions.
    """
    keys = key_list(keys)
    day, until = as_date(effective_date), OPEN_END if next_load is None else as_date(next_load)
    if until <= day:
        raise ValueError(f"the next load, {until}, has to be after the load, {day}")
    eff, end = F.lit(day), F.lit(until)
    out_cols, types = target.columns, dict(target.dtypes)
    src, on = typed_source(target, source, keys, null_marker, validate, "match", "__key_")
    versions = target.withColumns(comparable(target, keys, "__key_"))
    here = as_of(day)
    rest = versions.filter(~here)

    # of ids without a version on the day: whether they have any, and when the next begins
    others = rest.groupBy(*on).agg(F.min(F.when(F.col("beg_date") > eff, F.col("beg_date"))).alias("__next"), F.lit(True).alias("__known"))
    t = versions.filter(here).select(*on, F.struct(*out_cols).alias("__t"))
    s = src.join(others, on, "left").select(*on, F.struct(*[F.col(c).cast(types[c]).alias(c) if c not in ("beg_date", "exp_date") else F.lit(None).cast("date").alias(c) for c in out_cols]).alias("__s"), "__next", "__known")
    j = t.join(s, on, "full_outer")

    t_here, s_here = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    changed = t_here & s_here & (F.col("__t.hash") != F.col("__s.hash"))
    told = s_here & (~t_here | changed)
    new_id = ~t_here & F.col("__known").isNull()
    upto = F.when(t_here, F.least(F.col("__t.exp_date"), end)).when(new_id, F.lit(OPEN_END)).otherwise(F.least(F.coalesce("__next", F.lit(OPEN_END)), end))
    new = F.col("__s").withField("beg_date", F.when(new_id, F.lit(BEGINNING)).otherwise(eff)).withField("exp_date", upto)
    before = F.col("__t").withField("exp_date", eff)
    behind = F.col("__t").withField("beg_date", upto)
    pieces = F.array(
        F.when(t_here & ~told, F.struct(F.lit("as it was").alias("kind"), F.col("__t").alias("v"))),
        F.when(changed & (F.col("__t.beg_date") < eff), F.struct(F.lit("as it was").alias("kind"), before.alias("v"))),
        F.when(told, F.struct(F.lit("told").alias("kind"), new.alias("v"))),
        F.when(changed & (upto < F.col("__t.exp_date")), F.struct(F.lit("as it was").alias("kind"), behind.alias("v"))),
    )
    cut = j.select(*on, F.inline(F.filter(pieces, lambda p: p.isNotNull())))

    # a version that the load's continues, or that continues it, with the same hash
    load = cut.where("kind = 'told'")
    ends = load.select(*on, F.col("v.hash").alias("__hash"), F.col("v.beg_date").alias("__beg"), F.col("v.exp_date").alias("__exp"))
    near = rest.join(ends, on, "left")
    joins = F.coalesce((F.col("hash") == F.col("__hash")) & ((F.col("exp_date") == F.col("__beg")) | (F.col("beg_date") == F.col("__exp"))), F.lit(False))
    runs = load.select(*on, F.col("v").alias("__v")).unionByName(near.where(joins).select(*on, F.struct(*out_cols).alias("__v")))
    # one hash: only the dates differ
    merged = runs.groupBy(*on).agg(F.min("__v.beg_date").alias("__beg"), F.max("__v.exp_date").alias("__exp"), F.first("__v").alias("__v"))
    merged = merged.select(F.col("__v").withField("beg_date", F.col("__beg")).withField("exp_date", F.col("__exp")).alias("__v")).select("__v.*")
    return near.where(~joins).select(*out_cols).unionByName(cut.where("kind <> 'told'").select("v.*")).unionByName(merged)


def scd2_replay(
    loads: DataFrame,
    load_date: str,
    keys: str | Iterable[str] = "id",
    *,
    null_marker: str | None = NULL_MARKER,
    validate: bool = True,
) -> DataFrame:
    """The dimension that the loads give in the order of their dates, whatever the order they are in.

    Equals ``scd2_seed`` of the first load and ``scd2_apply`` of the others: an
    id that a load doesn't list stays as it was. An id may be listed once a load.
    """
    keys = key_list(keys)
    attrs = [c for c in loads.columns if c not in (*keys, load_date) and c not in HISTORY]
    rows = loads.withColumn("hash", fingerprint(attrs, SEPARATOR, null_marker)).withColumns(comparable(loads, keys, "__key_"))
    on = list(comparable(loads, keys, "__key_"))
    day = F.col(load_date).cast("date")
    rows = rows.withColumn("__day", day)
    if validate:
        rows = assert_unique_keys(rows, [*on, "__day"], "dimension loads")
    order = Window.partitionBy(*on).orderBy("__day")
    told = rows.withColumn("__before", F.lag("hash").over(order)).where("__before IS NULL OR __before <> hash")
    first = F.row_number().over(order) == 1
    return told.select(
        *keys, *attrs, "hash",
        F.when(first, F.lit(BEGINNING)).otherwise(F.col("__day")).alias("beg_date"),
        F.coalesce(F.lead("__day").over(order), F.lit(OPEN_END)).alias("exp_date"),
    )
