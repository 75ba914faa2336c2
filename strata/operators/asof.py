"""As-of join by the fact's own date: each row meets the version valid on its day.

Facts and versions are put into one table, ordered by key and date, and every
fact takes the last version before it: a window, linear in the rows, where a
join on the key with a range condition would meet every fact with every version
of its key.

A key with many rows is cut into slices of its dates, so it is no single window
group. The edges are quantiles of the key's own dates; rows of one day that
alone fill several slices are dealt out among these. A version goes into every
slice that its validity meets. Only keys with more than ``slice_rows`` rows have
edges, and ``slice_rows`` is at least a ``MAX_SLICES``-th of the fact, so the
table of edges is bounded and can be broadcast.

Defined cases: a fact whose key or date is null meets no version, and neither
does one that no version of its key covers; an inner join drops them, a left
join keeps them with nulls. Repeated facts are joined each. Of versions of one
key that overlap, the one that began last counts, while it lasts; two that begin
on one day are ordered by their end, then by their columns. A fact's columns
keep their names; ``columns`` are added under the names given.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000
# Fixed value: the most slices that hot keys are cut into altogether.
MAX_SLICES = 10_000


def date_edges(fact: DataFrame, key: str, date: str, slice_rows: int = SLICE_ROWS) -> DataFrame | None:
    """key and the ascending edge dates of its slices, for keys with more rows than a slice; None without such a key.

    Counts are one row of a key for each task; the quantiles are sketches. An
    edge belongs to the slice before it, so edges that repeat enclose slices of one day.
    """
    known = fact.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(F.col(key).alias("key"), F.col(date).cast("date").alias("day"))
    counts = known.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n"), F.max("n")).first()
    rows = max(slice_rows, -(-(total[0] or 0) // MAX_SLICES))
    if (total[1] or 0) <= rows:
        return None
    heavy = counts.where(F.col("n") > rows)  # at most MAX_SLICES keys, which have twice as many slices at most
    of_key = known.join(F.broadcast(heavy), "key").groupBy("key").agg(
        F.max(F.ceil(F.col("n") / rows)).cast("int").alias("slices"),
        # days as numbers; a fine sketch, of which each key takes its own quantiles
        F.histogram_numeric(F.datediff("day", F.lit("1970-01-01")).cast("double"), F.lit(MAX_SLICES)).alias("days"),
    )
    # running counts over the sketch's days: an edge for each full slice
    empty = F.struct(F.lit(0.0).alias("before"), F.array().cast("array<date>").alias("edges"))

    def step(acc: Column, bar: Column) -> Column:
        upto = acc["before"] + bar["y"]
        full = (F.floor(upto / rows) - F.floor(acc["before"] / rows)).cast("int")
        day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(bar["x"]).cast("int"))
        return F.struct(upto.alias("before"), F.concat(acc["edges"], F.array_repeat(day, full)).alias("edges"))

    return of_key.select("key", F.aggregate("days", empty, step, lambda acc: acc["edges"]).alias("edges"))


def as_of_join_by_date(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_date: str,
    columns: Mapping[str, str],
    dim_key: str = "id",
    *,
    inclusive: bool = False,
    how: str = "inner",
    slice_rows: int = SLICE_ROWS,
    beg: str = "beg_date",
    exp: str = "exp_date",
) -> DataFrame:
    """``fact`` with ``columns`` (dimension column -> new name) of the version valid on ``fact_date``.

    Half-open ``beg <= day < exp`` unless ``inclusive`` (``day <= exp``; of two
    versions that meet on a day the later one counts).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of as-of join: {how!r}")
    clash = [c for c in columns.values() if c in fact.columns]
    if clash:
        raise ValueError(f"the fact already has columns {clash}")
    known = F.col(fact_key).isNotNull() & F.col(fact_date).isNotNull()
    values = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    day = F.col(fact_date).cast("date")
    last_day = F.col(exp) if inclusive else F.date_sub(exp, 1)

    whole = F.struct(*fact.columns)
    facts = fact.where(known).select(F.col(fact_key).alias("key"), day.alias("day"), whole.alias("fact"))
    versions = dim.where(F.col(dim_key).isNotNull() & F.col(beg).isNotNull()).select(
        F.col(dim_key).cast(fact.schema[fact_key].dataType).alias("key"), F.col(beg).cast("date").alias("day"), last_day.alias("last"), values.alias("values")
    )
    versions = versions.where("key IS NOT NULL AND last >= day")  # what was never valid may not hide what was
    edges = date_edges(fact, fact_key, fact_date, slice_rows)
    if edges is None:
        facts, versions = (df.withColumn("slice", F.lit(0)) for df in (facts, versions))
    else:
        none = F.array().cast("array<date>")

        def before(d: str, or_on: bool) -> Column:
            return F.size(F.filter(F.coalesce("edges", none), lambda e: (e <= F.col(d)) if or_on else (e < F.col(d))))

        first, many = before("day", False), before("day", True) - before("day", False) + 1
        own = first + F.pmod(F.xxhash64("fact"), many.cast("long")).cast("int")
        facts = facts.join(F.broadcast(edges), "key", "left").select("key", "day", "fact", own.alias("slice"))
        met = F.explode(F.sequence(before("day", False), before("last", True)))
        versions = versions.join(F.broadcast(edges), "key", "left").select("key", "day", "last", "values", met.alias("slice"))

    no_fact, no_version = (F.lit(None).cast(t) for t in (dict(facts.dtypes)["fact"], f"struct<last:date,values:{dict(versions.dtypes)['values']}>"))
    version = F.struct("last", "values")
    both = versions.select("key", "slice", "day", F.lit(0).alias("kind"), no_fact.alias("fact"), version.alias("version")).unionByName(
        facts.select("key", "slice", "day", F.lit(1).alias("kind"), "fact", no_version.alias("version"))
    )
    order = Window.partitionBy("key", "slice").orderBy("day", "kind", "version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("valid", F.last("version", ignorenulls=True).over(order)).where("kind = 1")
    here = F.coalesce(F.col("day") <= F.col("valid.last"), F.lit(False))
    if how == "inner":
        met = met.where(here)
    added = [F.when(here, F.col(f"valid.values.c{i}")).alias(name) for i, name in enumerate(columns.values())]
    out = met.select("fact.*", *added)
    if how == "left":
        types = dict(out.dtypes)
        nulls = [F.lit(None).cast(types[name]).alias(name) for name in columns.values()]
        out = out.unionByName(fact.where(~known).select("*", *nulls))
    return out
