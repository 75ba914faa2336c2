"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to and
with it, in an order shuffled by hash, divided by the source's weight. A second
pass over a source follows its first one and no more, so that nothing is taken
more than ``MAX_REPEATS`` times. Documents of all sources are then sorted by
finish time, in ranges of it, and the mix ends where the total budget is spent.
A source that runs out leaves its share to the others by weight, which is what
the targets say.

Running sums never put a source in one task: see ``common.running_total``. What
reaches the driver is one row, the last one taken.

Defined cases: a null text has no words; a null source is a source like any
other, the last one. Documents without words finish with the one before them and
are never repeated. Rows that repeat doc_id and text share a place in the
shuffle and count as so many documents. An empty table gives an empty mix.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import copied, counted, n_words, read_table, running_total, slots_for, written

WEIGHTS = (5, 2, 1)  # by the sources' code point order, repeating
MAX_REPEATS = 2
# budget = 150 % of all words
BUDGET_NUM, BUDGET_DEN = 3, 2
BIG = "decimal(38,0)"


def shuffle_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("~")), F.lit(":"), F.coalesce(text, F.lit("~"))))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """rank, source, source_size, weight and target of each source, from (source, size) rows.

    A source whose share is above ``MAX_REPEATS`` times its size stops there; the
    rest is shared by weight among the others. Sorted by size over weight, the
    stopped ones come first, so running sums find them in one pass.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("long"))
    ranked = ranked.withColumn("cap", (F.col("source_size") * MAX_REPEATS).cast(BIG))
    order = Window.orderBy(F.col("source_size").cast("double") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    zero = F.lit(0).cast(BIG)
    left = ranked.select(
        "*",
        # budget and caps times BUDGET_DEN, so that all are whole numbers
        (F.sum("source_size").over(every) * BUDGET_NUM - F.coalesce(F.sum("cap").over(before), zero) * BUDGET_DEN).cast(BIG).alias("budget_left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    full = (F.col("budget_left") * F.col("weight")).cast(BIG) >= (F.col("cap") * F.col("weight_left") * BUDGET_DEN).cast(BIG)
    left = left.withColumn("full", full)
    # the first source that isn't full says what the others share
    rest = Window.partitionBy()
    first_left = F.max(F.when(~F.col("full"), F.col("weight_left"))).over(rest)
    budget_of = F.max_by(F.when(~F.col("full"), F.col("budget_left")), F.when(~F.col("full"), F.col("weight_left"))).over(rest)
    share = (F.col("weight") * budget_of).cast("double") / (first_left * BUDGET_DEN).cast("double")
    return left.select("rank", "source", "source_size", "source_rows", "weight", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, shuffle, size, source_size, target, copies, taken."""
    sizes = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), shuffle_key(F.col("doc_id"), F.col("text")).alias("shuffle")), "sizes")
    sources = written(source_targets(sizes, weights), "source_targets")
    slots = slots_for(sizes.count())
    # the first 8 hex digits of the key, cut into ranges
    slot = F.floor(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") * slots / float(1 << 32)).cast("long")
    # rows that repeat doc_id and text follow each other, so they are placed as one
    ranked = counted(sizes).join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).withColumn("slot", slot)
    ranked = ranked.withColumn("every_size", F.col("size") * F.col("copies"))
    placed = copied(running_total(ranked, ["rank"], "slot", [F.col("shuffle"), F.col("doc_id")], "every_size", "before"), "before", F.col("size"))
    placed = written(placed.select("doc_id", "shuffle", "size", "rank", "weight", "source_size", "target", "before"), "placed")

    def finish(turn: int) -> Column:
        return (F.col("before") + F.col("size") + F.col("source_size") * turn).cast("double") / F.col("weight")

    queue = F.explode(F.array(*(finish(turn) for turn in range(MAX_REPEATS))))
    queued = placed.select("size", "rank", "shuffle", queue.alias("finish"))
    words, last = placed.agg(F.sum("size"), F.max(F.col("source_size") * MAX_REPEATS / F.col("weight"))).first()
    turns = [F.lit(True)] + [F.lit(False)] * (MAX_REPEATS - 1)
    if words:
        budget = words * BUDGET_NUM // BUDGET_DEN
        ranges = slots * MAX_REPEATS
        at = F.least(F.floor(F.col("finish") * (ranges / float(last))).cast("long"), F.lit(ranges - 1))
        queued = queued.withColumn("range", at)
        totals = queued.groupBy("range").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cut = totals.withColumn("upto", upto).where(F.col("upto") > budget).orderBy("range").first()
        spent = cut["upto"] - cut["words"]
        order = ["finish", "rank", "shuffle"]
        upto = F.sum("size").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        edge = queued.where(F.col("range") == cut["range"]).withColumn("upto", upto + spent)
        first_out = edge.where(F.col("upto") > budget).orderBy(*order).first()
        mark = F.struct(F.lit(first_out["finish"]).alias("finish"), F.lit(first_out["rank"]).alias("rank"), F.lit(first_out["shuffle"]).alias("shuffle"))
        turns = [F.struct(finish(turn).alias("finish"), "rank", "shuffle") < mark for turn in range(MAX_REPEATS)]
        turns = [turns[0], *((t & (F.col("size") > 0)) for t in turns[1:])]
    copies = sum((t.cast("int") for t in turns[1:]), turns[0].cast("int"))
    return placed.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies")).drop("before", "rank", "weight")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """The documents of the mix, a repeated one as so many rows, with their columns, whatever these are called."""
    plan = mix(docs, weights).groupBy("shuffle").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    # rows that repeat doc_id and text have one key; they share its copies out
    keyed = docs.select(F.struct("*").alias("row"), shuffle_key(F.col("doc_id"), F.col("text")).alias("shuffle"))
    nth = F.row_number().over(Window.partitionBy("shuffle").orderBy("row.lang", "row.source", "row.n_chars"))
    own = F.floor(F.col("copies") / F.col("rows")).cast("int") + (nth <= F.col("copies") % F.col("rows")).cast("int")
    both = keyed.join(plan, "shuffle").withColumn("own", own).where("own > 0")
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1), "own"))).select("row.*")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '~') || ':' || coalesce(text, '~')) AS shuffle
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER b, 0) AS budget_left,
         sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left
  FROM w WINDOW b AS (ORDER BY source_size::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, budget_left * weight >= 4 * source_size * weight_left AS is_full FROM l),
r AS (SELECT max(weight_left) AS wl, max(budget_left) AS bl FROM f WHERE NOT is_full),
t AS (
  SELECT f.*, CASE WHEN is_full THEN (2 * source_size)::DOUBLE
              ELSE (weight * (SELECT bl FROM r))::DOUBLE / (2 * (SELECT wl FROM r))::DOUBLE END AS target FROM f),
p AS (
  SELECT d.*, t.rk, t.weight, t.source_size, t.target,
         sum(size) OVER (PARTITION BY t.rk ORDER BY shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT p.*, turn, (upto + turn * source_size)::DOUBLE / weight AS finish FROM p, (VALUES (0), (1)) v(turn)),
c AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rk, shuffle ROWS UNBOUNDED PRECEDING) AS spent,
         (SELECT sum(size) * 3 // 2 FROM d) AS budget FROM q),
m AS (SELECT min(struct_pack(a := finish, b := rk, c := shuffle)) AS mark FROM c WHERE spent > budget)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(CASE WHEN struct_pack(a := finish, b := rk, c := shuffle) < (SELECT mark FROM m) THEN size ELSE 0 END)::BIGINT AS taken
FROM c GROUP BY doc_id, shuffle
"""
