"""Aggregates kept up by change sets.

A state is a table of groups with additive measures: the number of rows
(``rows_in``) and sums. ``merge_changes`` says which rows a load took away and
which it added; their signed sums by group are merged into the state, so a load
costs what it changes, not what the table holds, and the result equals the
aggregate of the merged table. A group whose rows are all gone leaves the state.

States can stand on each other: ``state_changes`` are the old and the new rows
of the groups that a change set touches, signed, so a coarser state takes them
like rows of a table. That is how a number of distinct things is kept up: a
state by thing, and on it a state that counts its groups.

A mean is the quotient of two sums; measures of null count 0, so a mean over
known values needs the number of these as a measure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import CHANGE

ROWS = "rows_in"


def state_of(rows: DataFrame, grain: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """The state of a whole table."""
    sums = [F.sum(F.coalesce(m, F.lit(0))).alias(name) for name, m in measures.items()]
    return rows.groupBy(*grain).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def _deltas(state: DataFrame, changes: DataFrame, grain: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Signed sums of a change set by group, joined to the groups that they touch."""
    sums = [F.sum(F.col(CHANGE) * F.coalesce(m, F.lit(0))).alias(f"d_{name}") for name, m in measures.items()]
    delta = changes.groupBy(*grain).agg(F.sum(CHANGE).alias(f"d_{ROWS}"), *sums)
    delta = delta.select(*[F.col(g).alias(f"d_{g}") for g in grain], *[c for c in delta.columns if c not in grain], F.lit(True).alias("touched"))
    return delta, reduce(and_, [F.col(g).eqNullSafe(F.col(f"d_{g}")) for g in grain])


def _rows(state: DataFrame, grain: Sequence[str], measures: Mapping[str, Column]) -> tuple[list[Column], list[Column]]:
    """A group's row before and after."""
    types = dict(state.dtypes)
    here = F.col(ROWS).isNotNull()
    key = [F.when(here, F.col(g)).otherwise(F.col(f"d_{g}")).alias(g) for g in grain]
    summed = [(F.coalesce(F.col(m), F.lit(0)) + F.coalesce(F.col(f"d_{m}"), F.lit(0))).cast(types[m]).alias(m) for m in (ROWS, *measures)]
    return [F.col(c).alias(c) for c in (*grain, ROWS, *measures)], key + summed


def apply_changes(state: DataFrame, changes: DataFrame, grain: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """The state after a change set; the measures are of the changed rows."""
    delta, same = _deltas(state, changes, grain, measures)
    _, after = _rows(state, grain, measures)
    return state.join(delta, same, "full_outer").select(*after).where(F.col(ROWS) != 0)


def state_changes(state: DataFrame, changes: DataFrame, grain: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """The signed old and new rows of the groups whose row a change set changes."""
    delta, same = _deltas(state, changes, grain, measures)
    before, after = _rows(state, grain, measures)
    old, new = F.struct(*before), F.struct(*after)
    here = F.col(ROWS).isNotNull()
    signed = F.array(
        F.when(here, F.struct(F.lit(-1).alias(CHANGE), old.alias("row"))),
        F.when(new[ROWS] != 0, F.struct(F.lit(1).alias(CHANGE), new.alias("row"))),
    )
    # groups that nothing touches are not asked for
    met = state.join(delta, same, "right")
    changed = met.where(~here | ~old.eqNullSafe(new))
    return changed.select(F.inline(F.filter(signed, lambda r: r.isNotNull()))).select("row.*", CHANGE)
