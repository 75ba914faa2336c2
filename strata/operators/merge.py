"""Keyed merge (upsert) as a DataFrame operator.

``merge(target, source, keys)`` returns the table as it stands after
``MERGE INTO target USING source ON keys``: matched rows are updated (all
non-key columns, or ``update_cols``; only where ``when_changed`` says so),
unmatched source rows are inserted, and target rows absent from the source
stay. Presence of each side is read from a marker column, never from key
nullness.

The plan is one full outer join. Which side is built, broadcast or split is
left to adaptive execution, which knows the bytes at run time.

Each key may appear once in the source. The check runs inside the same job: a
row number per key over a window that is partitioned like the join, so it costs
no extra shuffle and holds no group in memory; a second row raises at run time.
Keys with a null part never match unless ``null_safe``: such source rows are
all inserted, however many there are.

Co-location: when the target is stored bucketed by the keys
(``sinks.write_bucketed``), ``co_partitions=<buckets>`` repartitions the
source into the same hash partitions, so the join reads the target in place
and only the source moves. The merged result keeps that partitioning, so it is
written back bucketed without another shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.keys import key_list

_T, _S, _GROUP = "__t_", "__s_", "group__"
CHANGE, ACTION = "change", "merge_action"
# Fixed value: how many groups the rows without a full key are spread over.
NULL_GROUPS = 1024
Condition = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _present(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def assert_unique_keys(
    df: DataFrame, keys: str | Iterable[str], what: str = "merge source", null_safe: bool = False, beside: Iterable[str] = ()
) -> DataFrame:
    """Rows of ``df`` unchanged; raises at run time if a key occurs twice.

    Keys with a null part are equal to nothing, so they may repeat, unless
    ``null_safe`` makes null a value like any other. ``beside``: columns that
    follow from the row and that the rows are dealt out by, beside the keys.
    """
    keys = key_list(keys)
    nth = F.row_number().over(Window.partitionBy(*keys, *beside).orderBy(*keys))
    msg = f"{what} has more than one row for a key of ({', '.join(keys)})"
    repeated = F.col("__key_row") > 1
    if not null_safe:
        repeated = repeated & _present(keys)
    return (
        df.withColumn("__key_row", nth)
        .filter(F.when(repeated, F.raise_error(F.lit(msg))).otherwise(F.lit(True)))
        .drop("__key_row")
    )


def merge(target: DataFrame, source: DataFrame, keys: str | Iterable[str], **options) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys``; result has the target's columns. Options:

    - ``when_changed=None``: every matched row is updated.
    - ``when_changed="hash"``: update only when that column differs (null-safe).
    - ``when_changed=callable(t, s) -> Column``: custom condition; ``t(c)``/``s(c)``
      give a side's column.
    - ``update_cols``: columns set on update (default: all non-key columns the
      source has). Inserts always take every column the source has.
    - ``validate`` (default true): a key that occurs twice in the source raises.
    - ``null_safe``: keys match with ``<=>`` (null equals null).
    - ``co_partitions``: bucket count of a target bucketed by ``keys``; the
      source is hash-partitioned to match and the target is not shuffled.
    - ``spread_null_keys``: rows without a full key, which match nothing, are
      spread over the tasks instead of meeting in one. For tables where many
      rows lack a key; inputs that are already partitioned by the keys are then
      shuffled again.
    - ``refuse_null_keys``: for tables that guarantee full keys. A key with a
      null part raises at run time, on either side, so that null-safe and plain
      keys mean the same and the join is a plain one: inputs partitioned by the
      keys are not shuffled again.
    - ``extra``: what to do with source columns the target doesn't have:
      ``"refuse"`` raises, ``"add"`` adds them (null where a row isn't taken
      from the source), ``"drop"`` leaves them out.
    """
    return _prepared(target, source, keys, _merged, **options)


def _prepared(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str],
    shape: Callable[..., DataFrame],
    *,
    when_changed: str | Condition | None = None,
    update_cols: Iterable[str] | None = None,
    null_safe: bool = False,
    validate: bool = True,
    co_partitions: int | None = None,
    spread_null_keys: bool = False,
    refuse_null_keys: bool = False,
    extra: str = "refuse",
) -> DataFrame:
    keys = key_list(keys)
    missing = [k for k in keys if k not in target.columns or k not in source.columns]
    if missing:
        raise ValueError(f"merge keys {missing} must exist on both sides")
    new = [c for c in source.columns if c not in target.columns]
    if new:
        if extra == "refuse":
            raise ValueError(f"source columns {new} are not in the target; pass extra='add' or extra='drop'")
        if extra not in ("add", "drop"):
            raise ValueError(f"unknown choice for extra columns: {extra!r}")
        if extra == "add":
            types = dict(source.dtypes)
            target = target.withColumns({c: F.lit(None).cast(types[c]) for c in new})
        else:
            source = source.drop(*new)
    options = dict(when_changed=when_changed, update_cols=update_cols, validate=validate, shape=shape)
    if refuse_null_keys:
        msg = f"a key of ({', '.join(keys)}) is null"
        full = F.when(_present(keys), F.lit(True)).otherwise(F.raise_error(F.lit(msg)))
        target, source, null_safe = target.filter(full), source.filter(full), False
    if null_safe and co_partitions:
        # A key with a null part never equals a key without one. Rows with full
        # keys merge with plain equality, which keeps the buckets; the others
        # merge null-safe; the two results are disjoint.
        present = _present(keys)
        full = _merge(target.filter(present), source.filter(present), keys, co_partitions=co_partitions, **options)
        rest = _merge(target.filter(~present), source.filter(~present), keys, null_safe=True, **options)
        return full.unionByName(rest)
    return _merge(
        target, source, keys, null_safe=null_safe, co_partitions=co_partitions, spread=spread_null_keys and not null_safe, **options
    )


def _spread_group(df: DataFrame, keys: list[str], sign: int) -> Column:
    """0 for rows with a full key; groups above zero hold the target's other rows, those below the source's."""
    # not the literal 0, which would be no key of the join where keys can't be null
    return F.when(_present(keys), F.pmod(F.xxhash64(*keys), F.lit(1).cast("long"))).otherwise(sign * (F.pmod(F.xxhash64(*df.columns), F.lit(NULL_GROUPS)) + 1))


def _merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    when_changed: str | Condition | None,
    update_cols: Iterable[str] | None,
    validate: bool,
    shape: Callable[..., DataFrame],
    null_safe: bool = False,
    co_partitions: int | None = None,
    spread: bool = False,
) -> DataFrame:
    tcols = target.columns
    scols = set(source.columns)
    update = set(update_cols) if update_cols is not None else {c for c in tcols if c not in keys and c in scols}
    unknown = update - scols
    if unknown:
        raise ValueError(f"update columns {sorted(unknown)} are not in the source")

    if co_partitions:
        source = source.repartition(co_partitions, *keys)
    if spread:
        # the check and the join deal rows out by the same columns
        source = source.withColumn(_GROUP, _spread_group(source, keys, -1))
        target = target.withColumn(_GROUP, _spread_group(target, keys, 1))
    if validate and spread:
        source = assert_unique_keys(source, keys, beside=[_GROUP])
    elif validate:
        source = assert_unique_keys(source, keys, null_safe=null_safe)

    def tc(c: str) -> Column:
        return F.col(_T + c)

    def sc(c: str) -> Column:
        return F.col(_S + c)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(prefix + "present"))

    t, s = side(target, _T), side(source, _S)
    on = [tc(k).eqNullSafe(sc(k)) if null_safe else tc(k) == sc(k) for k in keys]
    if spread:
        on.append(tc(_GROUP) == sc(_GROUP))
    joined = t.join(s, reduce(and_, on), "full_outer")

    t_here = F.coalesce(tc("present"), F.lit(False))
    s_here = F.coalesce(sc("present"), F.lit(False))
    if when_changed is None:
        changed = F.lit(True)
    elif isinstance(when_changed, str):
        changed = ~tc(when_changed).eqNullSafe(sc(when_changed))
    else:
        changed = when_changed(tc, sc)
    take_source = s_here & (~t_here | changed)

    types = dict(target.dtypes)
    out = []
    for c in tcols:
        from_source = sc(c) if c in scols else F.lit(None)
        if c not in keys and c in update:
            v = F.when(take_source, from_source).otherwise(tc(c))
        else:
            v = F.when(t_here, tc(c)).otherwise(from_source)
        out.append(v.cast(types[c]).alias(c))
    return shape(joined, out, [tc(c).alias(c) for c in tcols], t_here, s_here, take_source)


def _merged(joined: DataFrame, out: list[Column], old: list[Column], t_here: Column, s_here: Column, take_source: Column) -> DataFrame:
    return joined.select(*out)


def _changes(joined: DataFrame, out: list[Column], old: list[Column], t_here: Column, s_here: Column, take_source: Column) -> DataFrame:
    signed = F.array(F.when(t_here, F.struct(F.lit(-1).alias(CHANGE), F.struct(*old).alias("row"))), F.struct(F.lit(1).alias(CHANGE), F.struct(*out).alias("row")))
    differs = ~t_here | ~F.struct(*old).eqNullSafe(F.struct(*out))
    return joined.where(take_source & differs).select(F.inline(F.filter(signed, lambda r: r.isNotNull()))).select("row.*", CHANGE)


def _actions(joined: DataFrame, out: list[Column], old: list[Column], t_here: Column, s_here: Column, take_source: Column) -> DataFrame:
    action = F.when(~t_here, "insert").when(take_source, "update").when(s_here, "keep").otherwise("absent")
    return joined.select(*out, action.alias(ACTION))


def merge_changes(target: DataFrame, source: DataFrame, keys: str | Iterable[str], **options) -> DataFrame:
    """What ``merge`` with the same options changes, as signed rows of the target.

    An inserted row has ``change`` 1; an updated one is its old row with -1 and
    its new row with 1; rows that stay as they are, or are updated to what they
    were, are not in it.
    """
    return _prepared(target, source, keys, _changes, **options)


def merge_actions(target: DataFrame, source: DataFrame, keys: str | Iterable[str], **options) -> DataFrame:
    """``merge`` with what was done to each row in ``merge_action``: insert, update, keep (listed, unchanged) or absent (not listed)."""
    return _prepared(target, source, keys, _actions, **options)
