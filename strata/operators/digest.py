"""Where two tables differ, without moving what is equal.

Rows are dealt into buckets by a hash of their key; a bucket's digest doesn't
depend on the order of its rows: their number, and two sums of row hashes (60
bits each of the row's SHA-256). The
digests of both sides are small and are compared; only rows of buckets that
differ are read again, reduced to a digest of each key, and joined. If the
tables are equal nothing is joined and the second read doesn't happen.

Defined cases: rows may repeat a key; a key's rows are compared as a bag. Null
keys match each other. Columns are compared as they print, in the order given,
so 1 and 1.0 differ but an int and a long 1 don't. Two empty tables are equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.fingerprint import fingerprint
from strata.functions.keys import key_list

BUCKETS = 4_096


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row, halves of its fingerprint."""
    full = fingerprint(columns)
    return tuple(F.conv(F.substring(full, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 17))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    # as strings, so that keys of other types meet; nulls have a bucket of their own
    return F.pmod(F.xxhash64(F.concat_ws("~", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])), F.lit(buckets)).cast("int")


def _summed(rows: DataFrame, by: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    one, two = _hashes(columns)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("one"), F.sum(two).alias("two"))


def bucket_digests(rows: DataFrame, keys: str | Iterable[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, one, two: a digest of the rows of each bucket of keys. It can be stored beside the table."""
    keys = key_list(keys)
    return _summed(rows, [_bucket(keys, buckets).alias("bucket")], columns or sorted(rows.columns))


def differing_buckets(source: DataFrame, target: DataFrame) -> list[int]:
    """The buckets whose digests differ: at most as many numbers as there are buckets."""
    t = target.select("bucket", *[F.col(c).alias(f"t_{c}") for c in ("n", "one", "two")])
    equal = reduce(and_, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("n", "one", "two")])
    return sorted(r["bucket"] for r in source.join(t, "bucket", "full_outer").where(~equal).select("bucket").collect())


def differences(
    source: DataFrame,
    target: DataFrame,
    keys: str | Iterable[str],
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    target_digests: DataFrame | None = None,
) -> DataFrame:
    """Keys whose rows differ: keys, difference (missing, extra or changed), source_rows, target_rows.

    Missing: not in the target; extra: not in the source. ``target_digests``
    are stored digests of the target, made with the same keys, columns and buckets.
    """
    keys = key_list(keys)
    columns = list(columns or sorted(source.columns))
    stored = bucket_digests(target, keys, columns, buckets) if target_digests is None else target_digests
    found = differing_buckets(bucket_digests(source, keys, columns, buckets), stored)
    here = _bucket(keys, buckets).isin(found) if found else F.lit(False)
    s = _summed(source.where(here), keys, columns)
    t = _summed(target.where(here), keys, columns).select(*[F.col(c).alias(f"t_{c}") for c in (*keys, "n", "one", "two")])
    met = s.join(t, reduce(and_, [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys]), "full_outer")
    only_source, only_target = F.col("t_n").isNull(), F.col("n").isNull()
    equal = reduce(and_, [F.col(c) == F.col(f"t_{c}") for c in ("n", "one", "two")])
    kind = F.when(only_source, "missing").when(only_target, "extra").otherwise("changed")
    return met.where(only_source | only_target | ~equal).select(
        *[F.when(only_target, F.col(f"t_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        kind.alias("difference"),
        F.coalesce("n", F.lit(0)).alias("source_rows"),
        F.coalesce("t_n", F.lit(0)).alias("target_rows"),
    )
