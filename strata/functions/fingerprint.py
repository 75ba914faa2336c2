"""Row fingerprints for change detection.

``sha2(concat_ws(sep, cols...), 256)`` over the non-key columns, in table order.
``concat_ws`` skips nulls, so (a, null, b) and (a, b, null) would hash alike,
and a separator inside a value would shift the borders between columns. By
default a backslash or separator in a value is escaped by a backslash and a null
becomes a marker that no escaped value can equal, so rows hash alike only if
they are equal. With ``null_marker=None`` the plain form is produced.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator and null marker of the fingerprint.
SEPARATOR = "~"
NULL_MARKER = "\\N"


def fingerprint(cols: Iterable[str], sep: str = SEPARATOR, null_marker: str | None = NULL_MARKER) -> Column:
    marker = None if null_marker is None else F.lit(null_marker)
    parts = [F.col(c).cast("string") for c in cols]
    if marker is not None:
        parts = [F.coalesce(F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep)), marker) for p in parts]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def hashed_columns(df: DataFrame, exclude: Iterable[str] = ("id",)) -> list[str]:
    """All columns but the keys and the history columns, in table order."""
    skip = {c.lower() for c in exclude} | {"hash", "beg_date", "exp_date"}
    return [c for c in df.columns if c.lower() not in skip]


def with_row_hash(
    df: DataFrame,
    exclude: Iterable[str] = ("id",),
    name: str = "hash",
    sep: str = SEPARATOR,
    null_marker: str | None = NULL_MARKER,
) -> DataFrame:
    """``df`` plus a ``hash`` column over every non-key column."""
    return df.withColumn(name, fingerprint(hashed_columns(df, exclude), sep, null_marker))
