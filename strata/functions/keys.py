"""Key helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def key_list(keys: str | Iterable[str]) -> list[str]:
    """One key column name or several, as a list."""
    return [keys] if isinstance(keys, str) else list(keys)


# Fixed value: separator of the surrogate key's parts.
KEY_SEPARATOR = "_"


def surrogate_key(*cols: str | Column, sep: str = KEY_SEPARATOR) -> Column:
    """``concat_ws(sep, cols...)`` as a readable row label.

    Null parts vanish from ``concat_ws`` (both null -> empty string), so the
    label is not used to match rows; merges match on the natural key columns.
    """
    return F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def comparable(df: DataFrame, keys: Iterable[str], prefix: str) -> dict[str, Column]:
    """Columns without nulls that are equal exactly where the keys are equal, null to null.

    A join on ``<=>`` would be planned on such expressions too; as columns they
    give a window and a join on the same keys one common partitioning.
    """
    out: dict[str, Column] = {}
    for k in key_list(keys):
        kind = df.schema[k].dataType
        if isinstance(kind, NumericType):
            value = F.coalesce(F.col(k), F.lit(0).cast(kind))
        else:
            value = F.coalesce(F.col(k) if isinstance(kind, StringType) else F.col(k).cast("string"), F.lit(""))
        out[f"{prefix}{k}"] = value
        out[f"{prefix}{k}_null"] = F.col(k).isNull()
    return out
