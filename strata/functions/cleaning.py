"""String cleaning with a validity flag.

Every string column (keys excepted) is cleaned: characters outside the allowed
set become spaces, the ends are trimmed, runs of whitespace collapse to one
space and words are title-cased (``initcap``: rest of the word lowered). The
row's flag is 1 when every cleaned value equals its original, else 0 (a null
makes it 0). Cleaned values replace the originals.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters kept by the cleaning rule (ASCII letters, digits and
# the apostrophe), its Unicode-letter variant, and the whitespace run pattern.
KEEP_ASCII = r"[^a-zA-Z0-9']"
KEEP_UNICODE = r"[^\p{L}\p{N}']"
WHITESPACE_RUN = r"\s+"


def clean_value(c: str | Column, unicode_letters: bool = False) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    kept = F.trim(F.regexp_replace(col, KEEP_UNICODE if unicode_letters else KEEP_ASCII, " "))
    return F.initcap(F.regexp_replace(kept, WHITESPACE_RUN, " "))


def string_columns(df: DataFrame, exclude: Iterable[str] = ("id",)) -> list[str]:
    skip = {c.lower() for c in exclude}
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name.lower() not in skip
    ]


def valid_flag(df: DataFrame, cols: Iterable[str], unicode_letters: bool = False) -> Column:
    checks = [clean_value(c, unicode_letters) == F.col(c) for c in cols]
    ok = reduce(and_, checks, F.lit(True))
    return F.when(ok, 1).otherwise(0)


def clean_strings(
    df: DataFrame,
    exclude: Iterable[str] = ("id",),
    flag: str = "validFlag",
    unicode_letters: bool = False,
) -> DataFrame:
    """Cleaned table: other columns first, cleaned strings next, then the flag.

    One projection, so it stays inside one whole-stage-codegen span.
    """
    strings = string_columns(df, exclude)
    others = [c for c in df.columns if c not in strings]
    return df.select(
        *others,
        *[clean_value(c, unicode_letters).alias(c) for c in strings],
        valid_flag(df, strings, unicode_letters).alias(flag),
    )
