"""Exact numeric helpers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(num: Column, den: Column, scale: int = 2) -> Column:
    """``round(num / den, scale)`` with half away from zero, exact, as ``decimal(38, scale)``.

    Integer arithmetic on the sum and the count, so the result does not depend
    on how a double happens to print (``round(avg(x) * k, 2)`` on doubles can
    land on either side of a ``.xx5``). Null when ``den`` is 0 or null, like ``avg``.
    """
    m = 10**scale
    n = num.cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n) * (2 * m) + den, den * 2)
    signed = F.when(n < 0, -q).otherwise(q)
    unit = F.lit(Decimal(1).scaleb(-scale))
    return F.when(den > 0, (signed.cast("decimal(38,0)") * unit).cast(f"decimal(38,{scale})"))
