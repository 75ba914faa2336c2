"""Date helpers: history sentinels, as-of predicates and period labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Open end of a version and the start of all history.
OPEN_END = dt.date(4444, 1, 1)
BEGINNING = dt.date(1980, 1, 1)

# Period label formats (month as "2024-Mar", day as "2024-03-05").
MONTH_LABEL = "yyyy-MMM"
DAY_LABEL = "yyyy-MM-dd"


def as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def as_of(d: dt.date | str, inclusive: bool = False, beg: str = "beg_date", exp: str = "exp_date") -> Column:
    """Version valid on ``d``.

    Half-open ``beg <= d < exp`` by default, so exactly one version of an id
    matches on a change day. ``inclusive=True`` is ``d BETWEEN beg AND exp``.
    """
    day = F.lit(as_date(d))
    upper = day <= F.col(exp) if inclusive else day < F.col(exp)
    return (F.col(beg) <= day) & upper


def is_open(exp: str = "exp_date") -> Column:
    return F.col(exp) == F.lit(OPEN_END)


def within(c: str | Column, beg: dt.date | str, exp: dt.date | str) -> Column:
    """Closed range on the day of ``c`` (timestamps compare by their date)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("date").between(F.lit(as_date(beg)), F.lit(as_date(exp)))


def month_label(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(F.trunc(col.cast("date"), "MM"), MONTH_LABEL)


def day_label(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col.cast("date"), DAY_LABEL)
