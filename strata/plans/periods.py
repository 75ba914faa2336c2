"""Reporting periods as Spark jobs.

``reporting_periods`` turns a calendar (one row per day) into the runs a
scheduler would trigger: for each due day, the previous complete period and
the report date (the day itself). ``period_rollup`` groups a fact by the
period that contains its date, for several frequencies in one pass: rows are
counted per day, and only the days are tagged once per frequency and summed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Supported frequencies.
FREQUENCIES = ("daily", "weekly", "monthly", "yearly")


def _due(d: Column, freq: str) -> tuple[Column, Column, Column]:
    """(is due on d, beg of previous period, end of previous period)."""
    yesterday = F.date_sub(d, 1)
    if freq == "daily":
        return F.lit(True), yesterday, yesterday
    if freq == "weekly":  # due Monday: previous Monday .. Sunday
        return F.dayofweek(d) == 2, F.date_sub(d, 7), yesterday
    if freq == "monthly":  # due on the 1st: previous month
        return F.dayofmonth(d) == 1, F.add_months(d, -1), yesterday
    if freq == "yearly":  # due 1 January: previous year
        y = F.year(d) - 1
        return (F.month(d) == 1) & (F.dayofmonth(d) == 1), F.make_date(y, F.lit(1), F.lit(1)), F.make_date(
            y, F.lit(12), F.lit(31)
        )
    raise ValueError(f"unknown frequency {freq!r}")


def _containing(d: Column, freq: str) -> tuple[Column, Column]:
    """(first day, last day) of the period of ``freq`` that contains d."""
    if freq == "daily":
        return d, d
    if freq == "weekly":
        beg = F.trunc(d, "week")
        return beg, F.date_add(beg, 6)
    if freq == "monthly":
        return F.trunc(d, "month"), F.last_day(d)
    if freq == "yearly":
        return F.trunc(d, "year"), F.make_date(F.year(d), F.lit(12), F.lit(31))
    raise ValueError(f"unknown frequency {freq!r}")


def reporting_periods(
    calendar: DataFrame, date_col: str = "date", freqs: Iterable[str] = FREQUENCIES
) -> DataFrame:
    """frequency, report_date, beg_date, exp_date for every due (day, frequency)."""
    d = F.col(date_col).cast("date")
    runs = []
    for f in freqs:
        due, beg, exp = _due(d, f)
        runs.append(
            F.when(
                due,
                F.struct(
                    F.lit(f).alias("frequency"), d.alias("report_date"), beg.alias("beg_date"), exp.alias("exp_date")
                ),
            )
        )
    return calendar.select(F.inline(F.filter(F.array(*runs), lambda r: r.isNotNull())))


def period_rollup(
    fact: DataFrame, date_col: str, freqs: Iterable[str] = FREQUENCIES, measure: str = "row_count"
) -> DataFrame:
    """Rows of ``fact`` per (frequency, period) of ``date_col``."""
    day = F.col(date_col).cast("date")
    days = fact.filter(day.isNotNull()).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    tags = []
    for f in freqs:
        beg, exp = _containing(F.col("day"), f)
        tags.append(F.struct(F.lit(f).alias("frequency"), beg.alias("beg_date"), exp.alias("exp_date"), F.col("rows").alias("rows")))
    tagged = days.select(F.inline(F.array(*tags)))
    return tagged.groupBy("frequency", "beg_date", "exp_date").agg(F.sum("rows").alias(measure))


# The step from one period of a frequency to the next.
STEPS = {"daily": "1 day", "weekly": "7 day", "monthly": "1 month", "yearly": "1 year"}


def period_spine(ranges: DataFrame, freqs: Iterable[str] = FREQUENCIES) -> DataFrame:
    """Every period of each row of ``ranges`` (frequency, first_day, last_day, ...): its columns, beg_date and exp_date.

    Periods are generated within each row, so nothing is joined; those that
    contain the first and the last day are the ends.
    """
    freqs = list(freqs)
    begins = F.array().cast("array<date>")
    for f in freqs:
        first, last = (_containing(F.col(c), f)[0].cast("date") for c in ("first_day", "last_day"))
        begins = F.when(F.col("frequency") == f, F.sequence(first, last, F.expr(f"interval {STEPS[f]}"))).otherwise(begins)
    rows = ranges.withColumn("beg_date", F.explode(begins))
    exp = F.lit(None).cast("date")
    for f in freqs:
        exp = F.when(F.col("frequency") == f, _containing(F.col("beg_date"), f)[1]).otherwise(exp)
    return rows.withColumn("exp_date", exp).drop("first_day", "last_day")


def period_rollup_filled(
    fact: DataFrame, date_col: str, by: Iterable[str], freqs: Iterable[str] = FREQUENCIES, measure: str = "row_count"
) -> DataFrame:
    """Rows of ``fact`` per (frequency, period, group), 0 where a group has none.

    All groups have the periods from the fact's first day to its last. The fact
    is counted by group and day once; groups and periods are made from these counts.
    """
    by, freqs = list(by), list(freqs)
    day = F.col(date_col).cast("date")
    days = fact.filter(day.isNotNull()).groupBy(*by, day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    tags = []
    for f in freqs:
        beg, exp = _containing(F.col("day"), f)
        tags.append(F.struct(F.lit(f).alias("frequency"), beg.cast("date").alias("beg_date"), exp.cast("date").alias("exp_date"), F.col("day"), F.col("rows").alias("rows")))
    tagged = days.select(*by, F.inline(F.array(*tags)))
    counts = tagged.groupBy("frequency", *by, "beg_date", "exp_date").agg(F.sum("rows").alias(measure))
    groups = tagged.groupBy("frequency", *by).agg(F.min("day").alias("first_own"), F.max("day").alias("last_own"))
    whole = groups.groupBy("frequency").agg(F.min("first_own").alias("first_day"), F.max("last_own").alias("last_day"))
    spine = period_spine(groups.drop("first_own", "last_own").join(whole, "frequency"), freqs)
    zero = spine.withColumn(measure, F.lit(0).cast("long"))
    # a group's null is a group: a union and a sum, not a join
    return counts.unionByName(zero).groupBy("frequency", *by, "beg_date", "exp_date").agg(F.sum(measure).alias(measure))
