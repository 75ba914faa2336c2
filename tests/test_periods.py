"""Reporting periods against a plain-Python calendar (brute force)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.plans.periods import period_rollup, reporting_periods


def previous_periods(today: dt.date):
    """Independent model of the scheduler's rules, one day at a time."""
    out = [("daily", today, today - dt.timedelta(days=1), today - dt.timedelta(days=1))]
    if today.weekday() == 0:
        end = today - dt.timedelta(days=1)
        out.append(("weekly", today, end - dt.timedelta(days=6), end))
    if today.day == 1:
        last = today - dt.timedelta(days=1)
        out.append(("monthly", today, last.replace(day=1), last))
    if today.month == 1 and today.day == 1:
        out.append(("yearly", today, dt.date(today.year - 1, 1, 1), dt.date(today.year - 1, 12, 31)))
    return out


def test_reporting_periods_match_calendar_rules(spark):
    start = dt.date(2023, 11, 20)
    days = [start + dt.timedelta(days=i) for i in range(500)]
    cal = spark.createDataFrame([(d,) for d in days], "date date")
    got = sorted(tuple(r) for r in reporting_periods(cal).collect())
    want = sorted(p for d in days for p in previous_periods(d))
    assert got == want


def test_period_rollup_counts(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 400, 3)]
    fact = spark.createDataFrame([(d,) for d in days] + [(None,)], "d date")
    got = {(r.frequency, r.beg_date): r.row_count for r in period_rollup(fact, "d").collect()}
    assert sum(v for (f, _), v in got.items() if f == "daily") == len(days)
    monday = lambda d: d - dt.timedelta(days=d.weekday())
    for f, key in [("weekly", monday), ("monthly", lambda d: d.replace(day=1)), ("yearly", lambda d: d.replace(month=1, day=1))]:
        want = {}
        for d in days:
            want[key(d)] = want.get(key(d), 0) + 1
        assert {b: v for (ff, b), v in got.items() if ff == f} == want
    weeks = period_rollup(fact, "d", ["weekly"]).select(F.datediff("exp_date", "beg_date").alias("n")).distinct()
    assert [r.n for r in weeks.collect()] == [6]
