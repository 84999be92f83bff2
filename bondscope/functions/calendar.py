"""Report calendar: which days a report covers and what it compares them with.

Weeks run from Sunday to Saturday and are named by their Monday, so a Sunday
belongs to the Monday after it. ``date_trunc('week')`` puts it with the Monday
before; shifting by one day first gives the wanted week.
"""

from __future__ import annotations

import calendar as _calendar
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIODS = ("WEEK", "MONTH")


@dataclass(frozen=True)
class ReportWindow:
    """Bounds of a report: two periods and the first day that is loaded."""

    report_date: datetime
    previous_date: datetime
    report_start: datetime
    previous_start: datetime
    load_start: date
    period: str = "WEEK"

    def weekdays(self) -> list[date]:
        """The Mondays to Fridays from the first loaded day to the report date."""
        days = (self.report_date.date() - self.load_start).days
        loaded = (self.load_start + timedelta(days=n) for n in range(days + 1))
        return [d for d in loaded if d.weekday() < 5]


def default_report_date(today: date) -> date:
    """The latest Friday on or before ``today``."""
    return today - timedelta(days=(today.weekday() - 4) % 7)


def week_start(day: date) -> date:
    shifted = day + timedelta(days=1)
    return shifted - timedelta(days=shifted.weekday())


def month_start(day: date) -> date:
    return day.replace(day=1)


def month_before(moment: datetime) -> datetime:
    """One month earlier, kept within the shorter month."""
    year, month = (moment.year, moment.month - 1) if moment.month > 1 else (moment.year - 1, 12)
    last = _calendar.monthrange(year, month)[1]
    return moment.replace(year=year, month=month, day=min(moment.day, last))


def business_day_before(day: date) -> date:
    """The weekday before a period start; Sunday and Monday go back to Friday."""
    back = {6: 2, 0: 3}.get(day.weekday(), 1)
    return day - timedelta(days=back)


def _moment(value: date | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.combine(value, time())


def report_window(
    as_of: date | None = None,
    report_date: date | datetime | None = None,
    period: str = "WEEK",
    snap_hour: int = 15,
) -> ReportWindow:
    """Bounds of the report for ``report_date``, or for the latest Friday up to ``as_of``.

    The snap hour is added to the report date, so pass a date or a midnight. A
    period other than WEEK or MONTH raises ValueError.
    """
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, got {period!r}")
    if report_date is None:
        report_date = default_report_date(as_of or date.today())
    end = _moment(report_date) + timedelta(hours=snap_hour)
    if period == "WEEK":
        previous, start = end - timedelta(weeks=1), week_start
    else:
        previous, start = month_before(end), month_start
    previous_start = start(previous.date())
    return ReportWindow(
        report_date=end,
        previous_date=previous,
        report_start=_moment(start(end.date())),
        previous_start=_moment(previous_start),
        load_start=business_day_before(previous_start),
        period=period,
    )


def ntz(value: date | datetime) -> Column:
    """A time-zone-free literal, which folds and reaches the scan as a filter."""
    return F.lit(_moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: date | datetime) -> Column:
    return F.lit(_moment(value).date().isoformat()).cast("date")


# The same rules over a column of dates.


def default_report_date_of(today: Column) -> Column:
    return F.date_sub(F.next_day(today, "FRI"), 7)


def week_start_of(moment: Column) -> Column:
    return F.date_trunc("week", F.date_add(F.to_date(moment), 1)).cast("date")


def month_start_of(moment: Column) -> Column:
    return F.trunc(F.to_date(moment), "month")


def business_day_before_of(start: Column) -> Column:
    weekday = F.dayofweek(start)
    return F.date_sub(start, F.when(weekday == 1, 2).when(weekday == 2, 3).otherwise(1))


def report_calendar(dates: DataFrame, as_of: str, period: str = "WEEK", snap_hour: int = 15) -> DataFrame:
    """The report bounds for every row of ``dates``, taking column ``as_of`` as today."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, got {period!r}")
    step = F.expr("interval 7 days" if period == "WEEK" else "interval 1 month")
    start = week_start_of if period == "WEEK" else month_start_of
    snap = F.expr(f"interval {int(snap_hour)} hours")
    return (
        dates.withColumn("ReportDate", default_report_date_of(F.to_date(as_of)).cast("timestamp_ntz") + snap)
        .withColumn("PreviousReportDate", F.col("ReportDate") - step)
        .withColumn("ReportStart", start(F.col("ReportDate")))
        .withColumn("PreviousStart", start(F.col("PreviousReportDate")))
        .withColumn("LoadStart", business_day_before_of(F.col("PreviousStart")))
    )
