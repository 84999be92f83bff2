from datetime import date, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bondscope.functions import calendar as cal

DAYS = st.dates(date(1990, 1, 1), date(2080, 12, 31))


@given(DAYS)
def test_default_report_date_is_the_latest_friday(day):
    found = cal.default_report_date(day)
    assert found.weekday() == 4 and timedelta(0) <= day - found < timedelta(days=7)


@given(DAYS)
def test_week_start_is_the_monday_of_a_sunday_based_week(day):
    monday = cal.week_start(day)
    sunday = monday - timedelta(days=1)
    assert monday.weekday() == 0 and sunday <= day < sunday + timedelta(days=7)


@given(DAYS)
def test_load_start_is_a_weekday_before_the_period(day):
    before = cal.business_day_before(day)
    # A Saturday period start goes back to Friday by the plain rule.
    assert before < day and before.weekday() < 5


def test_weekly_window():
    w = cal.report_window(report_date=date(2024, 1, 26))
    assert w.report_date == datetime(2024, 1, 26, 15)
    assert w.previous_date == datetime(2024, 1, 19, 15)
    assert w.report_start == datetime(2024, 1, 22)
    assert w.previous_start == datetime(2024, 1, 15)
    assert w.load_start == date(2024, 1, 12)


@pytest.mark.parametrize(
    "day, report",
    [
        (date(2024, 1, 25), date(2024, 1, 19)),  # Thursday
        (date(2024, 1, 26), date(2024, 1, 26)),  # Friday
        (date(2024, 1, 27), date(2024, 1, 26)),  # Saturday
        (date(2024, 1, 28), date(2024, 1, 26)),  # Sunday
        (date(2024, 1, 29), date(2024, 1, 26)),  # Monday
    ],
)
def test_report_date_by_weekday(day, report):
    assert cal.report_window(as_of=day).report_date.date() == report


def test_month_steps_stay_within_the_shorter_month():
    w = cal.report_window(report_date=date(2023, 3, 31), period="MONTH")
    assert w.previous_date == datetime(2023, 2, 28, 15)
    assert w.previous_start == datetime(2023, 2, 1)
    assert w.report_start == datetime(2023, 3, 1)
    assert w.load_start == date(2023, 1, 31)


def test_month_in_january_goes_back_a_year():
    w = cal.report_window(report_date=date(2024, 1, 31), period="MONTH")
    assert w.previous_date == datetime(2023, 12, 31, 15)
    assert w.load_start == date(2023, 11, 30)


def test_period_starting_on_a_sunday_loads_from_friday():
    w = cal.report_window(report_date=date(2023, 11, 15), period="MONTH")
    assert w.previous_start == datetime(2023, 10, 1) and w.load_start == date(2023, 9, 29)


def test_unknown_period_is_refused(spark):
    with pytest.raises(ValueError):
        cal.report_window(report_date=date(2024, 1, 26), period="YEAR")
    with pytest.raises(ValueError):
        cal.report_calendar(spark.range(1), "id", "DAY")


@pytest.mark.parametrize("period", cal.PERIODS)
def test_columns_follow_the_same_rules(spark, period):
    first = date(2019, 12, 1)
    days = spark.range(1600).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("AsOf"))
    for row in cal.report_calendar(days, "AsOf", period).collect():
        w = cal.report_window(as_of=row.AsOf, period=period)
        assert row.ReportDate == w.report_date and row.PreviousReportDate == w.previous_date
        assert row.ReportStart == w.report_start.date() and row.PreviousStart == w.previous_start.date()
        assert row.LoadStart == w.load_start
