from dataclasses import replace
from datetime import date, datetime

from bondscope import CORP, MUNI
from bondscope.operators.snapshot import eod_snapshot, period_summary
from tests.golden import WINDOW, at, corp_row, muni_row, rows_of, table


def snapshot(spark, rows, cfg=CORP, name="corp_composite"):
    return eod_snapshot(table(spark, name, rows), WINDOW, cfg)


def test_filters_and_newest_of_the_day(spark):
    rows = [
        corp_row(1, 1, at("2024-01-22"), 99),
        corp_row(2, 1, at("2024-01-22"), 98),  # the higher id wins
        corp_row(3, 2, at("2024-01-22"), IsQuarantined=True),
        corp_row(4, 3, at("2024-01-22"), IsQuarantined=False),
        corp_row(5, 4, at("2024-01-22"), IsSnap=False),
        corp_row(6, 5, at("2024-01-20")),  # Saturday
        corp_row(7, 6, at("2024-01-22", "14:59:00")),
        corp_row(8, 7, at("2024-01-22"), None, None),
        corp_row(9, 8, at("2024-01-22"), None, 101),
        corp_row(10, 9, at("2024-01-11")),  # before the window
        corp_row(11, 10, at("2024-01-29")),  # after it
        corp_row(12, 11, at("2024-01-22", "15:00:00.250")),
        corp_row(13, 12, at("2024-01-26", "15:00:00.250")),  # after the report time
        corp_row(14, 13, at("2024-01-26")),
    ]
    assert sorted(rows_of(snapshot(spark, rows), "CorpCompositeId")) == [(2,), (4,), (9,), (12,), (14,)]


def test_period_labels_and_last_record(spark):
    days = {
        "2024-01-12": 3,  # lead-in day
        "2024-01-15": 2,
        "2024-01-19": 2,
        "2024-01-22": 1,
        "2024-01-26": 1,
    }
    rows = [corp_row(i, 1, at(d)) for i, d in enumerate(days)]
    got = {r.Date.date(): (r.Period, r.PeriodRecord) for r in snapshot(spark, rows).collect()}
    last = {"2024-01-12", "2024-01-19", "2024-01-26"}
    assert got == {date.fromisoformat(d): (p, int(d in last)) for d, p in days.items()}


def test_columns_of_both_reports(spark):
    corp = snapshot(spark, [corp_row(1, 1, at("2024-01-22"), og_bid="99.5")])
    assert corp.columns == (
        "CorpCompositeId SecurityId Date BidComposite OfferComposite ProviderCount BidCount OfferCount IsSnap "
        "UpdatedDate IsQuarantined Period OriginalBidComposite OriginalOfferComposite PeriodRecord "
        "CommonProviderCount CommonProviderPercChanged"
    ).split()
    types = dict(corp.dtypes)
    assert types["ProviderCount"] == "double" and types["OriginalBidComposite"] == "decimal(12,5)"
    assert types["CommonProviderCount"] == "int" and types["CommonProviderPercChanged"] == "double"
    muni = snapshot(spark, [muni_row(1, 1, at("2024-01-22"), message="tight")], MUNI, "muni_composite")
    assert muni.columns == (
        "MuniCompositeId SecurityId Date BidComposite OfferComposite ProviderCount BidCount OfferCount IsSnap "
        "JsonDetail UpdatedDate IsQuarantined Period OriginalBidComposite OriginalOfferComposite "
        "BidOfferSpreadMessage PeriodRecord CommonProviderCount CommonProviderPercChanged"
    ).split()
    assert muni.first().BidOfferSpreadMessage == "tight"


def test_summary_pairs_the_last_rows_and_needs_both(spark):
    rows = [
        corp_row(1, 1, at("2024-01-18"), 90),
        corp_row(2, 1, at("2024-01-19"), None, 95, counts=(1, 2, 3)),
        corp_row(3, 1, at("2024-01-25"), 99, 100, counts=(4, 5, 6)),
        corp_row(4, 2, at("2024-01-25")),  # no previous period
        corp_row(5, 3, at("2024-01-12")),  # lead-in day only
        corp_row(6, 3, at("2024-01-25")),
        corp_row(7, 4, at("2024-01-19")),  # no report period
    ]
    summary = period_summary(snapshot(spark, rows), CORP)
    assert summary.columns == ["SecurityId"] + [
        f"{p}_{c}"
        for p in ("ReportPeriod", "PreviousPeriod")
        for c in "MuniCompositeId BidComposite OfferComposite OfferCount BidCount ProviderCount".split()
    ]
    got = summary.collect()
    assert len(got) == 1
    assert tuple(got[0]) == (1, 3, 99, 100, 6.0, 5.0, 4.0, 2, None, 95, 3.0, 2.0, 1.0)


def test_muni_summary_carries_the_text_if_the_snapshot_does(spark):
    rows = [muni_row(1, 1, at("2024-01-19"), message="a"), muni_row(2, 1, at("2024-01-26"), message="b")]
    eod = snapshot(spark, rows, MUNI, "muni_composite")
    row = period_summary(eod, MUNI).first()
    assert '"a"' in row.PreviousPeriod_JsonDetail and '"b"' in row.ReportPeriod_JsonDetail
    assert "ReportPeriod_JsonDetail" not in period_summary(eod.drop("JsonDetail"), MUNI).columns


def test_stored_day_column_limits_the_rows(spark):
    frame = table(spark, "corp_composite", [corp_row(1, 1, at("2024-01-22")), corp_row(2, 2, at("2024-01-22"))])
    stored = frame.selectExpr("*", "case when SecurityId = 1 then date '2024-01-22' else date '2020-01-01' end as Day")
    eod = eod_snapshot(stored, WINDOW, replace(CORP, partition_column="Day"))
    assert rows_of(eod, "SecurityId") == [(1,)]


def test_time_zone_of_the_session_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = snapshot(spark, [corp_row(1, 1, at("2024-01-22"))]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.Date for r in got] == [datetime(2024, 1, 22, 15)]
