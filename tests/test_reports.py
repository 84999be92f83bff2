import os
from datetime import date

import pytest

from bondscope import corp_report, movers_report, muni_report
from bondscope.sources.results import cleanup, publish, read_result
from checks import adapter
from checks.compare import compare, connect
from checks.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"
DAY = date.fromisoformat(adapter.REPORT_DATE)
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are missing")

CORP_SECTIONS = [
    "report_dates",
    "observed_prices",
    "winners",
    "losers",
    "avg_price_by_date",
    "sentiment",
    "volume_movers",
    "most_quoted",
    "bid_offer_spread_by_date",
    "bid_offer_volume",
    "bid_offer_volume_by_date",
    "raw_data",
]
MUNI_SECTIONS = [
    "report_dates",
    "winners",
    "losers",
    "sentiment",
    "volume_movers",
    "most_quoted",
    "bid_offer_spread",
    "bid_offer_spread_by_date",
    "raw_data",
]


def databases(spark):
    return [d.name for d in spark.catalog.listDatabases() if d.name.startswith("bondscope_")]


@needs_data
def test_corp_report_stages_publishes_and_cleans_up(spark):
    with corp_report(adapter.tables(spark, SF), "HY", DAY) as report:
        assert list(report) == CORP_SECTIONS
        assert len(databases(spark)) == 1
        publish(report)
    # what is published outlives the report
    assert read_result(spark, "winners").columns[-1] == "PreviousPxOnlyComposite"
    sizes = {name: read_result(spark, name).count() for name in report}
    assert sizes["report_dates"] == 1 and all(sizes.values())
    assert sorted(cleanup(spark, report)) == sorted(CORP_SECTIONS)
    assert databases(spark) == []


@needs_data
def test_a_report_that_cannot_be_built_leaves_nothing(spark):
    tables = adapter.tables(spark, SF)
    del tables["security_stats"]
    with pytest.raises(KeyError):
        corp_report(tables, "HY", DAY)
    assert databases(spark) == []


@needs_data
def test_sections_of_the_other_reports(spark):
    tables = adapter.tables(spark, SF)
    with corp_report(tables, "IG", DAY) as report:
        assert list(report) == [s for s in CORP_SECTIONS if s != "avg_price_by_date"]
    with muni_report(tables, DAY) as report:
        assert list(report) == MUNI_SECTIONS
    with movers_report(tables, "HY", DAY, movers=3, sample=2) as report:
        assert list(report) == ["winners", "losers", "sample"]
        assert report["winners"].count() <= 3 and report["sample"].count() <= 2


@needs_data
def test_reports_are_the_same_without_a_staging_folder(spark, monkeypatch):
    tables = adapter.tables(spark, SF)
    found = []
    for named in (True, False):
        if not named:
            monkeypatch.setattr("bondscope.session.configured_folder", lambda spark: None)
        with muni_report(tables, DAY) as report:
            publish(report)
            found.append({name: sorted(map(str, frame.collect())) for name, frame in report.items()})
        assert read_result(spark, "raw_data").count() == len(found[-1]["raw_data"])
        cleanup(spark, report)
    assert found[0] == found[1]


@needs_data
def test_monthly_report_without_a_previous_period(spark):
    with muni_report(adapter.tables(spark, SF), date(2024, 1, 31), "MONTH") as report:
        assert report.window.load_start == date(2023, 11, 30)
        assert report["winners"].count() == 0 and report["sentiment"].count() > 0
        assert report["bid_offer_spread_by_date"].count() > 0


@needs_data
def test_report_over_no_rows(spark):
    with corp_report(adapter.tables(spark, SF), "HY", date(2020, 1, 3)) as report:
        counts = {name: frame.count() for name, frame in report.items()}
    assert counts.pop("report_dates") == 1
    assert not any(counts.values())


def test_the_composites_are_needed(spark):
    with pytest.raises(KeyError):
        muni_report({}, DAY)


# Each kind of row; all of them with ALL_ROWS=1, or with ``python -m checks.compare``.
QUICK = [
    "report_calendar_month",
    "business_snaps",
    "json_scalars_corp",
    "eod_snapshot_corp",
    "period_summary_muni",
    "worst_rating",
    "security_info_corp",
    "raw_data_muni",
    "winners_muni",
    "observed_prices_corp",
    "sentiment_corp_hy",
    "quote_volume_movers_corp",
    "bid_offer_spread_by_date_muni",
    "bid_offer_volume",
    "detail_and_total_lineitem",
    "archived_sectors",
    "published_versions",
    "bundle_csv",
    "loaded_tables_sentiment",
    "short_report_limits",
    "running_max_by_user",
    "value_changes",
]


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("ALL_ROWS") else QUICK)
def test_queries_agree_with_their_sql(spark, name):
    ok, note = compare(spark, connect(SF), SF, name)
    assert ok, note


def test_every_query_has_sql():
    from checks.oracle import ORACLE

    assert set(QUERIES) == set(ORACLE)
