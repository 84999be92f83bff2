from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bondscope import CORP, MUNI
from bondscope.operators.groups import avg_price_by_group, bid_offer_spread
from bondscope.operators.relational import pivot_by_date, pivot_dates
from bondscope.operators.sentiment import sentiment, with_previous
from bondscope.operators.snapshot import eod_snapshot
from bondscope.operators.volume import bid_offer_volume, most_quoted, quote_volume_movers
from bondscope.operators.wide import raw_data_wide
from tests.golden import WINDOW, at, corp_row, muni_row, rows_of, table

INFO = (
    "SecurityId long, Identifier string, SecurityName string, MoodysIndustry string, Coupon double, Rating string, "
    "IssueDate date, MaturityDate date"
)


def info(spark, *securities):
    """Descriptions from (security, industry, issue date)."""
    rows = [(s, f"ID{s}", f"Bond {s}", g, 5.0, "BB", d, None) for s, g, d in securities]
    return spark.createDataFrame(rows, INFO)


def corp_eod(spark, rows):
    return eod_snapshot(table(spark, "corp_composite", rows), WINDOW, CORP)


def test_sentiment(spark):
    prices = {
        1: {"2024-01-12": 100, "2024-01-22": 99, "2024-01-23": 99},  # the lead-in day is the previous one
        2: {"2024-01-19": 100, "2024-01-22": 101, "2024-01-23": 102},
        3: {"2024-01-19": None, "2024-01-22": 101, "2024-01-23": None},  # missing prices count as unchanged
        4: {"2024-01-22": 50},  # no previous day
    }
    rows = [corp_row(n, s, at(d), p) for n, (s, d, p) in enumerate((s, d, p) for s in prices for d, p in prices[s].items())]
    got = sentiment(corp_eod(spark, rows), CORP)
    assert got.columns == "Date Decliners Advancers Flats DeclinersCount AdvancersCount FlatsCount".split()
    third = Decimal("0.3333333333")
    assert rows_of(got) == [
        (date(2024, 1, 22), third, third, third, 1, 1, 1),
        (date(2024, 1, 23), Decimal(0), third, Decimal("0.6666666666"), 0, 1, 2),
    ]
    assert dict(got.dtypes)["Flats"] == "decimal(38,10)"


def test_sentiment_of_munis_takes_the_offer(spark):
    rows = [muni_row(1, 1, at("2024-01-22"), 100.0, 101.0), muni_row(2, 1, at("2024-01-23"), 101.0, 100.0)]
    got = sentiment(eod_snapshot(table(spark, "muni_composite", rows), WINDOW, MUNI), MUNI)
    assert rows_of(got, "DeclinersCount", "AdvancersCount") == [(1, 0)]


def test_sentiment_counts_equal_the_rows_with_a_previous_day(spark):
    days = ["2024-01-12", "2024-01-17", "2024-01-18", "2024-01-22", "2024-01-25"]
    rows = [corp_row(10 * s + i, s, at(d), 90 + (s * i) % 7) for s in range(1, 9) for i, d in enumerate(days[s % 3 :])]
    eod = corp_eod(spark, rows)
    total = sentiment(eod, CORP).agg(F.sum(F.expr("DeclinersCount + AdvancersCount + FlatsCount"))).first()[0]
    assert total == with_previous(eod, "BidComposite").count() == len(rows) - 8


def test_quote_volume_movers(spark):
    old, new = date(2023, 1, 1), date(2024, 1, 16)
    rows = [
        corp_row(1, 1, at("2024-01-18"), counts=(1, 2, 3)),
        corp_row(2, 1, at("2024-01-19"), counts=(1, None, 3)),
        corp_row(3, 1, at("2024-01-25"), counts=(1, 10, 6)),
        corp_row(4, 2, at("2024-01-25"), counts=(1, 50, 50)),  # not quoted before
        corp_row(5, 3, at("2024-01-18"), counts=(1, 0, 0)),
        corp_row(6, 3, at("2024-01-25"), counts=(1, 4, 4)),  # ties with 1
        corp_row(7, 4, at("2024-01-18")),  # too young
        corp_row(8, 4, at("2024-01-25"), counts=(1, 50, 50)),
        corp_row(9, 5, at("2024-01-18")),  # unknown issue date
        corp_row(10, 5, at("2024-01-25"), counts=(1, 50, 50)),
        corp_row(11, 6, at("2024-01-12"), counts=(1, 9, 9)),  # the lead-in day is no period
        corp_row(12, 6, at("2024-01-19"), counts=None),
        corp_row(13, 6, at("2024-01-25"), counts=(1, 1, None)),
    ]
    described = info(spark, *[(s, "E", old) for s in (1, 2, 3)], (4, "E", new), (5, "E", None), (6, "E", date(2024, 1, 15)))
    got = quote_volume_movers(corp_eod(spark, rows), described, WINDOW, CORP)
    assert got.columns == (
        "Rank SecurityId Identifier SecurityName Coupon MaturityDate TotalQuotes_LookBack TotalQuotes_Report "
        "Increase PercentageIncrease"
    ).split()
    columns = ("Rank", "SecurityId", "TotalQuotes_LookBack", "TotalQuotes_Report", "Increase", "PercentageIncrease")
    assert rows_of(got, *columns) == [
        (1, 1, 8.0, 16.0, 8.0, Decimal(1)),
        (2, 3, 0.0, 8.0, 8.0, Decimal(0)),
        (3, 6, 0.0, 1.0, 1.0, Decimal(0)),
    ]
    assert rows_of(quote_volume_movers(corp_eod(spark, rows), described, WINDOW, CORP, n=1), "SecurityId") == [(1,)]


def test_most_quoted(spark):
    summary = spark.createDataFrame(
        [(1, 3.0), (2, None), (3, 9.0), (4, 3.0), (5, 99.0)], "SecurityId long, ReportPeriod_ProviderCount double"
    )
    described = info(spark, *[(s, "E", None) for s in (1, 2, 3, 4)])
    got = most_quoted(summary, described, CORP, n=3)
    assert got.columns == "SecurityId Identifier SecurityName Coupon MaturityDate Dealers".split()
    assert rows_of(got, "SecurityId", "Dealers") == [(3, 9.0), (1, 3.0), (4, 3.0)]
    assert rows_of(most_quoted(summary, described, CORP), "SecurityId")[-1] == (2,)


DAY = date(2024, 1, 22)


def spread_rows():
    return [
        corp_row(1, 1, at("2024-01-22"), 100, 101),
        corp_row(2, 2, at("2024-01-22"), 100, 103),  # no industry
        corp_row(3, 3, at("2024-01-22"), 100, 105),  # blank industry
        corp_row(4, 4, at("2024-01-22"), 100, 99),  # crossed
        corp_row(5, 5, at("2024-01-22"), 100, 90, og_offer="102"),  # the original offer counts
        corp_row(6, 6, at("2024-01-22"), None, 90),
        corp_row(7, 1, at("2024-01-12"), 100, 150),  # no period
        corp_row(8, 7, at("2024-01-22"), 100, 150),  # not described
    ]


GROUPS = [(1, "E", None), (2, None, None), (3, "", None), (4, "E", None), (5, "E", None), (6, "E", None)]


def test_spread_keeps_missing_and_blank_groups_apart_until_the_pivot(spark):
    got = bid_offer_spread(corp_eod(spark, spread_rows()), info(spark, *GROUPS), CORP)
    assert got.columns == ["MoodysIndustry", "Date", "AvgSpread", "Ord"]
    values = sorted((o, g, d, float(v)) for g, d, v, o in rows_of(got))
    assert values == [
        (0, "All Industries", DAY, 2.75),
        (1, "", DAY, 3.0),
        (1, "", DAY, 5.0),
        (1, "E", DAY, 1.5),
    ]
    pivot = pivot_by_date(got, ["MoodysIndustry"], "AvgSpread", pivot_dates(got, WINDOW))
    assert pivot.columns == ["MoodysIndustry", "01/22/24"]
    assert [(g, float(v)) for g, v in rows_of(pivot)] == [("All Industries", 2.75), ("", 5.0), ("E", 1.5)]


def test_muni_spread_reads_original_composites_from_text(spark):
    rows = [
        muni_row(1, 1, at("2024-01-22"), 100.0, 101.0, og_bid="99.5"),
        muni_row(2, 2, at("2024-01-22"), 100.0, 101.0, og_offer="bad"),
    ]
    eod = eod_snapshot(table(spark, "muni_composite", rows), WINDOW, MUNI)
    states = spark.createDataFrame([(1, "NY"), (2, "NY")], "SecurityId long, State string")
    got = bid_offer_spread(eod, states, MUNI)
    assert sorted(rows_of(got, "State", "AvgSpread", "Ord")) == [("All States", 1.25, 0), ("NY", 1.25, 1)]


def test_avg_price_leaves_the_missing_group_null(spark):
    got = avg_price_by_group(corp_eod(spark, spread_rows()), info(spark, *GROUPS), CORP)
    assert got.columns == ["MoodysIndustry", "Date", "AvgPrice", "Ord"]
    values = {(g, o): v for g, v, o in rows_of(got, "MoodysIndustry", "AvgPrice", "Ord")}
    assert values == {(None, 1): 100, ("", 1): 100, ("E", 1): 100, ("All Industries", 0): 100}
    pivot = pivot_by_date(got, ["MoodysIndustry"], "AvgPrice", pivot_dates(got, WINDOW))
    assert [r[0] for r in rows_of(pivot)] == ["All Industries", None, "", "E"]


def test_totals_agree_with_a_direct_aggregate(spark):
    rows = [corp_row(s, s, at("2024-01-22"), 90 + s % 5, 100 + s % 7) for s in range(1, 40)]
    eod = corp_eod(spark, rows)
    described = info(spark, *[(s, f"G{s % 4}", None) for s in range(1, 40)])
    total = bid_offer_spread(eod, described, CORP).where("Ord = 0").first().AvgSpread
    direct = eod.agg(F.avg(F.col("OfferComposite") - F.col("BidComposite"))).first()[0]
    assert total == direct


def stats_row(sid, day, bids, offers, **more):
    return {"SecurityId": sid, "Date": date.fromisoformat(day), "SectorType": "CORP", "IsAggregate": 1,
            "BidCountByMessage": bids, "OfferCountByMessage": offers, **more}


def test_bid_offer_volume_merges_missing_and_blank_groups(spark):
    rows = [
        stats_row(1, "2024-01-22", 1, 2),
        stats_row(1, "2024-01-22", 10, 20),
        stats_row(2, "2024-01-22", 3, 4),  # no industry
        stats_row(3, "2024-01-22", 5, 6),  # blank industry
        stats_row(1, "2024-01-12", 7, None),  # the load start counts
        stats_row(1, "2024-01-11", 50, 50),
        stats_row(1, "2024-01-29", 50, 50),
        stats_row(1, "2024-01-20", 50, 50),  # Saturday
        stats_row(1, "2024-01-26", 1, 1),
        stats_row(1, "2024-01-22", 50, 50, SectorType="MUNI"),
        stats_row(1, "2024-01-22", 50, 50, IsAggregate=0),
        stats_row(9, "2024-01-22", 50, 50),  # not described
    ]
    described = info(spark, (1, "E", None), (2, None, None), (3, "", None))
    got = bid_offer_volume(table(spark, "security_stats", rows), described, WINDOW)
    assert got.columns == ["MoodysIndustry", "Date", "Side", "QuoteCount", "Ord"]
    pivot = pivot_by_date(got, ["MoodysIndustry", "Side"], "QuoteCount", pivot_dates(got, WINDOW))
    assert pivot.columns == ["MoodysIndustry", "Side", "01/12/24", "01/22/24", "01/26/24"]
    assert rows_of(pivot) == [
        ("All Industries", "BID", 7, 19, 1),
        ("All Industries", "OFFER", None, 32, 1),
        ("", "BID", None, 8, None),
        ("", "OFFER", None, 10, None),
        ("E", "BID", 7, 11, 1),
        ("E", "OFFER", None, 22, 1),
    ]


def test_pivot_over_no_rows_gives_the_key_columns(spark):
    empty = bid_offer_spread(corp_eod(spark, []), info(spark, (1, "E", None)), CORP)
    pivot = pivot_by_date(empty, ["MoodysIndustry"], "AvgSpread", pivot_dates(empty, WINDOW))
    assert pivot.columns == ["MoodysIndustry"] and pivot.count() == 0


def test_raw_data_wide(spark):
    rows = [
        corp_row(1, 1, at("2024-01-12"), 90, 91, counts=(1, 2, 3)),
        corp_row(2, 1, at("2024-01-22"), 100, None, counts=(4, 5, 6)),
        corp_row(3, 2, at("2024-01-22"), 50, 51),
    ]
    eod = corp_eod(spark, rows)
    got = raw_data_wide(eod, info(spark, (1, "E", None), (3, "F", None)), pivot_dates(eod, WINDOW))
    days = ["01/12/24", "01/22/24"]
    assert got.columns == "SecurityId Identifier SecurityName MoodysIndustry Coupon Rating".split() + [
        f"{p}{d}" for p in ("B_CMP_", "O_CMP_", "DL_CT_", "B_CT_", "O_CT_") for d in days
    ]
    first, third = sorted(tuple(r) for r in got.collect())
    assert first[6:] == (90, 100, 91, None, 1.0, 4.0, 2.0, 5.0, 3.0, 6.0)
    assert third[0] == 3 and set(third[6:]) == {None}
    empty = raw_data_wide(corp_eod(spark, []), info(spark, (1, "E", None)), [])
    assert empty.columns == got.columns[:6] and empty.count() == 1


@pytest.mark.parametrize("days", [[date(2024, 1, 22)], []])
def test_pivot_by_given_days(spark, days):
    frame = spark.createDataFrame([("a", DAY, 1.0, 1), ("a", date(2024, 1, 23), 2.0, 1)], "g string, Date date, v double, Ord int")
    got = pivot_by_date(frame, ["g"], "v", days)
    assert rows_of(got) == ([("a", 1.0)] if days else [("a",)])


def test_volume_takes_a_boolean_flag(spark):
    stats = spark.createDataFrame(
        [(1, date(2024, 1, 22), "CORP", True, 2, 3), (1, date(2024, 1, 22), "CORP", False, 7, 7)],
        "SecurityId long, Date date, SectorType string, IsAggregate boolean, BidCountByMessage long, OfferCountByMessage long",
    )
    got = bid_offer_volume(stats, info(spark, (1, "E", None)), WINDOW)
    assert sorted(rows_of(got.where("Ord = 0"), "Side", "QuoteCount")) == [("BID", 2), ("OFFER", 3)]
