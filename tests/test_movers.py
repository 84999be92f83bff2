from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bondscope import CORP, MUNI
from bondscope.operators.movers import top_movers, with_price_only_change
from tests.golden import at, rows_of

CORP_INFO = "SecurityId long, Identifier string, Ticker string, SecurityName string, Coupon double, MaturityDate date"
MUNI_INFO = (
    "SecurityId long, Identifier string, SecurityName string, SecurityDescription string, State string, "
    "Ticker string, Coupon double, MaturityDate date"
)


def corp(spark, prices):
    """Summary and descriptions from (security, now, before, dealers)."""
    summary = spark.createDataFrame(
        prices,
        "SecurityId long, ReportPeriod_BidComposite double, PreviousPeriod_BidComposite double, "
        "ReportPeriod_BidCount double",
    )
    info = [(p[0], f"ID{p[0]}", "T", "N", 5.0, None) for p in prices]
    return summary, spark.createDataFrame(info, CORP_INFO)


def muni(spark, prices):
    summary = spark.createDataFrame(
        prices,
        "SecurityId long, ReportPeriod_OfferComposite double, PreviousPeriod_OfferComposite double, "
        "ReportPeriod_OfferCount int",
    )
    info = [(p[0], f"ID{p[0]}", "N", "D", "NY", None, 5.0, None) for p in prices]
    return summary, spark.createDataFrame(info, MUNI_INFO)


PRICES = [
    (1, 110.0, 100.0, 2),
    (2, 120.0, 100.0, 1),  # one dealer
    (3, 120.0, 100.0, 2),
    (4, 60.0, 50.0, 5),  # ties with 3
    (5, 90.0, 0.0, 5),  # no base
    (6, None, 100.0, 5),
    (7, 90.0, None, 5),
    (8, 80.0, 100.0, 5),
    (9, 80.0, 100.0, None),
]


def test_winners_and_losers_of_corporates(spark):
    prices = [(a, b, c, None if d is None else float(d)) for a, b, c, d in PRICES]
    summary, info = corp(spark, [*prices, (10, 50.0, -100.0, 5.0)])
    up = top_movers(summary, info, CORP)
    assert up.columns == (
        "Ord SecurityId Identifier Ticker SecurityName Coupon MaturityDate Dealers PercentageChanged "
        "ReportBidComposite PreviousBidComposite"
    ).split()
    assert rows_of(up, "Ord", "SecurityId") == [(1, 3), (2, 4), (3, 1), (4, 8)]
    down = top_movers(summary, info, CORP, ascending=True)
    assert rows_of(down, "Ord", "SecurityId") == [(1, 8), (2, 1), (3, 3), (4, 4)]
    assert down.first().PercentageChanged == pytest.approx(-0.2)


def test_munis_allow_a_negative_base_but_not_zero(spark):
    summary, info = muni(spark, [*PRICES, (10, -50.0, -100.0, 5)])
    up = top_movers(summary, info, MUNI)
    assert up.columns == (
        "Ord SecurityId Identifier SecurityName SecurityDescription ShortName Coupon MaturityDate Dealers "
        "PercentageChanged ReportOfferComposite PreviousOfferComposite"
    ).split()
    assert rows_of(up, "SecurityId") == [(3,), (4,), (1,), (8,), (10,)]
    assert up.first().ShortName == "NY  5.00 "


def test_limit_and_securities_without_description(spark):
    summary, info = corp(spark, [(n, 100.0 + n, 100.0, 3.0) for n in range(1, 8)])
    up = top_movers(summary, info.where("SecurityId <> 7"), CORP, n=2)
    assert rows_of(up, "Ord", "SecurityId") == [(1, 6), (2, 5)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(1, 200)), min_size=1, max_size=60), st.integers(1, 20))
def test_movers_agree_with_a_full_sort(spark, pairs, n):
    prices = [(i, float(a), float(b), 2.0) for i, (a, b) in enumerate(pairs)]
    summary, info = corp(spark, prices)
    ordered = sorted(prices, key=lambda p: (-(p[1] / p[2]), p[0]))
    assert rows_of(top_movers(summary, info, CORP, n), "SecurityId") == [(p[0],) for p in ordered[:n]]
    ordered = sorted(prices, key=lambda p: (p[1] / p[2], p[0]))
    got = top_movers(summary, info, CORP, n, ascending=True)
    assert rows_of(got, "SecurityId") == [(p[0],) for p in ordered[:n]]


def observed(spark):
    rows = [
        (1, at("2024-01-22"), 1, 100.0),
        (1, at("2024-01-25"), 1, 110.0),  # newest of the report period
        (1, at("2024-01-18"), 2, 100.0),
        (2, at("2024-01-25"), 1, 100.0),  # one period only
        (3, at("2024-01-25"), 1, 100.0),
        (3, at("2024-01-19"), 2, None),
        (3, at("2024-01-18"), 2, 50.0),  # an older price does not stand in for the missing one
        (4, at("2024-01-25"), 1, -1.0),
        (4, at("2024-01-19"), 2, 50.0),
    ]
    return spark.createDataFrame(rows, "SecurityId long, Date timestamp_ntz, Period int, WeightedPrice double")


@pytest.mark.parametrize("cfg, ten", [(CORP, Decimal("0.100000")), (MUNI, pytest.approx(0.1))])
def test_price_only_change(spark, cfg, ten):
    movers = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 4), (5, 5)], "Ord int, SecurityId long")
    got = with_price_only_change(movers, observed(spark), cfg)
    assert got.columns == (
        "Ord SecurityId PxOnlyPercentageChanged ReportPxOnlyComposite PreviousPxOnlyComposite".split()
    )
    assert rows_of(got) == [
        (1, 3, None, 100.0, None),
        (2, 1, ten, 110.0, 100.0),
        (3, 2, None, 100.0, None),
        (4, 4, None, -1.0, 50.0),
        (5, 5, None, None, None),
    ]
