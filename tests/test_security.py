from datetime import date

import pytest

from bondscope.operators.security import (
    floating_curve,
    raw_data,
    restrict_sector,
    security_info_corp,
    security_info_muni,
    worst_rating,
)
from tests.golden import rows_of, table

# Codes 1..25 with the same print order; the title group is the one of order <= 21 here.
CODES = [
    {"code_id": n, "code_title": f"F{n}", "code_group": "rating_fitch" if n <= 21 else "other", "print_order": n}
    for n in range(1, 26)
]


def rating(issuer, sp=None, moodys=None, fitch=None, other=None, rank=1):
    return dict(
        CorpIssuerId=issuer, PaymentRank=rank, SpRating=sp, MoodysRating=moodys, FitchRating=fitch, OtherRating=other
    )


def test_worst_rating(spark):
    ratings = [
        rating(1, sp=5),
        rating(2, 3, 9, 4),
        rating(3, 7, 7, 7, 8),
        rating(4),
        rating(5, sp=20),  # not counted for this agency
        rating(6, sp=19, moodys=20),
        rating(7, moodys=21, other=21),
        rating(8, sp=2),
        rating(8, fitch=12),  # a second row of the same pair
        rating(8, fitch=3, rank=2),
        rating(9, sp=99),  # no such code
    ]
    got = worst_rating(table(spark, "corp_rating", ratings), table(spark, "code", CODES))
    assert sorted(rows_of(got, "CorpIssuerId", "PaymentRank", "RatingOrder", "Rating")) == [
        (1, 1, 5, "F5"),
        (2, 1, 9, "F9"),
        (3, 1, 8, "F8"),
        (4, 1, None, None),
        (5, 1, None, None),
        (6, 1, 20, "F20"),
        (7, 1, None, None),
        (8, 1, 12, "F12"),
        (8, 2, 3, "F3"),
        (9, 1, None, None),
    ]


def test_floating_curve_needs_the_curve_type_and_a_known_code(spark):
    curve = [
        {"SectorType": "CORP", "CurveType": "FloatingIndex", "FloatingIndexId": 1, "CurveValue": 2.0},
        {"SectorType": "CORP", "CurveType": "Treasury", "FloatingIndexId": 2, "CurveValue": 3.0},
        {"SectorType": "CORP", "CurveType": "FloatingIndex", "FloatingIndexId": 77, "CurveValue": 4.0},
    ]
    got = floating_curve(table(spark, "code", CODES), table(spark, "yield_curve", curve))
    assert rows_of(got, "FloatingIndexId", "CurveValue") == [(1, 2.0)]


def corp_inputs(spark):
    security = [
        {
            "SecurityId": n,
            "SecurityName": f"Bond {n}",
            "PrimaryIdentifier": f"ID{n}",
            "SectorType": "CORP",
            "CorpIssuerTicker": f"T{n}",
            "CorpIssuerSectorName": "IG" if n == 4 else None,
            "CorpIssueDate": date(2023, 1, n),
            "CorpIssuerMoodysIndustryName": "Energy",
        }
        for n in range(1, 9)
    ]
    terms = [
        {"security_id": n, "coupon": 5.0, "corp_issuer_id": n, "payment_rank": 1, "maturity_date": date(2030, 1, n)}
        for n in range(1, 8)
    ]
    terms[0] |= {"WAC": 3.25}
    terms[1] |= {"floating_index": 1, "floating_spread": 150.0, "is_conv": False}
    terms[2] |= {"is_conv": True}
    ratings = [rating(1, sp=10), rating(2, sp=11), rating(3, sp=1), rating(5, sp=3, rank=2)]
    curve = [
        {"SectorType": "CORP", "CurveType": "FloatingIndex", "FloatingIndexId": 1, "CurveValue": 2.0},
        {"SectorType": "MUNI", "CurveType": "FloatingIndex", "FloatingIndexId": 1, "CurveValue": 9.0},
    ]
    return (
        table(spark, "security", security),
        table(spark, "security_corp", terms),
        table(spark, "code", CODES),
        table(spark, "yield_curve", curve),
        table(spark, "corp_rating", ratings),
    )


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "SecurityId long")


def test_security_info_corp(spark):
    # 3 is convertible, 7 not in the snapshot, 8 has no terms; 1 is in the snapshot twice.
    info = security_info_corp(ids(spark, 1, 1, 2, 3, 4, 5, 6, 8), *corp_inputs(spark))
    assert info.columns == (
        "SecurityId Ticker SecurityName RatingOrder Rating Sector DerivedSector IssueDate Identifier Coupon "
        "MaturityDate MoodysIndustry"
    ).split()
    got = sorted(rows_of(info, "SecurityId", "RatingOrder", "Rating", "DerivedSector", "Coupon"))
    assert got == [
        (1, 10, "F10", "IG", 3.25),
        (2, 11, "F11", "HY", 3.5),
        (4, None, None, "IG", 5.0),
        (5, None, None, "HY", 5.0),  # rated for another rank only
        (6, None, None, "HY", 5.0),
    ]


def test_restriction_keeps_rows_of_unknown_securities(spark):
    eod = ids(spark, 1, 2, 3, 4, 4)
    info = security_info_corp(eod, *corp_inputs(spark))
    kept, summary, described = restrict_sector(eod, eod.distinct(), info, "HY")
    # 1 and 4 are IG; 3 is convertible and so unknown to the descriptions.
    assert sorted(rows_of(kept)) == [(2,), (3,)]
    assert sorted(rows_of(summary)) == [(2,), (3,)]
    assert rows_of(described, "SecurityId") == [(2,)]


MUNI_SECURITIES = [
    {"SecurityId": 1, "SecurityName": "A", "MuniIssuerState": "NY", "MuniIssuerTicker": "AA", "MuniCoupon": 4.0,
     "SectorType": "MUNI", "MuniRatingFitchName": "AAA", "MuniPurposeSectorName": "School"},
    {"SecurityId": 2, "SecurityName": "B", "MuniIssuerState": "", "SectorType": "MUNI"},
    {"SecurityId": 3, "SecurityName": "C", "MuniIssuerState": None, "SectorType": "MUNI"},
    {"SecurityId": 4, "SecurityName": "D", "MuniIssuerState": "TX", "SectorType": "MUNI"},
]


def test_security_info_muni(spark):
    info = security_info_muni(ids(spark, 1, 1, 2, 3), table(spark, "security", MUNI_SECURITIES))
    assert rows_of(info, "SecurityId", "State", "Ticker", "Coupon") == [(1, "NY", "AA", 4.0)]


def test_raw_data(spark):
    terms = [
        {"security_id": 1, "coupon": 5.0, "floating_index": 1, "floating_spread": -300.0},
        {"security_id": 2, "coupon": 5.0, "floating_index": 9},
    ]
    _, _, code, _, _ = corp_inputs(spark)
    curve = [{"SectorType": "MUNI", "CurveType": "FloatingIndex", "FloatingIndexId": 1, "CurveValue": 2.0}]
    got = raw_data(
        ids(spark, 1, 1, 2, 3),
        table(spark, "security", MUNI_SECURITIES),
        table(spark, "security_muni", terms),
        code,
        table(spark, "yield_curve", curve),
    )
    assert got.columns == "SecurityId Identifier SecurityName IssueDate State Ticker Coupon MaturityDate Rating Sector".split()
    # The blank state stays here, and a security without terms drops out.
    assert sorted(rows_of(got, "SecurityId", "Coupon", "Rating")) == [(1, 0.0, "AAA"), (2, 5.0, None)]


@pytest.mark.parametrize("copies", [1, 5])
def test_a_repeated_code_id_does_not_change_the_worst_rating(spark, copies):
    codes = table(spark, "code", CODES + [dict(c, code_group="copy") for c in CODES] * copies)
    got = worst_rating(table(spark, "corp_rating", [rating(1, sp=5, fitch=8)]), codes)
    assert rows_of(got, "RatingOrder", "Rating") == [(8, "F8")]
