"""Security descriptions, ratings, coupons and the sector restriction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.functions.expressions import derived_sector, not_blank, not_set, resolved_coupon
from bondscope.operators.relational import assert_unique, lookup_join, place_by

# The last print order that counts, by rating column.
LAST_ORDER = {"SpRating": 19, "MoodysRating": 20, "FitchRating": 20, "OtherRating": 20}
TITLE_GROUP = "rating_fitch"
CURVE_TYPE = "FloatingIndex"


def securities_in(security: DataFrame, eod: DataFrame) -> DataFrame:
    """Securities with at least one snapshot row."""
    return security.join(eod.select("SecurityId"), "SecurityId", "left_semi")


def security_info_muni(eod: DataFrame, security: DataFrame) -> DataFrame:
    """Descriptions of the municipal securities in the snapshot that have an issuer state."""
    described = security.where(not_blank(F.col("MuniIssuerState"))).select(
        "SecurityId",
        "SecurityName",
        F.col("MuniEmmaSecurityDesc").alias("SecurityDescription"),
        F.col("MuniIssuerState").alias("State"),
        F.col("MuniDatedDate").alias("DatedDate"),
        F.col("PrimaryIdentifier").alias("Identifier"),
        F.col("MuniCoupon").alias("Coupon"),
        F.col("MuniMaturityDate").alias("MaturityDate"),
        F.col("MuniIssuerTicker").alias("Ticker"),
    )
    return securities_in(place_by(described, "SecurityId"), eod)


def rating_orders(rating: DataFrame, code: DataFrame) -> DataFrame:
    """Print order of every agency rating: issuer, rank, agency and the order if it counts."""
    agencies = F.array(
        *[
            F.struct(
                F.lit(column).alias("Agency"), F.col(column).alias("CodeId"), F.lit(last).alias("LastOrder")
            )
            for column, last in LAST_ORDER.items()
        ]
    )
    given = rating.select(
        "CorpIssuerId", "PaymentRank", F.inline(agencies)
    )
    orders = code.where(F.col("print_order") <= max(LAST_ORDER.values())).select("code_id", "print_order")
    return lookup_join(given, orders, [("CodeId", "code_id")]).select(
        "CorpIssuerId",
        "PaymentRank",
        "Agency",
        F.when(F.col("print_order") <= F.col("LastOrder"), F.col("print_order")).alias("PrintOrder"),
    )


def worst_rating(rating: DataFrame, code: DataFrame) -> DataFrame:
    """The worst rating of every issuer and payment rank over agencies and rows.

    The title is the Fitch code with that order; a pair no agency rates has NULLs.
    """
    worst = (
        rating_orders(rating, code)
        .groupBy("CorpIssuerId", "PaymentRank")
        .agg(F.max("PrintOrder").alias("RatingOrder"))
    )
    titles = code.where(F.col("code_group") == TITLE_GROUP).select(
        F.col("print_order"), F.col("code_title").alias("Rating")
    )
    titles = assert_unique(titles, ["print_order"], "rating title")
    return lookup_join(worst, titles, [("RatingOrder", "print_order")])


def floating_curve(code: DataFrame, curve: DataFrame) -> DataFrame:
    """Curve value by sector type and floating index, for indexes that are known codes."""
    values = curve.where(F.col("CurveType") == CURVE_TYPE).select(
        F.col("SectorType").alias("CurveSector"), "FloatingIndexId", "CurveValue"
    )
    known = code.select(F.col("code_id").alias("FloatingIndexId"))
    return values.join(known, "FloatingIndexId", "left_semi")


def with_coupon(securities: DataFrame, code: DataFrame, curve: DataFrame) -> DataFrame:
    """Add the resolved coupon to securities joined with their terms."""
    priced = lookup_join(
        securities,
        assert_unique(floating_curve(code, curve), ["CurveSector", "FloatingIndexId"], "curve key"),
        [("SectorType", "CurveSector"), ("floating_index", "FloatingIndexId")],
    )
    return priced.withColumn(
        "Coupon",
        resolved_coupon(
            F.col("WAC"),
            F.col("CurveValue"),
            F.col("floating_spread"),
            F.col("coupon_floor"),
            F.col("fixed_coupon"),
        ),
    )


def _terms(terms: DataFrame, *more: str) -> DataFrame:
    return terms.select(
        F.col("security_id").alias("SecurityId"),
        "WAC",
        F.col("coupon").alias("fixed_coupon"),
        "coupon_floor",
        "floating_spread",
        "floating_index",
        F.col("maturity_date").alias("MaturityDate"),
        *more,
    )


def security_info_corp(
    eod: DataFrame,
    security: DataFrame,
    terms: DataFrame,
    code: DataFrame,
    curve: DataFrame,
    rating: DataFrame,
) -> DataFrame:
    """Descriptions, ratings and coupons of the non-convertible corporate securities in the snapshot."""
    plain = _terms(terms.where(not_set(terms, "is_conv")), "corp_issuer_id", "payment_rank")
    described = security.select(
        "SecurityId",
        F.col("CorpIssuerTicker").alias("Ticker"),
        "SecurityName",
        F.col("CorpIssuerSectorName").alias("Sector"),
        F.col("CorpIssueDate").alias("IssueDate"),
        F.col("PrimaryIdentifier").alias("Identifier"),
        F.col("CorpIssuerMoodysIndustryName").alias("MoodysIndustry"),
        "SectorType",
    )
    listed = securities_in(described, eod).join(plain, "SecurityId")
    rated = lookup_join(
        with_coupon(listed, code, curve),
        worst_rating(rating, code),
        [("corp_issuer_id", "CorpIssuerId"), ("payment_rank", "PaymentRank")],
    )
    info = rated.select(
        "SecurityId",
        "Ticker",
        "SecurityName",
        "RatingOrder",
        "Rating",
        "Sector",
        derived_sector(F.col("Rating"), F.col("RatingOrder"), F.col("Sector")).alias("DerivedSector"),
        "IssueDate",
        "Identifier",
        "Coupon",
        "MaturityDate",
        "MoodysIndustry",
    )
    return place_by(info, "SecurityId")


def drop_other_sectors(frame: DataFrame, info: DataFrame, sector: str) -> DataFrame:
    """Drop rows of securities known to be of another sector.

    Rows of securities missing from ``info`` stay.
    """
    return frame.join(info.where(F.col("DerivedSector") != sector).select("SecurityId"), "SecurityId", "left_anti")


def restrict_sector(
    eod: DataFrame, summary: DataFrame, info: DataFrame, sector: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshot, summary and descriptions without securities of other sectors."""
    return (
        drop_other_sectors(eod, info, sector),
        drop_other_sectors(summary, info, sector),
        info.where(F.col("DerivedSector") == sector),
    )


def raw_data(eod: DataFrame, security: DataFrame, terms: DataFrame, code: DataFrame, curve: DataFrame) -> DataFrame:
    """Descriptions and resolved coupons of the municipal securities in the snapshot."""
    described = security.select(
        "SecurityId",
        F.col("PrimaryIdentifier").alias("Identifier"),
        "SecurityName",
        F.col("MuniDatedDate").alias("IssueDate"),
        F.col("MuniIssuerState").alias("State"),
        F.col("MuniIssuerTicker").alias("Ticker"),
        F.col("MuniRatingFitchName").alias("Rating"),
        F.col("MuniPurposeSectorName").alias("Sector"),
        "SectorType",
    )
    listed = securities_in(described, eod).join(_terms(terms), "SecurityId")
    return with_coupon(listed, code, curve).select(
        "SecurityId",
        "Identifier",
        "SecurityName",
        "IssueDate",
        "State",
        "Ticker",
        "Coupon",
        "MaturityDate",
        "Rating",
        "Sector",
    )
