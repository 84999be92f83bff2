"""Quote and message volume."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.config import CORP, ReportConfig
from bondscope.functions.calendar import ReportWindow, day
from bondscope.functions.expressions import is_set, on_weekday, percent_increase
from bondscope.operators.movers import with_short_name
from bondscope.operators.relational import detail_and_total, top_ranked

# Fixed values of the message statistics.
STATS_SECTOR = "CORP"
SIDES = {"BID": "BidCountByMessage", "OFFER": "OfferCountByMessage"}


def quote_totals(eod: DataFrame) -> DataFrame:
    """Bid and offer quotes of both periods, for securities quoted in both."""
    quotes = F.coalesce("BidCount", F.lit(0)) + F.coalesce("OfferCount", F.lit(0))

    def total(period: int):
        return F.sum(F.when(F.col("Period") == period, quotes))

    return (
        eod.where("Period <= 2")
        .groupBy("SecurityId")
        .agg(total(2).alias("TotalQuotes_LookBack"), total(1).alias("TotalQuotes_Report"))
        .where("TotalQuotes_LookBack is not null and TotalQuotes_Report is not null")
    )


def quote_volume_movers(
    eod: DataFrame, info: DataFrame, window: ReportWindow, cfg: ReportConfig, n: int = 50
) -> DataFrame:
    """The ``n`` seasoned securities whose quotes increased most; ties go by security."""
    seasoned = info.where(F.col(cfg.seasoning) <= day(window.previous_start))
    now, before = F.col("TotalQuotes_Report"), F.col("TotalQuotes_LookBack")
    moved = (
        quote_totals(eod)
        .join(with_short_name(seasoned, cfg), "SecurityId")
        .withColumn("Increase", now - before)
    )
    ranked = top_ranked(moved, [F.desc("Increase"), F.asc("SecurityId")], n, "Rank")
    return ranked.select(
        "Rank",
        "SecurityId",
        *cfg.listed,
        "Coupon",
        "MaturityDate",
        "TotalQuotes_LookBack",
        "TotalQuotes_Report",
        "Increase",
        percent_increase(now, before).alias("PercentageIncrease"),
    ).orderBy("Rank")


def most_quoted(summary: DataFrame, info: DataFrame, cfg: ReportConfig, n: int = 50) -> DataFrame:
    """The ``n`` securities with the most providers; ties go by security."""
    return (
        summary.join(with_short_name(info, cfg), "SecurityId")
        .select(
            "SecurityId",
            *cfg.listed,
            "Coupon",
            "MaturityDate",
            F.col("ReportPeriod_ProviderCount").alias("Dealers"),
        )
        .orderBy(F.desc("Dealers"), "SecurityId")
        .limit(n)
    )


def bid_offer_volume(
    stats: DataFrame, info: DataFrame, window: ReportWindow, cfg: ReportConfig = CORP
) -> DataFrame:
    """Bid and offer messages by weekday, group and side, with a total over the groups.

    Messages are added up per security and day before they meet the descriptions, so
    a security with very many statistics rows is not shuffled whole. A missing group
    counts as the blank one.
    """
    until = window.report_date.date() + timedelta(days=1)
    wanted = stats.where(
        (F.col("SectorType") == STATS_SECTOR)
        & is_set(stats, "IsAggregate")
        & (F.col("Date") >= day(window.load_start))
        & (F.col("Date") < day(until))
        & on_weekday(F.col("Date"))
    )
    daily = wanted.groupBy("SecurityId", "Date").agg(
        *[F.sum(column).alias(side) for side, column in SIDES.items()]
    )
    groups = info.select("SecurityId", F.coalesce(cfg.group, F.lit("")).alias(cfg.group))
    totals = detail_and_total(
        daily.join(groups, "SecurityId"),
        cfg.group,
        {side: F.sum(side) for side in SIDES},
        {side: F.col(side) for side in SIDES},
        cfg.total_label,
    )
    return totals.unpivot([cfg.group, "Date", "Ord"], list(SIDES), "Side", "QuoteCount").select(
        cfg.group, "Date", "Side", "QuoteCount", "Ord"
    )
