"""Averages by day and group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.config import ReportConfig
from bondscope.functions.expressions import try_float
from bondscope.operators.relational import detail_and_total


def _original_or(eod: DataFrame, side: str):
    """The original composite if there is one, else the composite."""
    original = f"Original{side}Composite"
    if isinstance(eod.schema[original].dataType, T.StringType):
        return F.coalesce(try_float(F.col(original)), F.col(f"{side}Composite").cast("double"))
    return F.coalesce(F.col(original), F.col(f"{side}Composite"))


def uncrossed(eod: DataFrame) -> DataFrame:
    """Rows of the two periods whose offer is above the bid, with the spread."""
    offer, bid = _original_or(eod, "Offer"), _original_or(eod, "Bid")
    return eod.where((F.col("Period") <= 2) & (offer > bid)).withColumn("Spread", offer - bid)


def _by_group(eod: DataFrame, info: DataFrame, cfg: ReportConfig, value: str) -> DataFrame:
    return eod.select("SecurityId", F.to_date("Date").alias("Date"), value).join(
        info.select("SecurityId", cfg.group), "SecurityId"
    )


def _averages(rows: DataFrame, value: str, name: str, cfg: ReportConfig) -> DataFrame:
    """Average of ``value`` by day and group and by day, in the type Spark gives averages."""
    kind = rows.select(F.avg(value)).schema[0].dataType
    totals = {"_sum": F.sum(value), "_values": F.count(value)}
    average = F.try_divide("_sum", "_values").cast(kind)
    return detail_and_total(rows, cfg.group, totals, {name: average}, cfg.total_label)


def bid_offer_spread(eod: DataFrame, info: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Average bid-offer spread by day and group, with a total over the groups.

    A missing group is shown blank but stays a row of its own beside the blank group.
    """
    rows = _by_group(uncrossed(eod), info, cfg, "Spread")
    spread = _averages(rows, "Spread", "AvgSpread", cfg)
    return spread.withColumn(cfg.group, F.coalesce(cfg.group, F.lit("")))


def avg_price_by_group(eod: DataFrame, info: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Average bid by day and group, with a total over the groups; a missing group stays NULL."""
    rows = _by_group(eod.where("Period <= 2"), info, cfg, "BidComposite")
    return _averages(rows, "BidComposite", "AvgPrice", cfg)
