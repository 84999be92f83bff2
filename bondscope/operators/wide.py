"""Raw data with one row per security and columns per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.functions.expressions import SHORT_DATE
from bondscope.operators.relational import short_dates

# Column prefixes of the measures, in output order.
MEASURES = {
    "B_CMP_": "BidComposite",
    "O_CMP_": "OfferComposite",
    "DL_CT_": "ProviderCount",
    "B_CT_": "BidCount",
    "O_CT_": "OfferCount",
}
DESCRIPTIVE = ("SecurityId", "Identifier", "SecurityName", "MoodysIndustry", "Coupon", "Rating")


def raw_data_wide(eod: DataFrame, info: DataFrame, days: Sequence[date]) -> DataFrame:
    """Every described security with five measures for each of the days."""
    labels = short_dates(days)
    described = info.select(*DESCRIPTIVE)
    if not labels:
        return described
    daily = (
        eod.withColumn("_day", F.date_format("Date", SHORT_DATE))
        .groupBy("SecurityId")
        .pivot("_day", labels)
        .agg(*[F.first(column).alias(prefix) for prefix, column in MEASURES.items()])
    )
    measures = [
        F.col(f"`{label}_{prefix}`").alias(f"{prefix}{label}") for prefix in MEASURES for label in labels
    ]
    return described.join(daily, "SecurityId", "left").select(*DESCRIPTIVE, *measures)
