"""Daily market sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondscope.config import ReportConfig
from bondscope.functions.expressions import decimal_ratio


def with_previous(eod: DataFrame, price: str) -> DataFrame:
    """Rows that have an earlier row of their security, with that row's date and price.

    The earlier price may be NULL, so the date decides. The snapshot has one row per
    security and day, so a security's rows stay few.
    """
    history = Window.partitionBy("SecurityId").orderBy("Date")
    return eod.withColumns(
        {"PreviousDate": F.lag("Date").over(history), "PreviousPrice": F.lag(price).over(history)}
    ).where("PreviousDate is not null")


def sentiment(eod: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Shares and numbers of falling, rising and unchanged securities by day.

    A security whose price or earlier price is missing counts as unchanged.
    """
    compared = with_previous(eod.select("SecurityId", "Date", cfg.price), cfg.price)
    before, now = F.col("PreviousPrice"), F.col(cfg.price)
    declining = F.when(before > now, 1).when(before < now, 0)
    counts = (
        compared.select(F.to_date("Date").alias("Date"), declining.alias("_declining"))
        .groupBy("Date")
        .agg(
            F.count_if(F.col("_declining") == 1).alias("DeclinersCount"),
            F.count_if(F.col("_declining") == 0).alias("AdvancersCount"),
            F.count_if(F.col("_declining").isNull()).alias("FlatsCount"),
            F.count("*").alias("_rows"),
        )
    )
    shares = {n: decimal_ratio(F.col(f"{n}Count"), F.col("_rows")) for n in ("Decliners", "Advancers", "Flats")}
    return counts.select(
        "Date",
        *[share.alias(name) for name, share in shares.items()],
        *[f"{name}Count" for name in shares],
    ).orderBy("Date")
