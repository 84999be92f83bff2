"""Securities whose price moved most, and their observed-price change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.config import ReportConfig
from bondscope.functions.expressions import change, guarded_change, short_name
from bondscope.operators.relational import top_ranked


def with_short_name(info: DataFrame, cfg: ReportConfig) -> DataFrame:
    if "ShortName" not in cfg.descriptive:
        return info
    return info.withColumn(
        "ShortName", short_name(F.col("State"), F.col("Ticker"), F.col("Coupon"), F.col("MaturityDate"))
    )


def eligible(cfg: ReportConfig) -> Column:
    """Both prices usable and enough dealers."""
    before = F.col(f"PreviousPeriod_{cfg.price}")
    return (
        F.col(f"ReportPeriod_{cfg.price}").isNotNull()
        & (before > 0 if cfg.previous_must_be_positive else before.isNotNull())
        & (F.col(f"ReportPeriod_{cfg.dealers}") >= cfg.min_dealers)
    )


def top_movers(
    summary: DataFrame, info: DataFrame, cfg: ReportConfig, n: int = 300, ascending: bool = False
) -> DataFrame:
    """The ``n`` largest rises (or falls, ascending) in price between the two periods.

    Ties go by security. A previous price of 0 has no ratio and does not rank.
    """
    now, before = F.col(f"ReportPeriod_{cfg.price}"), F.col(f"PreviousPeriod_{cfg.price}")
    moved = (
        summary.where(eligible(cfg))
        .withColumn("_ratio", F.try_divide(now, before))
        .where(F.col("_ratio").isNotNull())
        .join(with_short_name(info, cfg), "SecurityId")
    )
    direction = F.col("_ratio").asc() if ascending else F.col("_ratio").desc()
    ranked = top_ranked(moved, [direction, F.col("SecurityId").asc()], n, "Ord")
    return ranked.select(
        "Ord",
        "SecurityId",
        *cfg.descriptive,
        "Coupon",
        "MaturityDate",
        F.col(f"ReportPeriod_{cfg.dealers}").alias("Dealers"),
        change(now, before).alias("PercentageChanged"),
        now.alias(f"Report{cfg.price}"),
        before.alias(f"Previous{cfg.price}"),
    ).orderBy("Ord")


def latest_observed(observed: DataFrame) -> DataFrame:
    """The newest observed price of each period by security."""

    def newest(period: int) -> Column:
        date = F.when(F.col("Period") == period, F.col("Date"))
        return F.max_by("WeightedPrice", date)

    return observed.groupBy("SecurityId").agg(
        newest(1).alias("ReportPxOnlyComposite"), newest(2).alias("PreviousPxOnlyComposite")
    )


def with_price_only_change(movers: DataFrame, observed: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Movers with the newest observed price of each period and the change between them."""
    now, before = F.col("ReportPxOnlyComposite"), F.col("PreviousPxOnlyComposite")
    return (
        movers.join(latest_observed(observed), "SecurityId", "left")
        .select(
            *movers.columns,
            guarded_change(now, before, cfg.change_type).alias("PxOnlyPercentageChanged"),
            now,
            before,
        )
        .orderBy("Ord")
    )
