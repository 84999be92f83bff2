"""End-of-day snapshot and the pairing of its two periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondscope.config import ReportConfig
from bondscope.functions.calendar import ReportWindow, day, ntz
from bondscope.functions.expressions import (
    at_hour_of,
    is_set,
    not_set,
    period_label,
    with_json_fields,
)
from bondscope.operators.relational import latest_per, place_by

COUNTS = ("ProviderCount", "BidCount", "OfferCount")


def loaded_days(composites: DataFrame, window: ReportWindow, cfg: ReportConfig) -> DataFrame:
    """Rows of the days the report loads, by time and by the column they are stored by."""
    if cfg.partition_column:
        stored = F.col(cfg.partition_column)
        composites = composites.where(stored.between(day(window.load_start), day(window.report_date)))
    return composites.where(F.col("Date").between(ntz(window.load_start), ntz(window.report_date)))


def business_snaps(composites: DataFrame, window: ReportWindow, cfg: ReportConfig) -> DataFrame:
    """Quoted, unflagged snapshot rows of the window's weekdays at the snap hour."""
    moment = F.col("Date")
    return loaded_days(composites, window, cfg).where(
        is_set(composites, "IsSnap")
        & not_set(composites, "IsQuarantined")
        & (F.col("BidComposite").isNotNull() | F.col("OfferComposite").isNotNull())
        & at_hour_of(moment, window.weekdays(), cfg.snap_hour)
    )


def eod_snapshot(composites: DataFrame, window: ReportWindow, cfg: ReportConfig) -> DataFrame:
    """One row per security and business day: the newest composite, labelled by period.

    JSON scalars are read before the rows are shuffled, so the text itself travels
    only if the caller keeps it. The result is partitioned by security, which every
    later step groups or joins by.
    """
    originals = [f.column for f in cfg.json_fields if f.column not in COUNTS]
    text = [cfg.text_column] if cfg.carries_text else []
    snaps = business_snaps(composites, window, cfg)
    rows = with_json_fields(snaps, cfg.text_column, cfg.json_fields).select(
        cfg.id_column,
        "SecurityId",
        "Date",
        "BidComposite",
        "OfferComposite",
        *COUNTS,
        "IsSnap",
        *text,
        "UpdatedDate",
        "IsQuarantined",
        period_label(F.col("Date"), window).alias("Period"),
        *originals,
    )
    newest = latest_per(rows, ["SecurityId", F.to_date("Date")], cfg.id_column)
    placed = place_by(newest, "SecurityId")
    last = Window.partitionBy("SecurityId", "Period").orderBy(F.desc("Date"))
    return placed.withColumns(
        {
            "PeriodRecord": (F.row_number().over(last) == 1).cast("int"),
            "CommonProviderCount": F.lit(None).cast("int"),
            "CommonProviderPercChanged": F.lit(None).cast("double"),
        }
    )


def period_summary(eod: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The last rows of the report and previous period side by side; both must exist.

    Numbers alone are grouped, in a hash aggregate. JSON text, where the snapshot carries it, is fetched
    afterwards for the securities that pair, by the partitioning that the group left; rows without a
    security, which meet as one, have no text.
    """
    carried = ["BidComposite", "OfferComposite", "OfferCount", "BidCount", "ProviderCount"]
    sources = {"MuniCompositeId": cfg.id_column, **{c: c for c in carried}}
    last = eod.where("PeriodRecord = 1 and Period <= 2")

    def last_of(period: int, prefix: str):
        return [F.max(F.when(F.col("Period") == period, F.col(src))).alias(f"{prefix}_{out}") for out, src in sources.items()]

    periods = {"ReportPeriod": 1, "PreviousPeriod": 2}
    paired = (
        last.groupBy("SecurityId")
        .agg(*[value for prefix, period in periods.items() for value in last_of(period, prefix)])
        .where(" and ".join(f"{prefix}_MuniCompositeId is not null" for prefix in periods))
    )
    if not cfg.carries_text or cfg.text_column not in eod.columns:
        return paired
    for prefix, period in periods.items():
        text = F.col(cfg.text_column).alias(f"{prefix}_{cfg.text_column}")
        paired = paired.join(last.where(F.col("Period") == period).select("SecurityId", text), "SecurityId", "left")
    shown = [*sources, cfg.text_column]
    return paired.select("SecurityId", *[f"{prefix}_{name}" for prefix in periods for name in shown])
