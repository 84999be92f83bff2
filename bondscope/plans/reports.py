"""Whole reports: the operators wired together, with the frames that are reused staged."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from bondscope.config import CORP, MUNI, ReportConfig
from bondscope.functions.calendar import ReportWindow, report_window
from bondscope.operators.groups import avg_price_by_group, bid_offer_spread
from bondscope.operators.movers import top_movers, with_price_only_change
from bondscope.operators.observed import mover_ids, staged_prices
from bondscope.operators.relational import days_present, pivot_by_date, window_days
from bondscope.operators.security import (
    raw_data,
    restrict_sector,
    security_info_corp,
    security_info_muni,
)
from bondscope.operators.sentiment import sentiment
from bondscope.operators.snapshot import business_snaps, eod_snapshot, period_summary
from bondscope.operators.volume import bid_offer_volume, most_quoted, quote_volume_movers
from bondscope.operators.wide import raw_data_wide
from bondscope.session import Staging
from bondscope.sources.tables import report_dates, sample_rows

MOVERS = 300
LISTED = 50


class Report(dict[str, DataFrame]):
    """Report sections by name, and the staged frames they read.

    Leave the ``with`` block, or call ``release``, when all sections are written.
    """

    def __init__(self, spark: SparkSession, window: ReportWindow) -> None:
        super().__init__()
        self.window = window
        #: The days that the sector's snapshot has quotes of.
        self.quoted: list[date] = []
        self.staging = Staging(spark)

    def release(self) -> None:
        self.staging.release()

    def with_days(self, frame: DataFrame, name: str) -> tuple[DataFrame, list[date]]:
        """Stage a frame by date, and the days it has, told by the job that writes it."""
        staged, told = self.staging.measured(frame, name, days=days_present(self.window))
        return staged, window_days(self.window, told["days"])

    @contextmanager
    def building(self) -> Iterator[None]:
        """Let staged frames go if the report cannot be built."""
        try:
            yield
        except BaseException:
            self.release()
            raise

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def _moves(
    report: Report,
    eod: DataFrame,
    summary: DataFrame,
    info: DataFrame,
    payload: DataFrame,
    cfg: ReportConfig,
    n: int,
) -> dict[str, DataFrame]:
    """Ranked movers both ways, their observed prices and the price-only change."""
    rising = report.staging.keep(top_movers(summary, info, cfg, n))
    falling = report.staging.keep(top_movers(summary, info, cfg, n, ascending=True))
    observed = report.staging.keep(staged_prices(report.staging, eod, mover_ids(rising, falling), cfg, payload))
    return {
        "observed_prices": observed,
        "winners": with_price_only_change(rising, observed, cfg),
        "losers": with_price_only_change(falling, observed, cfg),
        "_falling": falling,
    }


def _window(
    report_date: date | datetime | None, period: str, as_of: date | None, cfg: ReportConfig
) -> ReportWindow:
    return report_window(as_of=as_of, report_date=report_date, period=period, snap_hour=cfg.snap_hour)


def muni_report(
    tables: Mapping[str, DataFrame],
    report_date: date | datetime | None = None,
    period: str = "WEEK",
    *,
    as_of: date | None = None,
    movers: int = MOVERS,
    listed: int = LISTED,
    cfg: ReportConfig = MUNI,
) -> Report:
    """All sections of the municipal report, by name and in order."""
    window = _window(report_date, period, as_of, cfg)
    composites, security = tables[cfg.composites], tables["security"]
    report = Report(security.sparkSession, window)
    with report.building():
        # The JSON text stays out of the staged snapshot: only the movers' quotes need it,
        # and they are read from the composites again by id.
        eod = eod_snapshot(composites, window, cfg).drop(cfg.text_column)
        eod = report.staging.table(eod, "snapshot", "SecurityId", "Date")
        info = report.staging.table(security_info_muni(eod, security), "securities", "SecurityId")
        summary = period_summary(eod, cfg)
        moves = _moves(report, eod, summary, info, business_snaps(composites, window, cfg), cfg, movers)
        spread, spread_days = report.with_days(bid_offer_spread(eod, info, cfg), "spread")
        report |= {
            "report_dates": report_dates(security.sparkSession, window),
            "winners": moves["winners"],
            "losers": moves["losers"],
            "sentiment": sentiment(eod, cfg),
            "volume_movers": quote_volume_movers(eod, info, window, cfg, listed),
            "most_quoted": most_quoted(summary, info, cfg, listed),
            "bid_offer_spread": spread.orderBy("Ord", cfg.group, "Date"),
            "bid_offer_spread_by_date": pivot_by_date(spread, [cfg.group], "AvgSpread", spread_days),
            "raw_data": raw_data(eod, security, tables["security_muni"], tables["code"], tables["yield_curve"]),
        }
    return report


def _corp_base(
    tables: Mapping[str, DataFrame], sector: str, window: ReportWindow, cfg: ReportConfig
) -> tuple[Report, DataFrame, DataFrame, DataFrame]:
    """Staged snapshot, summary and descriptions of one sector."""
    composites = tables[cfg.composites]
    report = Report(composites.sparkSession, window)
    with report.building():
        every = report.staging.table(eod_snapshot(composites, window, cfg), "snapshot", "SecurityId", "Date")
        described = security_info_corp(
            every,
            tables["security"],
            tables["security_corp"],
            tables["code"],
            tables["yield_curve"],
            tables["corp_rating"],
        )
        described = report.staging.table(described, "securities", "SecurityId")
        eod, summary, info = restrict_sector(every, period_summary(every, cfg), described, sector)
        eod, told = report.staging.measured_table(eod, "sector_snapshot", "SecurityId", "Date", days=days_present(window))
        report.quoted = window_days(window, told["days"])
    return report, eod, summary, info


def corp_report(
    tables: Mapping[str, DataFrame],
    sector: str = "HY",
    report_date: date | datetime | None = None,
    period: str = "WEEK",
    *,
    as_of: date | None = None,
    movers: int = MOVERS,
    listed: int = LISTED,
    cfg: ReportConfig = CORP,
) -> Report:
    """All sections of the corporate report for one sector, by name and in order."""
    window = _window(report_date, period, as_of, cfg)
    report, eod, summary, info = _corp_base(tables, sector, window, cfg)
    with report.building():
        moves = _moves(report, eod, summary, info, tables[cfg.weights_table], cfg, movers)
        report |= {
            "report_dates": report_dates(eod.sparkSession, window),
            "observed_prices": moves["observed_prices"],
            "winners": moves["winners"],
            "losers": moves["losers"],
        }
        if sector == "HY":
            prices, price_days = report.with_days(avg_price_by_group(eod, info, cfg), "prices")
            report["avg_price_by_date"] = pivot_by_date(prices, [cfg.group], "AvgPrice", price_days)
        spread, spread_days = report.with_days(bid_offer_spread(eod, info, cfg), "spread")
        volume, volume_days = report.with_days(bid_offer_volume(tables["security_stats"], info, window, cfg), "volume")
        report |= {
            "sentiment": sentiment(eod, cfg),
            "volume_movers": quote_volume_movers(eod, info, window, cfg, listed),
            "most_quoted": most_quoted(summary, info, cfg, listed),
            "bid_offer_spread_by_date": pivot_by_date(spread, [cfg.group], "AvgSpread", spread_days),
            "bid_offer_volume": volume.orderBy("Ord", cfg.group, "Date", "Side"),
            "bid_offer_volume_by_date": pivot_by_date(volume, [cfg.group, "Side"], "QuoteCount", volume_days),
            "raw_data": raw_data_wide(eod, info, report.quoted),
        }
    return report


def movers_report(
    tables: Mapping[str, DataFrame],
    sector: str = "HY",
    report_date: date | datetime | None = None,
    period: str = "WEEK",
    *,
    as_of: date | None = None,
    movers: int = MOVERS,
    sample: int = 500,
    cfg: ReportConfig = CORP,
) -> Report:
    """The short corporate report: winners, losers and a sample of the losers."""
    window = _window(report_date, period, as_of, cfg)
    report, eod, summary, info = _corp_base(tables, sector, window, cfg)
    with report.building():
        moves = _moves(report, eod, summary, info, tables[cfg.weights_table], cfg, movers)
        report |= {
            "winners": moves["winners"],
            "losers": moves["losers"],
            "sample": sample_rows(moves["_falling"], sample),
        }
    return report
