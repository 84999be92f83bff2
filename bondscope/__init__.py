"""Periodic bond market reports as Spark DataFrame pipelines."""

from bondscope.config import CORP, MUNI, ReportConfig
from bondscope.functions.calendar import ReportWindow, report_window
from bondscope.plans.reports import Report, corp_report, movers_report, muni_report

__all__ = [
    "CORP",
    "MUNI",
    "Report",
    "ReportConfig",
    "ReportWindow",
    "corp_report",
    "movers_report",
    "muni_report",
    "report_window",
]
