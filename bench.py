"""Time the reports and the heavier operators; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time
from datetime import date

from bondscope import corp_report, movers_report, muni_report
from bondscope.session import build_session
from checks import adapter
from checks.spark_queries import QUERIES

OPERATORS = (
    "eod_snapshot_corp",
    "eod_snapshot_muni",
    "period_summary_corp",
    "security_info_corp",
    "worst_rating",
    "winners_corp",
    "losers_muni",
    "quote_weights",
    "observed_prices_corp",
    "observed_prices_muni",
    "sentiment_muni",
    "quote_volume_movers_corp",
    "most_quoted_muni",
    "bid_offer_spread_corp",
    "bid_offer_volume",
    "raw_data_muni",
    "raw_data_wide",
    "running_max_by_user",
)
REPORTS = {
    "muni_report": muni_report,
    "corp_report_hy": lambda t, d: corp_report(t, "HY", d),
    "corp_report_ig": lambda t, d: corp_report(t, "IG", d),
    "movers_report": lambda t, d: movers_report(t, "HY", d),
}


def run(frame) -> None:
    """Compute all rows and columns and drop them."""
    frame.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    settings = {
        "spark__sql__shuffle__partitions": cpus,
        "spark__driver__memory": "16g",
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    day = date.fromisoformat(adapter.REPORT_DATE)

    def report(build) -> None:
        with build(adapter.tables(spark, sf_dir), day) as sections:
            for frame in sections.values():
                run(frame)

    run(QUERIES["eod_snapshot_corp"](spark, sf_dir))  # start the JVM's workers before timing
    seconds = {name: timed(lambda n=name: run(QUERIES[n](spark, sf_dir))) for name in OPERATORS}
    seconds |= {name: timed(lambda b=build: report(b)) for name, build in REPORTS.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of all reports and operators",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
