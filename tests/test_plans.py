"""Plans the operators must keep, and results under hot keys."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bondscope import CORP, MUNI, report_window
from bondscope.operators.movers import top_movers
from bondscope.operators import observed
from bondscope.operators.observed import observed_prices, staged_prices
from bondscope.operators.relational import lookup_join, pivot_dates
from bondscope.operators.security import security_info_corp, worst_rating
from bondscope.operators.sentiment import sentiment
from bondscope.operators.snapshot import business_snaps, eod_snapshot, period_summary
from bondscope.operators.volume import bid_offer_volume, quote_totals
from bondscope.plans.reports import Report
from bondscope.session import Staging
from bondscope.sources.tables import SCHEMAS, columns_of
from checks import adapter
from tests.golden import WINDOW, at, corp_row, muni_row, quote, rows_of, table

DAYS = ["2024-01-12", "2024-01-18", "2024-01-19", "2024-01-22", "2024-01-25"]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def nodes(frame, name: str) -> int:
    return plan(frame).count(name)


@pytest.fixture(scope="module")
def composites(spark, tmp_path_factory):
    """Stored composites of 40 securities."""
    path = str(tmp_path_factory.mktemp("composites") / "stored")
    rows = [corp_row(100 * i + s, s, at(d), 90 + (s * 7 + i) % 13) for i, d in enumerate(DAYS) for s in range(40)]
    table(spark, "corp_composite", rows).write.parquet(path)
    return spark.read.parquet(path)


def test_scan_filters_and_columns(composites):
    shown = plan(sentiment(eod_snapshot(composites, WINDOW, CORP), CORP))
    pushed = shown[shown.index("PushedFilters") :]
    assert "GreaterThanOrEqual(Date,2024-01-12T00:00)" in pushed and "LessThanOrEqual(Date,2024-01-26T15:00)" in pushed
    assert "EqualTo(IsSnap,true)" in pushed or "IsNotNull(IsSnap)" in pushed
    schema = shown[shown.index("ReadSchema") :].split("\n")[0]
    assert "AdditionalData" not in schema and "UpdatedDate" not in schema


def test_newest_of_the_day_is_cut_before_the_shuffle(composites):
    shown = plan(eod_snapshot(composites, WINDOW, CORP))
    assert "WindowGroupLimit" in shown and "Partial" in shown
    assert shown.index("Final") < shown.index("Exchange hashpartitioning(SecurityId", shown.index("Final"))
    assert nodes(eod_snapshot(composites, WINDOW, CORP), "Exchange") == 2


def test_json_is_parsed_once(composites):
    snapshot = eod_snapshot(composites, WINDOW, CORP)
    assert plan(snapshot).count("from_json(") == 1


def test_no_nested_loops_and_no_python(composites):
    eod = eod_snapshot(composites, WINDOW, CORP)
    for frame in (sentiment(eod, CORP), period_summary(eod, CORP), quote_totals(eod)):
        shown = plan(frame)
        assert "NestedLoop" not in shown and "Cartesian" not in shown and "Python" not in shown


def test_top_k_meets_in_one_partition_only_after_the_limit(spark, composites):
    info = spark.createDataFrame(
        [(s, "i", "t", "n", 1.0, None) for s in range(40)],
        "SecurityId long, Identifier string, Ticker string, SecurityName string, Coupon double, MaturityDate date",
    )
    shown = plan(top_movers(period_summary(eod_snapshot(composites, WINDOW, CORP), CORP), info, CORP))
    assert shown.index("Window [row_number()") < shown.index("TakeOrderedAndProject(limit=300")


def test_text_is_met_after_the_securities_pair(spark, tmp_path):
    rows = [muni_row(10 * i + s, s, at(d), message=f"{s} {d}") for i, d in enumerate(DAYS) for s in range(9)]
    rows += [muni_row(900 + i, None, at(d), message="no security") for i, d in enumerate(DAYS)]
    staging = Staging(spark)
    try:
        eod = staging.table(eod_snapshot(table(spark, "muni_composite", rows), WINDOW, MUNI), "snapshot", "SecurityId", "Date")
        summary = period_summary(eod, MUNI)
        shown = plan(summary)
        assert "HashAggregate" in shown and "SortAggregate" not in shown
        assert "Exchange hashpartitioning" not in shown
        got = {r.SecurityId: r for r in summary.collect()}
        assert len(got) == 10 and got[None].ReportPeriod_JsonDetail is None
        for sid in range(9):
            assert json.loads(got[sid].ReportPeriod_JsonDetail)["BdOfSprMsg"] == f"{sid} 2024-01-25"
            assert json.loads(got[sid].PreviousPeriod_JsonDetail)["BdOfSprMsg"] == f"{sid} 2024-01-19"
        assert summary.columns[:2] == ["SecurityId", "ReportPeriod_MuniCompositeId"]
        assert summary.columns[7:9] == ["ReportPeriod_JsonDetail", "PreviousPeriod_MuniCompositeId"]
    finally:
        staging.release()


def test_days_of_a_pivot_come_with_the_writing_job(spark):
    report = Report(spark, WINDOW)
    days = [at(d) for d in (*DAYS, "2024-01-20", "2023-06-01")]  # a Saturday and a day before the window
    try:
        frame = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "Date timestamp_ntz, v int")
        spark.sparkContext.setJobGroup("days", "days")
        staged, found = report.with_days(frame, "daily")
        none, empty = report.with_days(frame.where("v < 0"), "none")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("days")) == 2
        assert [str(d) for d in found] == DAYS and empty == []
        assert staged.count() == len(days) and none.count() == 0
        assert pivot_dates(staged, WINDOW) == found
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        report.release()


def test_staged_snapshot_needs_no_more_shuffles(spark, composites):
    staging = Staging(spark)
    eod = staging.table(eod_snapshot(composites, WINDOW, CORP), "snapshot", "SecurityId", "Date")
    try:
        assert nodes(period_summary(eod, CORP), "Exchange") == 0
        assert nodes(quote_totals(eod), "Exchange") == 0
        shown = plan(sentiment(eod, CORP))
        assert "hashpartitioning(SecurityId" not in shown and "OriginalBidComposite" not in shown
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = eod.join(period_summary(eod, CORP), "SecurityId")
        assert nodes(joined, "Exchange") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        staging.release()
    assert not spark.catalog.databaseExists("bondscope_x") and staging.tables == []


def test_quote_payload_is_read_in_place_and_cut_by_id(spark, composites, tmp_path):
    debug = [(n, json.dumps({"BdWts": [quote("100", "1")]})) for n in range(2000)]
    spark.createDataFrame(debug, SCHEMAS["corp_composite_debug"]).write.parquet(str(tmp_path / "debug"))
    payload = spark.read.parquet(str(tmp_path / "debug"))
    ids = spark.createDataFrame([(1,), (2,)], "SecurityId long")
    staging = Staging(spark)
    # a threshold below any table: what is broadcast is what was measured
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        eod = staging.table(eod_snapshot(composites, WINDOW, CORP), "snapshot", "SecurityId", "Date")
        frame = staged_prices(staging, eod, ids, CORP, payload)
        shown = plan(frame)
        assert "GreaterThanOrEqual(CorpCompositeID," in shown and "LessThanOrEqual(CorpCompositeID," in shown
        assert "BroadcastHashJoin [_composite" in shown
        # the one exchange is that of the sums; the text goes through none
        assert shown.count(" Exchange hashpartitioning") == 1 and nodes(frame, "SortMergeJoin") == 0
        wide = observed_prices(eod, ids, CORP, payload)
        assert "SortMergeJoin [_composite" in plan(wide)
        assert sorted(rows_of(wide)) == sorted(rows_of(frame)) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        staging.release()


def test_many_wanted_composites_are_joined_by_size(spark, composites, monkeypatch):
    payload = spark.createDataFrame([(n, json.dumps({"BdWts": [quote("100", "1")]})) for n in range(500)], SCHEMAS["corp_composite_debug"])
    ids = spark.createDataFrame([(1,), (2,)], "SecurityId long")
    staging = Staging(spark)
    eod = eod_snapshot(composites, WINDOW, CORP)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = sorted(rows_of(staged_prices(staging, eod, ids, CORP, payload)))
        monkeypatch.setattr(observed, "MET_IN_PLACE", 1)
        many = staged_prices(staging, eod, ids, CORP, payload)
        assert nodes(many, "SortMergeJoin") == 1 and sorted(rows_of(many)) == few != []
        assert staged_prices(staging, eod.limit(0), ids, CORP, payload).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        staging.release()


# --- hot keys --------------------------------------------------------------


def task_rows(frame) -> list[int]:
    """Rows per partition."""
    counts = frame.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in counts)


def hot_composites(spark, copies: int):
    """One security and day with ``copies`` composites, and 1,000 other securities."""
    hot = spark.range(copies).selectExpr("id as CorpCompositeId", "0L as SecurityId")
    rest = spark.range(1000).selectExpr(f"{copies} + id as CorpCompositeId", "id + 1 as SecurityId")
    named = hot.unionByName(rest).selectExpr(
        "*",
        "timestamp_ntz '2024-01-25 15:00:00' as Date",
        "cast(CorpCompositeId % 90 + 1 as decimal(12,5)) as BidComposite",
        "cast(100 as decimal(12,5)) as OfferComposite",
        "true as IsSnap",
        "cast(null as boolean) as IsQuarantined",
        "cast(null as timestamp_ntz) as UpdatedDate",
        "'{}' as AdditionalData",
    )
    return named.select(columns_of("corp_composite"))


def test_a_hot_security_is_cut_to_a_row_per_task_before_it_moves(spark):
    frame = hot_composites(spark, 20_000)
    eod = eod_snapshot(frame, WINDOW, CORP)
    rows = {r.SecurityId: r.CorpCompositeId for r in eod.select("SecurityId", "CorpCompositeId").collect()}
    assert len(rows) == 1001 and rows[0] == 19_999
    shown = eod._jdf.queryExecution().executedPlan().toString()
    assert shown.index("WindowGroupLimit") < shown.rindex("WindowGroupLimit")
    first_shuffle = shown.rindex("Exchange hashpartitioning")
    assert "Partial" in shown[first_shuffle:]


def test_a_hot_issuer_spreads_over_the_tasks(spark):
    securities, hot = 3000, 1000
    terms = spark.range(securities).selectExpr(
        "id as security_id", "cast(null as double) as WAC", "1D as coupon", "cast(null as double) as coupon_floor",
        "cast(null as double) as floating_spread", "cast(null as int) as floating_index",
        "cast(null as date) as maturity_date", f"if(id < {hot}, 7L, id) as corp_issuer_id", "1 as payment_rank",
        "cast(null as boolean) as is_conv",
    )
    master = [{"SecurityId": n, "SectorType": "CORP"} for n in range(securities)]
    codes = [{"code_id": n, "code_title": f"F{n}", "code_group": "rating_fitch", "print_order": n} for n in range(1, 20)]
    ratings = [{"CorpIssuerId": n, "PaymentRank": 1, "SpRating": 1 + n % 19} for n in range(securities)]
    inputs = (
        table(spark, "security", master),
        terms,
        table(spark, "code", codes),
        table(spark, "yield_curve", []),
        table(spark, "corp_rating", ratings),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        info = security_info_corp(spark.range(securities).withColumnRenamed("id", "SecurityId"), *inputs)
        got = dict(rows_of(info, "SecurityId", "RatingOrder"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == securities
    assert all(got[n] == 1 + (7 if n < hot else n) % 19 for n in range(securities))


@pytest.mark.parametrize("hot", ["7L", "cast(null as long)"])
def test_rows_of_one_key_spread_over_the_tasks(spark, hot):
    frame = spark.range(0, 60_000, 1, 4).selectExpr("id", f"if(id % 3 = 0, {hot}, id) as k")
    lookup = spark.range(100).selectExpr("id as code", "concat('t', id) as title")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_join(frame, lookup, [("k", "code")])
        rows = joined.collect()
        shown = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 60_000
    # a hot key is split while the query runs, and rows without a key do not move
    assert "skew=true" in shown if hot == "7L" else "Union" in shown


def test_a_large_lookup_is_not_copied(spark):
    frame = spark.range(1000).selectExpr("id", "id as k")
    lookup = spark.range(400_000).selectExpr("id as code", "concat('title ', id) as title")
    spark.conf.set("spark.sql.shuffle.partitions", "10000")
    try:
        shown = plan(lookup_join(frame, lookup, [("k", "code")]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "explode" not in shown.lower() and "Generate" not in shown


def test_snap_times_and_flags_reach_the_scan(spark, tmp_path):
    rows = [corp_row(n, n, at("2024-01-25")) for n in range(3)]
    table(spark, "corp_composite", rows).write.parquet(str(tmp_path / "composites"))
    stored = spark.read.parquet(str(tmp_path / "composites"))
    snaps = business_snaps(stored, WINDOW, CORP)
    shown = plan(snaps)
    pushed = shown[shown.index("PushedFilters") :]
    assert "EqualTo(IsSnap,true)" in pushed and "2024-01-25T15:00" in pushed
    assert snaps.count() == 3


def test_a_hot_rating_pair_is_added_up_before_it_moves(spark):
    ratings = spark.range(50_000).selectExpr(
        "if(id % 3 = 0, 1L, id) as CorpIssuerId", "1 as PaymentRank", "cast(id % 19 as int) as SpRating",
        "cast(null as int) as MoodysRating", "cast(null as int) as FitchRating", "cast(null as int) as OtherRating",
    )
    codes = [{"code_id": n, "code_title": f"F{n}", "code_group": "rating_fitch", "print_order": n} for n in range(1, 20)]
    worst = worst_rating(ratings, table(spark, "code", codes))
    assert rows_of(worst.where("CorpIssuerId = 1"), "RatingOrder", "Rating") == [(18, "F18")]
    assert "partial_max" in plan(worst)


def test_hot_statistics_are_added_up_before_the_join(spark):
    stats = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 0L, id % 500) as SecurityId", "date '2024-01-22' as Date", "'CORP' as SectorType",
        "1 as IsAggregate", "id as BidCountByMessage", "2 * id as OfferCountByMessage",
    )
    info = spark.range(500).selectExpr("id as SecurityId", "if(id = 0, 'Hot', 'Rest') as MoodysIndustry")
    got = bid_offer_volume(stats, info, WINDOW)
    shown = plan(got)
    assert shown.index("Join") < shown.index("keys=[SecurityId")
    counts = {(g, s): n for g, s, n in rows_of(got, "MoodysIndustry", "Side", "QuoteCount")}
    total = sum(range(30_000))
    assert counts["All Industries", "BID"] == total and counts["All Industries", "OFFER"] == 2 * total
    assert counts["Hot", "BID"] + counts["Rest", "BID"] == total


def test_prices_of_a_hot_security(spark):
    eod = eod_snapshot(table(spark, "corp_composite", [corp_row(1, 1, at("2024-01-25"))]), WINDOW, CORP)
    payload = spark.range(5000).selectExpr(
        "1L as CorpCompositeID",
        """concat('{"BdWts":[{"AggId":', id, ',"Prv":"P","QT":"PRICE","VL":"', id % 2, '","Wts":[{"Wt":"1"}]}]}') as DebugData""",
    )
    ids = spark.createDataFrame([(1,)], "SecurityId long")
    prices = observed_prices(eod, ids, CORP, payload)
    assert rows_of(prices, "WeightedPrice") == [(0.5,)]
    assert "partial_sum" in plan(prices)


def test_decimal_prices_keep_their_type(composites):
    eod = eod_snapshot(composites, WINDOW, CORP)
    assert dict(eod.dtypes)["BidComposite"] == "decimal(12,5)"
    assert isinstance(eod.first().BidComposite, Decimal)


@pytest.mark.parametrize("cfg", [CORP, MUNI], ids=["corp", "muni"])
def test_derived_moments_are_reckoned_once_a_row(spark, tmp_path, cfg):
    rows = [  # the second of the two clicks is not on the hour
        (1, datetime(2024, 1, 24, 9), 7, "click", 100.0, '{"k": 5}'),
        (2, datetime(2024, 1, 24, 9), 7, "click", 101.0, '{"k": 13}'),
        (3, datetime(2024, 1, 25, 9), 7, "purchase", 90.0, '{"k": 2}'),
        (4, datetime(2024, 1, 26, 9), 7, "purchase", 95.0, '{"k": 1}'),
        (5, datetime(2024, 1, 26, 10), 7, "signup", 99.0, '{"k": 1}'),
        (6, datetime(2024, 1, 26, 11), 7, "error", 99.0, '{"k": 1}'),
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    month = report_window(report_date=date(2024, 1, 31), period="MONTH")
    shown = sentiment(eod_snapshot(adapter.TABLES[cfg.composites](spark, str(tmp_path)), month, cfg), cfg)
    assert nodes(shown, "get_json_object(") == 1 and nodes(shown, "date_trunc(") == 1
    got = [(r.Date, r.DeclinersCount, r.AdvancersCount, r.FlatsCount) for r in shown.collect()]
    assert got == [(date(2024, 1, 25), 1, 0, 0), (date(2024, 1, 26), 0, 1, 0)]
