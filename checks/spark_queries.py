"""The registered queries: every operator over the tables of ``adapter``."""

from __future__ import annotations

import weakref
from collections.abc import Callable
from datetime import date
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope import CORP, MUNI, Report, corp_report, movers_report, muni_report, report_window
from bondscope.functions import calendar as cal
from bondscope.functions import expressions as ex
from bondscope.operators import groups, movers, observed, relational, security, snapshot, volume, wide
from bondscope.operators.sentiment import sentiment, with_previous
from bondscope.session import Staging, own_folder
from bondscope.sources import results, tables
from checks import adapter

WINDOW = report_window(report_date=date.fromisoformat(adapter.REPORT_DATE))
DAY = WINDOW.report_date.date()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tidy(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Types both engines print alike: rounded doubles, decimals and times as text, longs and dates."""
    shown = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")  # all digits of its own scale
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), digits)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int").cast("long")
        shown.append(column.alias(field.name))
    return frame.select(*shown)


class Inputs:
    """The adapter tables and the first report steps over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.kept: dict[str, DataFrame] = {}
        self.reports: list[Report] = []
        self.staging = Staging(spark)

    def read(self, name: str) -> DataFrame:
        """A driver table."""
        return adapter.read(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        """A report input table."""
        return adapter.TABLES[name](self.spark, self.sf_dir)

    def tables(self) -> dict[str, DataFrame]:
        return adapter.tables(self.spark, self.sf_dir)

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.kept:
            self.kept[name] = build().persist()
        return self.kept[name]

    def report(self, build: Callable[..., Report], *args) -> Report:
        self.reports.append(build(self.tables(), *args))
        return self.reports[-1]

    def release(self) -> None:
        """Let persisted frames go. Tables a report wrote to a staging folder stay, as its sections need them."""
        for frame in self.kept.values():
            frame.unpersist()
        for report in self.reports:
            report.staging.forget()

    def eod(self, cfg) -> DataFrame:
        return snapshot.eod_snapshot(self.table(cfg.composites), WINDOW, cfg)

    def shared_eod(self, cfg) -> DataFrame:
        """The snapshot for queries that read it more than once."""
        return self._keep(f"eod {cfg.name}", lambda: self.eod(cfg).drop("JsonDetail"))

    def summary(self, cfg) -> DataFrame:
        return snapshot.period_summary(self.shared_eod(cfg), cfg)

    def info(self, cfg, eod: DataFrame | None = None) -> DataFrame:
        eod = self.shared_eod(cfg) if eod is None else eod
        if cfg is MUNI:
            return security.security_info_muni(eod, self.table("security"))
        names = ("security", "security_corp", "code", "yield_curve", "corp_rating")
        return security.security_info_corp(eod, *map(self.table, names))

    def sector(self, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        info = self._keep("info", lambda: self.info(CORP))
        return security.restrict_sector(self.shared_eod(CORP), self.summary(CORP), info, name)

    def movers(self, cfg, ascending: bool = False, n: int = 300) -> DataFrame:
        info = self._keep(f"info {cfg.name}", lambda: self.info(cfg))
        return self._keep(
            f"movers {cfg.name} {ascending} {n}",
            lambda: movers.top_movers(self.summary(cfg), info, cfg, n, ascending),
        )

    def observed(self, cfg) -> DataFrame:
        ids = observed.mover_ids(self.movers(cfg), self.movers(cfg, ascending=True))
        payload = self.table(cfg.weights_table)
        if cfg is MUNI:
            payload = snapshot.loaded_days(payload, WINDOW, cfg)
        return observed.staged_prices(self.staging, self.shared_eod(cfg), ids, cfg, payload)


def by_date(frame: DataFrame, keys: list[str], value: str) -> DataFrame:
    return relational.pivot_by_date(frame, keys, value, relational.pivot_dates(frame, WINDOW))


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query. What it persists is let go when its result is no longer held."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = Inputs(spark, sf_dir)
        result = tidy(build(inputs))
        weakref.finalize(result, inputs.release).atexit = False
        return result

    QUERIES[build.__name__] = run
    return build


# --- report calendar -------------------------------------------------------


@query
def report_calendar_week(i):
    dates = i.read("orders").select(F.to_date("o_orderdate").alias("AsOf")).distinct()
    return cal.report_calendar(dates, "AsOf", "WEEK")


@query
def report_calendar_month(i):
    dates = i.read("orders").select(F.to_date("o_orderdate").alias("AsOf")).distinct()
    return cal.report_calendar(dates, "AsOf", "MONTH")


@query
def report_dates(i):
    newest = i.read("events").agg(F.max("ts")).first()[0]
    return tables.report_dates(i.spark, report_window(as_of=newest.date()))


@query
def date_formats(i):
    day = F.col("o_orderdate")
    return (
        i.read("orders")
        .select("o_orderdate")
        .distinct()
        .select(
            F.to_date(day).alias("Day"),
            F.date_format(day, ex.SHORT_DATE).alias("Short"),
            F.date_format(day, ex.LONG_DATE).alias("Long"),
            F.date_format(day, "yyyyMMdd").alias("Compact"),
            ex.on_weekday(day).alias("OnWeekday"),
            ex.at_hour(day, 0).alias("AtMidnight"),
        )
    )


# --- scans and expressions -------------------------------------------------


@query
def json_scalars_corp(i):
    composites = i.table("corp_composite").select("CorpCompositeId", "AdditionalData")
    return ex.with_json_fields(composites, "AdditionalData", CORP.json_fields).drop("AdditionalData")


@query
def json_scalars_muni(i):
    composites = i.table("muni_composite").select("MuniCompositeId", "JsonDetail")
    return ex.with_json_fields(composites, "JsonDetail", MUNI.json_fields).drop("JsonDetail")


@query
def business_snaps(i):
    rows = snapshot.business_snaps(i.table("corp_composite"), WINDOW, CORP)
    return rows.select("CorpCompositeId", "SecurityId", "Date", "BidComposite", "OfferComposite")


@query
def period_labels(i):
    rows = i.table("corp_composite").withColumn("Period", ex.period_label(F.col("Date"), WINDOW))
    return rows.groupBy(F.to_date("Date").alias("Date"), "Period").agg(F.count("*").alias("Rows"))


@query
def short_names(i):
    name = ex.short_name(
        F.col("MuniIssuerState"), F.col("MuniIssuerTicker"), F.col("MuniCoupon"), F.col("MuniMaturityDate")
    )
    return i.table("security").select("SecurityId", name.alias("ShortName"))


@query
def named_state_securities(i):
    return (
        i.table("security")
        .where(ex.not_blank(F.col("MuniIssuerState")))
        .groupBy(F.col("MuniIssuerState").alias("State"))
        .agg(F.count("*").alias("Securities"))
    )


@query
def value_changes(i):
    """Every customer's year against the year before; a missing year before has no price and no orders."""
    years = i.read("orders").groupBy("o_custkey", F.year("o_orderdate").alias("year"))
    now = years.agg(F.sum("o_totalprice").alias("now"), F.count("*").alias("orders_now"))
    before = now.select(
        "o_custkey",
        (F.col("year") + 1).alias("year"),
        F.col("now").alias("before"),
        F.col("orders_now").alias("orders_before"),
    )
    return (
        now.join(before, ["o_custkey", "year"], "left")
        .select(
            "o_custkey",
            "year",
            ex.change(F.col("now"), F.col("before")).alias("Change"),
            ex.guarded_change(F.col("now"), F.col("before"), "decimal(20,6)").alias("GuardedChange"),
            ex.percent_increase(F.col("orders_now"), F.col("orders_before")).alias("PercentIncrease"),
        )
    )


@query
def measures_to_long(i):
    parts = i.read("part").selectExpr(
        "p_partkey", "cast(p_size as double) as size", "p_retailprice as price"
    )
    return tables.to_long(parts, ["p_partkey"], ["size", "price"])


# --- windows ---------------------------------------------------------------


@query
def latest_per_user_and_day(i):
    events = i.read("events")
    return relational.latest_per(events, ["user_id", F.to_date("ts")], "event_id").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), "value"
    )


@query
def running_max_by_user(i):
    events = i.read("events").select("event_id", "user_id", "ts", "value")
    return relational.running_max(events, "value", ["ts", "event_id"], keys=["user_id"]).drop("ts")


@query
def running_max_overall(i):
    events = i.read("events").select("event_id", "ts", "value")
    return relational.running_max(events, "value", ["ts", "event_id"]).drop("ts")


@query
def previous_prices(i):
    return with_previous(i.eod(CORP), "BidComposite").select(
        "SecurityId", "Date", "BidComposite", "PreviousDate", "PreviousPrice"
    )


# --- snapshot and summary --------------------------------------------------


@query
def eod_snapshot_corp(i):
    return i.eod(CORP)


@query
def eod_snapshot_muni(i):
    return i.eod(MUNI).drop("JsonDetail")


@query
def period_summary_corp(i):
    return snapshot.period_summary(i.eod(CORP), CORP)


@query
def period_summary_muni(i):
    return snapshot.period_summary(i.eod(MUNI), MUNI).drop("ReportPeriod_JsonDetail", "PreviousPeriod_JsonDetail")


@query
def period_summary_text_muni(i):
    """What the JSON text of both last rows says."""
    eod = i.staging.table(i.eod(MUNI), "muni_text", "SecurityId")
    fields = {"Message": "$.BdOfSprMsg", "Bid": "$.OgBdCmp", "Quote": "$.OfWts[1].AggId"}
    kinds = {"Message": "string", "Bid": "double", "Quote": "long"}
    return snapshot.period_summary(eod, MUNI).select(
        "SecurityId",
        *[
            F.get_json_object(f"{period}_JsonDetail", path).cast(kinds[name]).alias(f"{period}_{name}")
            for period in ("ReportPeriod", "PreviousPeriod")
            for name, path in fields.items()
        ],
    )


MONTH = report_window(report_date=date(2024, 1, 31), period="MONTH")


@query
def sentiment_month_muni(i):
    return sentiment(snapshot.eod_snapshot(i.table("muni_composite"), MONTH, MUNI), MUNI)


@query
def sentiment_month_corp(i):
    return sentiment(snapshot.eod_snapshot(i.table("corp_composite"), MONTH, CORP), CORP)


@query
def quote_totals_corp(i):
    return volume.quote_totals(i.eod(CORP))


@query
def uncrossed_rows_corp(i):
    return groups.uncrossed(i.eod(CORP)).select("CorpCompositeId", "Period", "Spread")


# --- securities ------------------------------------------------------------


@query
def security_info_muni(i):
    return i.info(MUNI, i.eod(MUNI))


@query
def security_info_corp(i):
    return i.info(CORP, i.eod(CORP))


@query
def security_info_all_corp(i):
    """Descriptions of every security, whether quoted or not."""
    return i.info(CORP, i.table("security").select("SecurityId"))


@query
def resolved_coupons(i):
    securities = i.table("security").join(
        i.table("security_corp").withColumnsRenamed({"security_id": "SecurityId", "coupon": "fixed_coupon"}), "SecurityId"
    )
    priced = security.with_coupon(securities, i.table("code"), i.table("yield_curve"))
    return priced.select("SecurityId", "CurveValue", "Coupon")


@query
def securities_in_snapshot(i):
    return security.securities_in(i.table("security"), i.eod(CORP)).select("SecurityId", "SecurityName")


@query
def rating_orders(i):
    orders = security.rating_orders(i.table("corp_rating"), i.table("code"))
    return orders.groupBy("Agency", "PrintOrder").agg(F.count("*").alias("Ratings"))


@query
def worst_rating(i):
    return security.worst_rating(i.table("corp_rating"), i.table("code"))


@query
def floating_curve(i):
    return security.floating_curve(i.table("code"), i.table("yield_curve"))


def _restricted(i, sector):
    eod, summary, info = i.sector(sector)
    parts = [
        frame.select(F.lit(name).alias("Frame"), "SecurityId")
        for name, frame in (("eod", eod), ("summary", summary), ("info", info))
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("Frame", "SecurityId").agg(F.count("*").alias("Rows"))


@query
def restrict_sector_hy(i):
    return _restricted(i, "HY")


@query
def restrict_sector_ig(i):
    return _restricted(i, "IG")


@query
def raw_data_muni(i):
    return security.raw_data(
        i.eod(MUNI), *map(i.table, ("security", "security_muni", "code", "yield_curve"))
    )


# --- movers and observed prices --------------------------------------------


@query
def winners_corp(i):
    return i.movers(CORP)


@query
def losers_corp(i):
    return i.movers(CORP, ascending=True)


@query
def winners_muni(i):
    return i.movers(MUNI)


@query
def losers_muni(i):
    return i.movers(MUNI, ascending=True)


@query
def ten_winners_muni(i):
    return i.movers(MUNI, n=10)


@query
def quote_weights(i):
    payload = i.table("corp_composite_debug")
    return observed.quote_weights(observed.quotes_of(payload, CORP), ["CorpCompositeID"])


@query
def weighted_price_by_part(i):
    lines = i.read("lineitem")
    return observed.weighted_price(lines, ["l_partkey"], "l_extendedprice", "l_quantity")


@query
def observed_prices_corp(i):
    return i.observed(CORP)


@query
def observed_prices_muni(i):
    return i.observed(MUNI)


@query
def mover_ids_corp(i):
    return observed.mover_ids(i.movers(CORP), i.movers(CORP, ascending=True))


@query
def latest_observed_muni(i):
    return movers.latest_observed(i.observed(MUNI))


@query
def price_only_losers_corp(i):
    return movers.with_price_only_change(i.movers(CORP, ascending=True), i.observed(CORP), CORP)


@query
def price_only_winners_muni(i):
    return movers.with_price_only_change(i.movers(MUNI), i.observed(MUNI), MUNI)


@query
def price_only_winners_corp(i):
    return movers.with_price_only_change(i.movers(CORP), i.observed(CORP), CORP)


@query
def price_only_losers_muni(i):
    return movers.with_price_only_change(i.movers(MUNI, ascending=True), i.observed(MUNI), MUNI)


# --- sentiment, volume and groups ------------------------------------------


@query
def sentiment_corp_hy(i):
    return sentiment(i.sector("HY")[0], CORP)


@query
def sentiment_corp_ig(i):
    return sentiment(i.sector("IG")[0], CORP)


@query
def sentiment_muni(i):
    return sentiment(i.eod(MUNI), MUNI)


@query
def quote_volume_movers_corp(i):
    return volume.quote_volume_movers(i.shared_eod(CORP), i.info(CORP), WINDOW, CORP)


@query
def quote_volume_movers_muni(i):
    return volume.quote_volume_movers(i.shared_eod(MUNI), i.info(MUNI), WINDOW, MUNI)


@query
def most_quoted_corp(i):
    return volume.most_quoted(i.summary(CORP), i.info(CORP), CORP)


@query
def most_quoted_muni(i):
    return volume.most_quoted(i.summary(MUNI), i.info(MUNI), MUNI)


@query
def bid_offer_spread_corp(i):
    return groups.bid_offer_spread(i.shared_eod(CORP), i.info(CORP), CORP)


@query
def bid_offer_spread_muni(i):
    return groups.bid_offer_spread(i.shared_eod(MUNI), i.info(MUNI), MUNI)


@query
def bid_offer_spread_by_date_corp(i):
    return by_date(bid_offer_spread_corp(i), ["MoodysIndustry"], "AvgSpread")


@query
def bid_offer_spread_by_date_muni(i):
    return by_date(bid_offer_spread_muni(i), ["State"], "AvgSpread")


@query
def avg_price_by_group(i):
    eod, _, info = i.sector("HY")
    return groups.avg_price_by_group(eod, info, CORP)


@query
def avg_price_by_date(i):
    return by_date(avg_price_by_group(i), ["MoodysIndustry"], "AvgPrice")


@query
def bid_offer_volume(i):
    return volume.bid_offer_volume(i.table("security_stats"), i.info(CORP), WINDOW)


@query
def bid_offer_volume_by_date(i):
    return by_date(bid_offer_volume(i), ["MoodysIndustry", "Side"], "QuoteCount")


@query
def detail_and_total_lineitem(i):
    lines = i.read("lineitem").select(
        F.to_date("l_shipdate").alias("Date"), F.col("l_returnflag").alias("Flag"), "l_extendedprice"
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)")  # sums of sums are exact
    totals = {"Price": F.sum(price), "Lines": F.count("*")}
    average = (F.col("Price") / F.col("Lines")).cast("decimal(18,6)")
    measures = {"AvgPrice": average, "Lines": F.col("Lines")}
    return relational.detail_and_total(lines, "Flag", totals, measures, "All flags")


@query
def raw_data_wide(i):
    eod = i.shared_eod(CORP)
    return wide.raw_data_wide(eod, i.info(CORP), relational.pivot_dates(eod, WINDOW))


# --- publishing and whole reports ------------------------------------------


@query
def published_most_quoted(i):
    results.publish({"most_quoted": most_quoted_corp(i)})
    return results.read_result(i.spark, "most_quoted")


def _bundled(i, fmt: str) -> DataFrame:
    """Orders with awkward comments, written as a bundle of two sections and read back."""
    number = F.col("o_orderkey") % 8
    comment = (
        F.when(number == 0, F.concat(F.lit(" lead\n"), "o_orderpriority"))
        .when(number == 1, F.lit(""))
        .when(number == 2, F.lit(None))
        .when(number == 3, F.lit("\\N"))
        .when(number == 4, F.concat(F.lit('"\\n'), "o_orderpriority", F.lit('", \\\r\n')))
        .otherwise(F.col("o_orderpriority"))
    )
    orders = i.read("orders").select("o_orderkey", comment.alias("told"), "o_totalprice", F.to_date("o_orderdate").alias("day"))
    root = own_folder(i.spark, "bundle")
    results.write_bundle(i.spark, {"orders": orders, "days": orders.groupBy("day").count()}, root, fmt)
    found = results.read_bundle(i.spark, root, fmt)
    shown = found["orders"].join(found["days"], "day")
    return shown.select("o_orderkey", F.hex("told").alias("told"), F.length("told").alias("points"), "o_totalprice", "day", "count")


@query
def bundle_parquet(i):
    return _bundled(i, "parquet")


@query
def bundle_csv(i):
    return _bundled(i, "csv")


@query
def loaded_tables_sentiment(i):
    """The adapter tables written with other types, loaded, and read by a section."""
    root = own_folder(i.spark, "tables")
    for name in tables.MUNI_TABLES:
        frame = i.table(name)
        kinds = dict(frame.dtypes)
        other = {c: F.col(c).cast("int") for c, kind in kinds.items() if kind == "boolean"}
        other |= {c: F.col(c).cast("timestamp") for c, kind in kinds.items() if kind == "timestamp_ntz"}
        other |= {c: F.col(c).cast("decimal(18,0)") for c, kind in kinds.items() if c == "SecurityId"}
        frame.withColumns(other).write.parquet(f"{root}/{name}")
    loaded = tables.load_tables(i.spark, tables.MUNI_TABLES, root)
    eod = snapshot.eod_snapshot(loaded["muni_composite"], WINDOW, MUNI)
    return sentiment(eod, MUNI)


@query
def published_versions(i):
    """A run published twice, with a broken publish between; readers see whole runs only."""
    root = own_folder(i.spark, "published")
    listed = most_quoted_corp(i)
    results.publish({"most_quoted": listed.limit(1), "second": listed}, root, report_date=DAY, sector="HY")
    broken = {"most_quoted": listed.limit(2), "second": listed.select(F.raise_error(F.lit("broken")).alias("x"))}
    try:
        results.publish(broken, root, report_date=DAY, sector="HY")
    except (PySparkException, Py4JJavaError) as error:
        if "broken" not in str(error):
            raise
    first = results.read_result(i.spark, "most_quoted", root, report_date=DAY, sector="HY").count()
    results.publish({"most_quoted": listed}, root, report_date=DAY, sector="HY")
    now = results.read_result(i.spark, "most_quoted", root, report_date=DAY, sector="HY")
    return now.drop("report_date").withColumn("RowsBefore", F.lit(first).cast("long"))


REPORTS = {
    "muni": (lambda i: i.report(muni_report, DAY), (
        "winners", "losers", "sentiment", "volume_movers", "most_quoted",
        "bid_offer_spread", "bid_offer_spread_by_date", "raw_data",
    )),
    "corp_hy": (lambda i: i.report(corp_report, "HY", DAY), (
        "observed_prices", "winners", "losers", "avg_price_by_date", "sentiment", "volume_movers", "most_quoted",
        "bid_offer_spread_by_date", "bid_offer_volume", "bid_offer_volume_by_date", "raw_data",
    )),
    "corp_ig": (lambda i: i.report(corp_report, "IG", DAY), (
        "observed_prices", "winners", "losers", "sentiment", "volume_movers", "most_quoted",
        "bid_offer_spread_by_date", "bid_offer_volume", "bid_offer_volume_by_date", "raw_data",
    )),
    "short_hy": (lambda i: i.report(movers_report, "HY", DAY), ("winners", "losers")),
}


def long_form(section: DataFrame) -> DataFrame:
    """How often each value occurs in each column of a section, whatever the order of rows."""
    shown = tidy(section)
    texts = []
    for field in shown.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = column.cast("decimal(28,6)")
        text = F.coalesce(column.cast("string"), F.lit("NULL"))
        texts.append(F.struct(F.lit(field.name).alias("Column"), text.alias("Value")))
    cells = shown.select(F.explode(F.array(*texts)).alias("_cell")).select("_cell.*")
    return cells.groupBy("Column", "Value").agg(F.count("*").alias("Rows"))


def _whole_report(kind: str) -> None:
    build, sections = REPORTS[kind]

    def run(i: Inputs) -> DataFrame:
        report = build(i)
        parts = [long_form(report[name]).select(F.lit(name).alias("Section"), "*") for name in sections]
        return reduce(DataFrame.unionByName, parts)

    run.__name__ = f"{kind}_report_values"
    query(run)


for _kind in REPORTS:
    _whole_report(_kind)


def _sizes(report: Report) -> DataFrame:
    sections = [
        frame.agg(F.count("*").alias("Rows")).select(F.lit(name).alias("Section"), "Rows")
        for name, frame in report.items()
    ]
    return reduce(DataFrame.unionByName, sections)


@query
def muni_report_sections(i):
    return _sizes(i.report(muni_report, DAY))


@query
def corp_report_hy_sections(i):
    return _sizes(i.report(corp_report, "HY", DAY))


@query
def corp_report_ig_sections(i):
    return _sizes(i.report(corp_report, "IG", DAY))


@query
def corp_report_hy_winners(i):
    return i.report(corp_report, "HY", DAY)["winners"]


@query
def movers_report_sample(i):
    return i.report(movers_report, "HY", DAY)["sample"]


@query
def short_report_limits(i):
    """The short report with limits that cut; of the sampled rows those are counted that are listed losers."""
    report = i.report(partial(movers_report, movers=10, sample=5), "HY", DAY)
    listed = [report[n].select(F.lit(n).alias("Section"), "Ord", "SecurityId") for n in ("winners", "losers")]
    falling = report["losers"].select("SecurityId", F.lit(1).alias("_listed"))
    met = report["sample"].join(falling, "SecurityId", "left")
    sampled = met.agg(F.count("*").alias("Ord"), F.count("_listed").alias("SecurityId")).withColumn("Section", F.lit("sample"))
    return reduce(DataFrame.unionByName, [*listed, sampled])


@query
def archived_sectors(i):
    """Two sectors whose pivots have other days, published, archived and read back."""
    root = own_folder(i.spark, "archived")
    shown = {}
    for name in ("HY", "IG"):
        eod, _, info = i.sector(name)
        period = 2 if name == "HY" else 1
        prices = groups.avg_price_by_group(eod.where(F.col("Period") == period), info, CORP)
        shown[name] = by_date(prices, ["MoodysIndustry"], "AvgPrice")
        results.publish({"prices": shown[name]}, f"{root}/now", report_date=DAY, sector=name)
    archived = results.archive_run(i.spark, f"{root}/now", f"{root}/old", ["prices"], DAY)["prices"]
    days = [c for c in archived.columns if "/" in c]
    long = archived.unpivot(["sector", "MoodysIndustry"], days, "Day", "AvgPrice")
    own = {name: [c for c in frame.columns if "/" in c] for name, frame in shown.items()}
    return long.where(reduce(lambda a, b: a | b, [(F.col("sector") == n) & F.col("Day").isin(d) for n, d in own.items()]))
