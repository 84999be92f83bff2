"""Report input tables derived from the driver tables.

Events play the composites, customers the securities, nations the codes and curves,
orders the ratings and lineitems the quotes behind a composite. Every mapping takes
all rows of its table; ``oracle.py`` states the same mappings as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORT_DATE = "2024-01-26"

_MOMENT = (
    "date_trunc('day', ts) + case when k % 13 = 0 then interval '14:59' hour to minute "
    "else interval '15:00' hour to minute end"
)
_BID = "case when event_type = 'view' then null else value end"
_OFFER = "case when event_type = 'click' and k % 10 = 0 then null else value + k / 100D end"
_OG_BID = "case when k % 4 = 0 then cast(value - 0.25D as string) end"
_OG_OFFER = "case when k % 3 = 0 then cast(value + 0.5D as string) end"
_FLAGS = ["event_type <> 'signup' as IsSnap", "case when event_type = 'error' then 1 end as IsQuarantined"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k`` and ``moment``, which are reckoned once a row.

    As plain columns they would be put into every comparison of the snapshot's filter, two for each
    weekday of a report's window, and the JSON be parsed in each.
    """
    events = read(spark, sf_dir, "events").selectExpr(
        "*", "inline(array(named_struct('k', cast(get_json_object(props, '$.k') as int))))"
    )
    return events.selectExpr("*", f"inline(array(named_struct('moment', {_MOMENT})))")


def corp_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"""to_json(named_struct(
        'Counts', named_struct('All', named_struct('PVR', k, 'BID', k % 5, 'OFR', k % 7)),
        'OgBidCmp', {_OG_BID}, 'OgOfrCmp', {_OG_OFFER}))"""
    return _events(spark, sf_dir).selectExpr(
        "event_id as CorpCompositeId",
        "user_id as SecurityId",
        "moment as Date",
        f"{_BID} as BidComposite",
        f"{_OFFER} as OfferComposite",
        *_FLAGS,
        "ts as UpdatedDate",
        f"{text} as AdditionalData",
    )


def muni_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"""to_json(named_struct(
        'OgBdCmp', {_OG_BID}, 'OgOfCmp', {_OG_OFFER}, 'BdOfSprMsg', event_type,
        'OfWts', array(
            named_struct('AggId', event_id, 'Prv', event_type, 'QT', 'PRICE',
                         'VL', cast(value as string), 'PRC', cast(value as string),
                         'Wts', array(named_struct('Wt', cast(k % 5 as string)),
                                      named_struct('Wt', '0.5'))),
            named_struct('AggId', event_id + 1, 'Prv', event_type,
                         'QT', case when event_type = 'click' then 'SPREAD' else 'PRICE' end,
                         'VL', cast(value + 1D as string), 'PRC', cast(value as string),
                         'Wts', array(named_struct('Wt', cast(k % 7 as string)))))))"""
    return _events(spark, sf_dir).selectExpr(
        "event_id as MuniCompositeId",
        "user_id as SecurityId",
        "moment as Date",
        f"{_BID} as BidComposite",
        f"{_OFFER} as OfferComposite",
        "k as ProviderCount",
        "k % 5 as BidCount",
        "k % 7 as OfferCount",
        *_FLAGS,
        f"{text} as JsonDetail",
        "ts as UpdatedDate",
    )


def corp_composite_debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """to_json(named_struct('BdWts', array(named_struct(
        'AggId', l_partkey, 'Prv', cast(l_suppkey as string),
        'QT', case when l_returnflag = 'R' then 'SPREAD' else 'PRICE' end,
        'VL', cast(l_extendedprice as string), 'PRC', cast(l_extendedprice as string),
        'Wts', array(named_struct('Wt', cast(l_quantity as string)),
                     named_struct('Wt', cast(l_discount as string)))))))"""
    return read(spark, sf_dir, "lineitem").selectExpr("l_orderkey as CorpCompositeID", f"{text} as DebugData")


def security(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = read(spark, sf_dir, "customer")
    issued = """case when c_custkey % 2 = 0 then date_add(date '2023-01-01', cast(c_custkey % 300 as int))
                     when c_custkey % 3 = 0 then null
                     else date_add(date '2024-01-10', cast(c_custkey % 20 as int)) end"""
    ticker = "case when c_custkey % 9 <> 0 then concat('T', c_nationkey) end"
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey as SecurityId",
        "c_name as SecurityName",
        "cast(c_custkey as string) as PrimaryIdentifier",
        "'CORP' as SectorType",
        "concat(c_name, ' ', n_name) as MuniEmmaSecurityDesc",
        "case c_nationkey when 3 then '' when 4 then null else n_name end as MuniIssuerState",
        f"{ticker} as MuniIssuerTicker",
        f"{issued} as MuniDatedDate",
        "c_acctbal / 1000D as MuniCoupon",
        "date_add(date '2030-01-01', cast(c_custkey % 1000 as int)) as MuniMaturityDate",
        "n_name as MuniRatingFitchName",
        "c_mktsegment as MuniPurposeSectorName",
        f"{ticker} as CorpIssuerTicker",
        "case c_custkey % 4 when 0 then 'IG' when 1 then 'HY' when 2 then 'Finance' end as CorpIssuerSectorName",
        f"{issued} as CorpIssueDate",
        "case c_nationkey when 5 then null when 6 then '' else c_mktsegment end as CorpIssuerMoodysIndustryName",
    )


_TERMS = [
    "c_custkey as security_id",
    "case when c_custkey % 5 = 0 then c_acctbal / 1000D end as WAC",
    "c_acctbal / 500D as coupon",
    "case when c_custkey % 3 = 0 then 1.5D end as coupon_floor",
    "case when c_custkey % 7 <> 0 then c_acctbal / 20D end as floating_spread",
    "case when c_custkey % 4 <> 1 then c_nationkey end as floating_index",
    "date_add(date '2030-01-01', cast(c_custkey % 1000 as int)) as maturity_date",
]


def security_muni(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(*_TERMS)


def security_corp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(
        *_TERMS,
        "c_custkey as corp_issuer_id",
        "cast(c_custkey % 3 as int) as payment_rank",
        "case c_custkey % 11 when 0 then 1 when 1 then 0 end as is_conv",
    )


def code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as code_id",
        "n_name as code_title",
        "'rating_fitch' as code_group",
        "n_nationkey as print_order",
    )


def yield_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").selectExpr(
        "'CORP' as SectorType",
        "case when n_regionkey = 0 then 'Treasury' else 'FloatingIndex' end as CurveType",
        "n_nationkey as FloatingIndexId",
        "n_nationkey * 0.25D - 1D as CurveValue",
    )


def corp_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_custkey as CorpIssuerId",
        "case o_orderstatus when 'O' then 0 when 'F' then 1 else 2 end as PaymentRank",
        "cast(o_custkey % 22 as int) as SpRating",
        "cast((o_custkey + o_orderkey % 3) % 25 as int) as MoodysRating",
        "cast((o_custkey + o_orderkey % 5) % 25 as int) as FitchRating",
        "cast(case when o_orderkey % 2 = 1 then (o_custkey + 1) % 25 end as int) as OtherRating",
    )


def security_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        "user_id as SecurityId",
        "to_date(ts) as Date",
        "'CORP' as SectorType",
        "case when event_type = 'error' then 0 else 1 end as IsAggregate",
        "case when event_type = 'purchase' then 1L else 0L end as BidCountByMessage",
        "case when event_type = 'click' then 1L else 0L end as OfferCountByMessage",
    )


TABLES = {
    f.__name__: f
    for f in (
        muni_composite,
        corp_composite,
        corp_composite_debug,
        security,
        security_muni,
        security_corp,
        code,
        yield_curve,
        corp_rating,
        security_stats,
    )
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in TABLES.items()}
