"""Observed prices: weighted averages of the quotes behind a composite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.config import ReportConfig
from bondscope.functions.expressions import quote_weights_schema, try_float
from bondscope.session import Staging


def mover_ids(*movers: DataFrame) -> DataFrame:
    """The distinct securities of several mover lists."""
    ids = movers[0].select("SecurityId")
    for more in movers[1:]:
        ids = ids.unionByName(more.select("SecurityId"))
    return ids.distinct()


def quotes_of(payload: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One row per quote weight in the JSON of ``payload``; other columns are kept.

    Rows with a missing, empty or broken array give nothing. Numbers that cannot be
    read are NULL.
    """
    root = F.from_json(cfg.weights_text, quote_weights_schema(cfg.weights_root)).getField(cfg.weights_root)
    kept = [c for c in payload.columns if c != cfg.weights_text]
    quotes = payload.select(*kept, F.inline(root))
    kind = F.rtrim("QT")  # trailing blanks do not count when text is compared
    kind = F.upper(kind) if cfg.fold_quote_type else kind
    return quotes.where(kind == cfg.quote_type).select(
        *kept,
        F.col("AggId").try_cast("long").alias("AggregateColorId"),
        F.col("Prv").alias("Provider"),
        F.col("QT").alias("QuoteType"),
        F.col("VL").alias("ValueText"),
        try_float(F.col("VL")).alias("Value"),
        F.inline("Wts"),
    ).withColumn("Weight", try_float(F.col("Wt"))).drop("Wt")


def quote_weights(quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of the weights of every quote."""
    return (
        quotes.groupBy(*keys, "AggregateColorId", "Provider", "QuoteType", "ValueText")
        .agg(F.first("Value").alias("Value"), F.sum("Weight").alias("SumWeights"))
        .drop("ValueText")
    )


def weighted_price(quotes: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Average of ``value`` by ``weight``; NULL where the weights add up to 0.

    Sums of sums are sums, so this takes single weights as well as weights added up
    per quote, and one shuffle does.
    """
    return quotes.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("WeightedPrice")
    )


#: Composites that are sent to every task at most, to be met by the payload where it is read: about 10 MB.
MET_IN_PLACE = 250_000


def payload_of(payload: DataFrame, cfg: ReportConfig, first: int | None, last: int | None) -> DataFrame:
    """The payload rows whose composite id lies in a range; none if it has no bounds.

    The range reaches the scan as a filter: ids grow with time, and the files of other years hold none of them.
    """
    return payload.select(cfg.weights_id, cfg.weights_text).where(
        F.col(cfg.weights_id).between(F.lit(first), F.lit(last))
    )


def wanted_composites(eod: DataFrame, securities: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The composites of the two periods for the given securities."""
    rows = eod.where("Period <= 2").join(securities.select("SecurityId").distinct(), "SecurityId", "left_semi")
    return rows.select(cfg.id_column, "SecurityId", "Date", "Period")


def payload_quotes(
    staging: Staging, eod: DataFrame, securities: DataFrame, cfg: ReportConfig, payload: DataFrame
) -> DataFrame:
    """Quote weights of the two periods for the given securities, from a payload table.

    The wanted composites are few beside a snapshot. They are staged, and the same job counts them and finds their id
    range, which becomes a filter of the payload's scan. Up to ``MET_IN_PLACE`` of them are sent to the tasks that read
    the payload, so its text is not exchanged; beyond that Spark joins by its own sizes.
    """
    name = f"wanted_{len(staging.tables)}"
    id_ = F.col(cfg.id_column)
    wanted, told = staging.measured(
        wanted_composites(eod, securities, cfg), name, rows=F.count("*"), first=F.min(id_), last=F.max(id_)
    )
    text = payload_of(payload, cfg, told["first"], told["last"]).withColumnRenamed(cfg.weights_id, "_composite")
    few = F.broadcast(wanted) if told["rows"] <= MET_IN_PLACE else wanted
    return quotes_of(text.join(few, F.col("_composite") == F.col(cfg.id_column)).drop("_composite"), cfg)


def quoted_rows(
    eod: DataFrame, securities: DataFrame, cfg: ReportConfig, payload: DataFrame | None = None
) -> DataFrame:
    """Quote weights of the two periods for the given securities.

    ``payload`` holds the composite id and the JSON text; without it the text is taken
    from the snapshot. Spark joins the snapshot rows to the payload by their sizes.
    """
    if payload is None:
        rows = eod.where("Period <= 2").join(securities.select("SecurityId").distinct(), "SecurityId", "left_semi")
        return quotes_of(rows.select(cfg.id_column, "SecurityId", "Date", "Period", cfg.weights_text), cfg)
    text = payload.select(F.col(cfg.weights_id).alias("_composite"), cfg.weights_text)
    wanted = wanted_composites(eod, securities, cfg)
    return quotes_of(text.join(wanted, F.col("_composite") == F.col(cfg.id_column)).drop("_composite"), cfg)


def staged_prices(
    staging: Staging, eod: DataFrame, securities: DataFrame, cfg: ReportConfig, payload: DataFrame
) -> DataFrame:
    """Weighted observed price by security, date and period, with the payload met where it is read."""
    quotes = payload_quotes(staging, eod, securities, cfg, payload)
    return weighted_price(quotes, ["SecurityId", "Date", "Period"], "Value", "Weight")


def observed_prices(
    eod: DataFrame, securities: DataFrame, cfg: ReportConfig, payload: DataFrame | None = None
) -> DataFrame:
    """Weighted observed price by security, date and period; arguments as in ``quoted_rows``."""
    quotes = quoted_rows(eod, securities, cfg, payload)
    return weighted_price(quotes, ["SecurityId", "Date", "Period"], "Value", "Weight")
