"""Input tables: their schemas and the ways to read them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.functions.calendar import ReportWindow, ntz


# The columns the reports read, as DDL.
SCHEMAS: dict[str, str] = {
    "muni_composite": (
        "MuniCompositeId long, SecurityId long, Date timestamp_ntz, BidComposite double, "
        "OfferComposite double, ProviderCount int, BidCount int, OfferCount int, IsSnap boolean, "
        "IsQuarantined boolean, JsonDetail string, UpdatedDate timestamp_ntz"
    ),
    "corp_composite": (
        "CorpCompositeId long, SecurityId long, Date timestamp_ntz, BidComposite decimal(12,5), "
        "OfferComposite decimal(12,5), IsSnap boolean, IsQuarantined boolean, "
        "UpdatedDate timestamp_ntz, AdditionalData string"
    ),
    "corp_composite_debug": "CorpCompositeID long, DebugData string",
    "security": (
        "SecurityId long, SecurityName string, PrimaryIdentifier string, SectorType string, "
        "MuniEmmaSecurityDesc string, MuniIssuerState string, MuniIssuerTicker string, "
        "MuniDatedDate date, MuniCoupon double, MuniMaturityDate date, MuniRatingFitchName string, "
        "MuniPurposeSectorName string, CorpIssuerTicker string, CorpIssuerSectorName string, "
        "CorpIssueDate date, CorpIssuerMoodysIndustryName string"
    ),
    "security_muni": (
        "security_id long, WAC double, coupon double, coupon_floor double, floating_spread double, "
        "floating_index int, maturity_date date"
    ),
    "security_corp": (
        "security_id long, WAC double, coupon double, coupon_floor double, floating_spread double, "
        "floating_index int, maturity_date date, corp_issuer_id long, payment_rank int, is_conv boolean"
    ),
    "code": "code_id int, code_title string, code_group string, print_order int",
    "yield_curve": "SectorType string, CurveType string, FloatingIndexId int, CurveValue double",
    "corp_rating": (
        "CorpIssuerId long, PaymentRank int, SpRating int, MoodysRating int, FitchRating int, OtherRating int"
    ),
    "security_stats": (
        "SecurityId long, Date date, SectorType string, IsAggregate int, BidCountByMessage long, "
        "OfferCountByMessage long"
    ),
}

MUNI_TABLES = ("muni_composite", "security", "security_muni", "code", "yield_curve")
CORP_TABLES = (
    "corp_composite",
    "corp_composite_debug",
    "security",
    "security_corp",
    "code",
    "yield_curve",
    "corp_rating",
    "security_stats",
)


def columns_of(name: str) -> list[str]:
    """The columns of an input table, in order."""
    if name not in SCHEMAS:
        raise ValueError(f"unknown table {name!r}; known: {sorted(SCHEMAS)}")
    return [column.split(" ")[0] for column in SCHEMAS[name].split(", ")]


def load(spark: SparkSession, name: str, root: str | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """Input table ``name``: parquet below ``root``, or the catalog table or view of that name.

    Only the columns the reports read come back, in the types of ``SCHEMAS``, and those in ``keep`` (a column the
    table is stored by, for one) as they are. A missing column and a type that would lose values raise ValueError.
    """
    wanted, kept = columns_of(name), list(keep)
    frame = spark.read.parquet(f"{root.rstrip('/')}/{name}") if root else spark.table(name)
    missing = [c for c in [*wanted, *kept] if c not in frame.columns]
    if missing:
        raise ValueError(f"table {name!r} lacks {missing}")
    found, known = {f.name: f.dataType for f in frame.schema.fields}, T.StructType.fromDDL(SCHEMAS[name])
    return frame.select(*[reconciled(name, f.name, found[f.name], f.dataType).alias(f.name) for f in known.fields], *kept)


#: Whole-number types and how many decimal digits each can have.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def reconciled(table: str, name: str, found: T.DataType, wanted: T.DataType) -> Column:
    """A column in the wanted type, if no value of its own type is lost.

    Whole numbers and decimals become wider ones, whole numbers up to 32 bits and floats become doubles, flags become
    0 and 1 and back, and times with a zone are taken in UTC, whatever the session's zone. Text stays text.
    """
    column, kind = F.col(f"`{name}`"), type(found)
    if found == wanted:
        return column
    fits = False
    if isinstance(wanted, T.DecimalType):
        digits = DIGITS.get(kind, found.precision - found.scale if kind is T.DecimalType else 99)
        fits = digits <= wanted.precision - wanted.scale and (kind is not T.DecimalType or found.scale <= wanted.scale)
    elif type(wanted) in DIGITS:
        narrower = kind in DIGITS and DIGITS[kind] <= DIGITS[type(wanted)]
        whole = kind is T.DecimalType and found.scale == 0 and found.precision < DIGITS[type(wanted)]
        fits = narrower or whole or kind is T.BooleanType
    elif isinstance(wanted, T.DoubleType):
        fits = kind is T.FloatType or DIGITS.get(kind, 99) <= 10
    elif isinstance(wanted, T.BooleanType):
        fits = kind in DIGITS
    elif isinstance(wanted, T.TimestampNTZType) and kind is T.TimestampType:
        micros = f"CAST(unix_micros(`{name}`) AS DECIMAL(20, 0))"
        return F.expr(f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST({micros} / 1000000 AS DECIMAL(18, 6)))")
    elif isinstance(wanted, T.StringType):
        fits = kind in (T.VarcharType, T.CharType, T.StringType)
    if not fits:
        raise ValueError(f"column {name!r} of table {table!r} is {found.simpleString()}, not {wanted.simpleString()}")
    return column.cast(wanted)


def load_tables(spark: SparkSession, names: Iterable[str], root: str | None = None) -> dict[str, DataFrame]:
    return {name: load(spark, name, root) for name in names}


def literal_table(spark: SparkSession, rows: Sequence, schema: str) -> DataFrame:
    """A small table from rows in the program."""
    return spark.createDataFrame(rows, schema)


def report_dates(spark: SparkSession, window: ReportWindow) -> DataFrame:
    """One row: the report date and the date it is compared with."""
    return spark.range(1).select(
        ntz(window.report_date).alias("ReportDate"),
        ntz(window.previous_date).alias("PreviousReportDate"),
    )


def jdbc_options(
    url: str,
    source: str,
    *,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    driver: str | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a database read. ``source`` is a table name or a SELECT.

    With a partition column the read is split into ``partitions`` range queries, so
    no single task holds the table; the bounds only place the splits and drop no rows.
    """
    query = source.strip().lower().startswith(("select ", "select\n", "with "))
    options = {
        "url": url,
        "dbtable": f"({source}) source" if query else source,
        "fetchsize": str(fetch_size),
        **({"driver": driver} if driver else {}),
        **(properties or {}),
    }
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("partition_column, lower, upper and partitions go together")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def load_jdbc(spark: SparkSession, url: str, source: str, **options) -> DataFrame:
    """A table or query of an external database; options as in ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, source, **options)).load()


def preview(frame: DataFrame, rows: int = 20) -> None:
    """Print the first rows without reading the rest."""
    frame.show(rows, truncate=False)


def sample_rows(frame: DataFrame, rows: int = 500) -> DataFrame:
    """Any ``rows`` rows, in no order."""
    return frame.limit(rows)


def to_long(frame: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per id and value column, as ``name`` and ``value``."""
    return frame.unpivot([F.col(c) for c in ids], [F.col(c) for c in values], "name", "value")
