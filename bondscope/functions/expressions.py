"""Column expressions shared by the report operators."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.config import JsonField
from bondscope.functions.calendar import ReportWindow, ntz

# The text forms that count as numbers.
FLOAT_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"

# Display formats.
SHORT_DATE = "MM/dd/yy"
LONG_DATE = "MM/dd/yyyy"


# --- text to numbers -------------------------------------------------------


def try_float(text: Column) -> Column:
    """Text as a double; blank text is 0 and anything unreadable is NULL."""
    return F.when(text.rlike(FLOAT_TEXT), text.try_cast("double")).when(F.trim(text) == "", F.lit(0.0))


def try_decimal(text: Column, kind: str) -> Column:
    """Plain decimal text as ``kind``, rounded half up; blank, exponent and overflow are NULL."""
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast(kind))


def as_double(frame: DataFrame, name: str) -> Column:
    """Column ``name`` as a double, whether it is stored as text or as a number."""
    if isinstance(frame.schema[name].dataType, T.StringType):
        return try_float(F.col(name))
    return F.col(name).cast("double")


# --- JSON ------------------------------------------------------------------


def _json_schema(paths: Iterable[str]) -> T.StructType:
    children: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        children.setdefault(head, []).append(rest)
    return T.StructType(
        [
            T.StructField(head, _json_schema(rest) if all(rest) else T.StringType())
            for head, rest in children.items()
        ]
    )


def with_json_fields(frame: DataFrame, text: str, fields: Iterable[JsonField]) -> DataFrame:
    """Add typed scalars from the JSON in column ``text``.

    Missing paths, objects, arrays and broken JSON give NULL. The text is parsed into
    a struct by a step of its own: read inside every field expression it would be
    parsed again for each.
    """
    fields = list(fields)
    schema = _json_schema([f.path for f in fields])

    def typed(field: JsonField) -> Column:
        value = F.col(f"_json.{field.path}")
        if field.kind == "text":
            # an object or array comes as its text; a string that only looks like one stays
            part = F.try_variant_get(F.try_parse_json(F.col(text)), f"$.{field.path}", "variant")
            return F.when(~value.rlike(r"^[\[{]") | (F.schema_of_variant(part) == "STRING"), value)
        return try_float(value) if field.kind == "float" else try_decimal(value, field.kind)

    return (
        frame.withColumn("_json", F.from_json(text, schema))
        .withColumns({f.column: typed(f) for f in fields})
        .drop("_json")
    )


def quote_weights_schema(root: str) -> T.StructType:
    # Names in the JSON of quote weights.
    quote = T.StructType(
        [
            T.StructField("AggId", T.StringType()),
            T.StructField("Prv", T.StringType()),
            T.StructField("QT", T.StringType()),
            T.StructField("VL", T.StringType()),
            T.StructField("Wts", T.ArrayType(T.StructType([T.StructField("Wt", T.StringType())]))),
        ]
    )
    return T.StructType([T.StructField(root, T.ArrayType(quote))])


# --- predicates ------------------------------------------------------------


def is_set(frame: DataFrame, flag: str) -> Column:
    """A 0/1 or boolean flag that is on. Written so that it reaches the scan for either type."""
    boolean = isinstance(frame.schema[flag].dataType, T.BooleanType)
    return F.col(flag) == (F.lit(True) if boolean else F.lit(1))


def not_set(frame: DataFrame, flag: str) -> Column:
    """A 0/1 or boolean flag that is off or missing."""
    boolean = isinstance(frame.schema[flag].dataType, T.BooleanType)
    return F.col(flag).isNull() | (F.col(flag) == (F.lit(False) if boolean else F.lit(0)))


def on_weekday(moment: Column) -> Column:
    return ~F.dayofweek(moment).isin(1, 7)


def at_hour(moment: Column, hour: int) -> Column:
    """Exactly on the hour, to the second."""
    return (F.hour(moment) == hour) & (F.minute(moment) == 0) & (F.second(moment) == 0)


def at_hour_of(moment: Column, days: Iterable[date], hour: int) -> Column:
    """Exactly on the hour, to the second, of one of the days; as ranges, which reach the scan."""
    within = F.lit(False)
    for day in days:
        start = datetime.combine(day, time(hour))
        within = within | ((moment >= ntz(start)) & (moment < ntz(start + timedelta(seconds=1))))
    return within


def not_blank(text: Column) -> Column:
    """Neither NULL nor only blanks."""
    return F.rtrim(text) != ""


# --- report values ---------------------------------------------------------


def period_label(moment: Column, window: ReportWindow) -> Column:
    """1 in the report period, 2 in the previous one, 3 outside both."""
    return (
        F.when(moment.between(ntz(window.report_start), ntz(window.report_date)), 1)
        .when(moment.between(ntz(window.previous_start), ntz(window.previous_date)), 2)
        .otherwise(3)
    )


def short_name(state: Column, ticker: Column, coupon: Column, maturity: Column) -> Column:
    """State, ticker, coupon and maturity; a missing part leaves its separator."""

    def shown(part: Column) -> Column:
        return F.coalesce(part, F.lit(""))

    return F.concat(
        shown(state),
        F.lit(" "),
        shown(ticker),
        F.lit(" "),
        shown(coupon.try_cast("decimal(10,2)").cast("string")),
        F.lit(" "),
        shown(F.date_format(maturity, LONG_DATE)),
    )


def resolved_coupon(wac: Column, curve: Column, spread: Column, floor: Column, fixed: Column) -> Column:
    """Weighted average coupon, else floating rate kept at its floor (or 0), else fixed coupon."""
    floating = curve + spread / 100
    return (
        F.when(wac.isNotNull(), wac)
        .when(
            curve.isNotNull(),
            F.when(floor.isNotNull() & (floating < floor), floor)
            .when(floating < 0, F.lit(0.0))
            .otherwise(floating),
        )
        .otherwise(fixed)
    )


# Fixed value: the last rating order that is investment grade.
LAST_INVESTMENT_GRADE = 10


def derived_sector(rating: Column, order: Column, issuer_sector: Column) -> Column:
    """IG or HY from the rating, else the issuer's own sector, else HY."""
    return F.coalesce(
        F.when(rating.isNotNull(), F.when(order <= LAST_INVESTMENT_GRADE, "IG").otherwise("HY")).otherwise(
            issuer_sector
        ),
        F.lit("HY"),
    )


def change(now: Column, before: Column) -> Column:
    """Relative change; NULL where the base is 0."""
    return F.try_divide(now, before) - 1


def guarded_change(now: Column, before: Column, kind: str | None = None) -> Column:
    """Relative change of two positive prices, else NULL."""
    value = F.try_divide(now, before) - 1
    return F.when((now > 0) & (before > 0), value.cast(kind) if kind else value)


def decimal_ratio(part: Column, whole: Column) -> Column:
    """Quotient with ten decimals, cut and not rounded; NULL for a zero divisor.

    Whole units first, then ten decimals of what remains, so that no step rounds.
    """
    above = part.cast("decimal(28,10)")
    below = F.nullif(whole.cast("decimal(28,10)"), F.lit(0).cast("decimal(28,10)"))
    units = F.call_function("div", above, below)
    rest = ((above % below) * F.lit(10**10).cast("decimal(11,0)")).cast("decimal(38,10)")
    tenths = F.call_function("div", rest, below)
    # tenths / 10^10 as a decimal is exact: fewer than eleven digits
    return (units.cast("decimal(28,10)") + (tenths.cast("decimal(20,0)") * F.lit("0.0000000001").cast("decimal(10,10)"))).cast(
        "decimal(38,10)"
    )


def percent_increase(now: Column, before: Column) -> Column:
    """Relative increase as a decimal; 0 where the base is missing or not positive."""
    increase = decimal_ratio(now, before).cast("decimal(30,10)") - 1  # leaves room to keep ten decimals
    return F.when(F.coalesce(before, F.lit(0)) > 0, increase).otherwise(F.lit(0)).cast("decimal(38,10)")
