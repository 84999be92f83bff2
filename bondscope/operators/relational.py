"""Relational building blocks the report operators are made of."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.functions.calendar import ReportWindow
from bondscope.functions.expressions import SHORT_DATE
from bondscope.session import shuffle_partitions


def latest_per(frame: DataFrame, keys: Sequence[Column | str], newest_by: Column | str) -> DataFrame:
    """The row with the highest ``newest_by`` of every key.

    The filter on the rank lets Spark keep one row per key and task before the
    shuffle, so a key with very many rows does not travel whole.
    """
    ranked = Window.partitionBy(*keys).orderBy(F.desc(newest_by))
    return frame.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def place_by(frame: DataFrame, key: str) -> DataFrame:
    """Partition by ``key``, so that later joins and groups by it need no shuffle.

    Spark's adaptive execution may merge small partitions.
    """
    return frame.repartition(key)


def lookup_join(frame: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Left join to a lookup with few rows per key.

    Spark broadcasts the lookup if its size allows, else both sides are shuffled and adaptive
    execution splits hot keys. Rows with a NULL key match nothing and would all meet in one task, so they go
    round the join. ``on`` pairs column names of the frame and the lookup; the lookup's key columns are
    dropped.
    """
    taken = {right: f"_{right}_key" for _, right in on}
    values = [c for c in lookup.columns if c not in taken]
    keyed = lookup.select(*[F.col(right).alias(name) for right, name in taken.items()], *values)
    condition, whole = F.lit(True), F.lit(True)
    for left, right in on:
        condition = condition & (F.col(left) == F.col(taken[right]))
        whole = whole & F.col(left).isNotNull()
    matched = frame.where(whole).join(keyed, condition, "left").drop(*taken.values())
    kinds = {f.name: f.dataType for f in lookup.schema.fields}
    others = frame.where(~whole).withColumns({c: F.lit(None).cast(kinds[c]) for c in values})
    return matched.unionByName(others)


def assert_unique(lookup: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The lookup, with a check at run time that no key repeats; a repeated one fails the query.

    NULL keys match nothing and may repeat.
    """
    some = " and ".join(f"`{k}` is not null" for k in keys)
    rows = F.count("*").over(Window.partitionBy(*keys))
    checked = lookup.where(some).withColumn("_rows", rows)
    fails = F.raise_error(F.concat(F.lit(f"repeated {what}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    return checked.where(F.when(F.col("_rows") > 1, fails.cast("boolean")).otherwise(F.lit(True))).drop("_rows")


def top_ranked(frame: DataFrame, order: Sequence[Column], rows: int, rank: str) -> DataFrame:
    """The first ``rows`` rows in ``order``, numbered from 1.

    The limit comes before the numbering: every task keeps its own first rows and
    only those meet in the one partition that numbers them.
    """
    first = frame.orderBy(*order).limit(rows)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def detail_and_total(
    frame: DataFrame, group: str, totals: dict[str, Column], measures: dict[str, Column], total_label: str
) -> DataFrame:
    """Measures by date and group (Ord 1) and by date (Ord 0).

    ``totals`` are sums and counts of rows, taken once by date and group; that small result is rolled
    up, and ``measures`` are built from the totals. The total row is told by ``grouping``, since the
    group itself may be NULL.
    """
    small = frame.groupBy("Date", group).agg(*[value.alias(name) for name, value in totals.items()])
    rolled = small.groupingSets([["Date", group], ["Date"]], "Date", group).agg(
        *[F.sum(name).alias(name) for name in totals], F.grouping(group).alias("_total")
    )
    return rolled.select(
        F.when(F.col("_total") == 1, F.lit(total_label)).otherwise(F.col(group)).alias(group),
        "Date",
        *[value.alias(name) for name, value in measures.items()],
        (F.lit(1) - F.col("_total")).cast("int").alias("Ord"),
    )


def pivot_dates(frame: DataFrame, window: ReportWindow, column: str = "Date") -> list[date]:
    """The weekdays of a report's window that a frame has rows of, in order, to name pivot columns by."""
    return window_days(window, frame.agg(days_present(window, column)).first()[0])


def days_present(window: ReportWindow, column: str = "Date") -> Column:
    """The weekdays of the window in a column: a measure that can be taken while a frame is written."""
    moment = F.to_date(column)
    return F.collect_set(F.when(moment.isin(window.weekdays()), moment))  # days of the window at most


def window_days(window: ReportWindow, present: Iterable[date]) -> list[date]:
    """The days present, in order."""
    found = set(present)
    return [day for day in window.weekdays() if day in found]


def short_dates(days: Sequence[date]) -> list[str]:
    return [day.strftime("%m/%d/%y") for day in days]


def pivot_by_date(frame: DataFrame, keys: Sequence[str], value: str, days: Sequence[date]) -> DataFrame:
    """One column per day holding the largest ``value``; total rows first.

    Groups by ``keys`` and ``Ord``. No days give the key columns alone.
    """
    labels = short_dates(days)
    ordered = [F.asc("Ord"), *[F.asc(k) for k in keys]]
    groups = frame.groupBy("Ord", *keys)
    if labels:
        labelled = frame.withColumn("_day", F.date_format("Date", SHORT_DATE))
        table = labelled.groupBy("Ord", *keys).pivot("_day", labels).agg(F.max(value))
    else:
        table = groups.agg(F.count("*").alias("_rows"))
    return table.orderBy(*ordered).select(*keys, *[F.col(f"`{label}`") for label in labels])


def running_max(
    frame: DataFrame,
    value: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
    start: float = -1,
    name: str = "RunningMax",
) -> DataFrame:
    """Largest value so far in ``order``, per key or over all rows, never below ``start``.

    The order is cut into ranges of about equal rows, by a sample of it. Ranges are scanned side by
    side, and each starts from the largest value of the ranges before it, so no task holds a whole key
    or a whole hour. Rows that tie in ``order`` follow a hash of all their columns (but maps), so that a cut
    can fall between them too; only rows that are equal throughout stay together.
    """
    hashed = [f"`{f.name}`" for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]
    placed = frame.withColumn("_tie", F.xxhash64(*hashed))
    order = [*order, "_tie"]
    place = F.struct(*order)
    places = placed.select(place.alias("_place"))
    cuts = _range_cuts(places, shuffle_partitions(frame.sparkSession))
    kind = places.schema["_place"].dataType
    # A struct is never NULL, so rows with NULL keys meet their range like all others.
    blocked = placed.withColumn("_block", F.struct(*keys, _cuts_below(cuts, place, kind).alias("_at")))
    peaks = blocked.groupBy("_block").agg(F.max(value).alias("_peak"))
    earlier = Window.partitionBy(*[F.col(f"_block.{k}") for k in keys]).orderBy("_block._at")
    carried = peaks.select(
        "_block", F.max("_peak").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried")
    )
    within = Window.partitionBy("_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blocked.withColumn("_local", F.max(value).over(within))
    return local.join(carried, "_block").select(
        *frame.columns, F.greatest(F.lit(start), F.col("_carried"), F.col("_local")).alias(name)
    )


SAMPLED_PLACES = 50


def _range_cuts(places: DataFrame, ranges: int) -> list[Row]:
    """Places, as text, that cut the order into ranges of about equal rows, from a sample of bounded size.

    One pass: every task keeps the rows of its smallest random numbers, and the smallest of those are the sample.
    """
    lots = places.withColumn("_lot", F.rand(1)).orderBy("_lot").limit(ranges * SAMPLED_PLACES)
    shown = F.struct(*[F.col(f"_place.{f}").cast("string").alias(f) for f in places.schema["_place"].dataType.names])
    ranked = [row[0] for row in lots.orderBy("_place").select(shown).collect()]
    picked = [ranked[len(ranked) * n // ranges] for n in range(1, ranges)] if ranked else []
    return [place for n, place in enumerate(picked) if n == 0 or place != picked[n - 1]]


def _cuts_below(cuts: list[Row], place: Column, kind: T.DataType) -> Column:
    """How many cuts are at or below a place, by halving a constant array."""
    if not cuts:
        return F.lit(0)
    text = [F.struct(*[F.lit(v).alias(n) for n, v in cut.asDict().items()]) for cut in cuts]
    table = F.array(*text).cast(T.ArrayType(kind))
    steps = F.array(*[F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1)])

    def step(at: Column, jump: Column) -> Column:
        to = at + jump
        return F.when(F.when(to <= len(cuts), F.element_at(table, to) <= place).otherwise(False), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)
