"""Histogram sort: shards of nearly equal bytes, cut at exactly counted key boundaries.

Rows are staged with a number, and ordered by a 64-bit key whose upper 44 bits hash the text and whose lower
20 bits hash the identifier and the number: equal texts stand together, yet a text that fills a third of the table
can be cut, whether its rows share an identifier or not. Probes divide the key range; one pass counts the exact bytes below every probe;
the range around each splitter is divided again until the splitter meets its tolerance. Then
the rows are exchanged once.

Nulls: a null text has no bytes (size 1), a null identifier hashes like 0. Equal rows and ties
keep a slot each. An empty table gives no rows. Other columns travel along; the columns the
operator adds are replaced where a table has them already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondscope.llm.common import stage

LOW, HIGH = -(1 << 63), 1 << 63
PROBES = 4096


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 8,
    tolerance: float = 0.001,
    pieces: int | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Every row with ``size``, ``shard`` and a gapless ``slot`` within its shard.

    Shard boundaries lie within ``tolerance`` of a shard's bytes, or between two neighbouring keys.
    Each shard is sorted in ``pieces`` parts (by default all shards together have at least one for
    each shuffle partition), so no task holds a whole shard.
    """
    spark = docs.sparkSession
    pieces = pieces or -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")]
    order = _order_key(text, key, F.monotonically_increasing_id())
    # a table's own columns travel as one, so that their names meet none of those added here
    placed = stage(docs.select(F.struct(*own).alias("_doc"), size.alias("size"), order.alias("_order")))
    keys = placed.select("_order", "size")
    cuts = splitters(keys, shards * pieces, pieces, tolerance)
    counted = keys.groupBy(_place(F.col("_order"), cuts).alias("piece")).agg(F.count("*").alias("rows"))
    rows = dict(counted.collect())
    before, first = [], 0
    for piece in range(shards * pieces):
        first = 0 if piece % pieces == 0 else first
        before.append(first)
        first += rows.get(piece, 0)
    placed = placed.withColumn("_piece", _place(F.col("_order"), cuts))
    placed = placed.repartitionById(shards * pieces, F.col("_piece"))
    doc = F.col("_doc")
    within = Window.partitionBy("_piece").orderBy("_order", doc[key], F.xxhash64(F.lit("tie"), doc[text]))
    slot = F.element_at(_numbers(before), F.col("_piece") + 1) + F.row_number().over(within) - 1
    shard = F.floor(F.col("_piece") / pieces).cast("int")
    return placed.select("_doc", "size", shard.alias("shard"), slot.alias("slot")).select("_doc.*", "size", "shard", "slot")


def splitters(keys: DataFrame, parts: int, pieces: int, tolerance: float) -> list[int]:
    """The ``parts - 1`` keys that begin the parts; every ``pieces``-th one begins a shard."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    shard = total * pieces / parts
    aims = [total * n / parts for n in range(1, parts)]
    allowed = [tolerance * shard if n % pieces == 0 else 0.1 * total / parts for n in range(1, parts)]
    # lower, upper key of the range that holds the splitter, and the exact bytes below each
    ranges = [(LOW, HIGH, 0, total)] * (parts - 1)
    found: dict[int, int] = {}
    while len(found) < parts - 1:
        open_ranges = sorted({ranges[n] for n in range(parts - 1) if n not in found})
        width = max(16, PROBES // len(open_ranges))
        probes = sorted({low + (high - low) * i // width for low, high, *_ in open_ranges for i in range(width + 1)})
        inner = [p for p in probes if LOW < p < HIGH]
        counted = keys.groupBy(_place(F.col("_order"), inner).alias("cell")).agg(F.sum("size").alias("bytes"))
        cells = dict(counted.collect())
        below, held = {LOW: 0, HIGH: total}, 0
        for cell, probe in enumerate(inner):
            held += cells.get(cell, 0)
            below[probe] = held
        for n in range(parts - 1):
            if n in found:
                continue
            low, high, *_ = ranges[n]
            inside = [p for p in probes if low <= p <= high]
            upper = next(p for p in inside if below[p] >= aims[n] and p > low)
            lower = max(p for p in inside if p < upper)
            ranges[n] = (lower, upper, below[lower], below[upper])
            best = min((lower, upper), key=lambda p: abs(below[p] - aims[n]))
            if upper - lower <= 1 or abs(below[best] - aims[n]) <= allowed[n]:
                found[n] = min(max(best, LOW + 1), HIGH - 1)
    return sorted(found.values())


def _order_key(text: str, key: str, row: Column) -> Column:
    by_text = F.shiftleft(F.shiftright(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 20), 20)
    return by_text.bitwiseOR(F.xxhash64(F.coalesce(F.col(key).cast("long"), F.lit(0)), row).bitwiseAND(F.lit((1 << 20) - 1)))


def _numbers(values: list[int]) -> Column:
    """A constant array; the optimizer reads the text once."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _place(order: Column, cuts: list[int]) -> Column:
    """How many cuts are at or below the key, by binary search."""
    if not cuts:
        return F.lit(0)
    table = _numbers(cuts)
    steps = [1 << b for b in range(len(cuts).bit_length() - 1, -1, -1)]

    def step(at: Column, jump: Column) -> Column:
        to = at + jump
        fits = F.when(to <= len(cuts), F.element_at(table, to) <= order).otherwise(F.lit(False))
        return F.when(fits, to).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
