"""Repeated strings across documents, by bucket-pointer refinement of a sparse suffix array.

A string of ``WINDOW`` bytes is removed wherever it also starts earlier. Its occurrences are the suffixes that agree
in so many bytes, and they are found by refining buckets. Bucket identifiers are built by doubling: the identifier
of a q-gram of twice the length comes from those at its begin and at the offset behind its first half.

1. Each window of a text is represented by one of its 32-byte q-grams, the one of the smallest identifier, so equal
   windows have equal representatives at equal offsets, and neighbouring windows that share a representative are one row, a
   run. Initial buckets hold the runs of one q-gram. They are sorted by the identifiers of later (and earlier) offsets, which
   cover all that the run's windows cover: equal runs stand together, all but the first are repeats. A bucket that
   holds one kind of run only is settled.
2. What is left in buckets with several kinds is cut into blocks of eight windows, bucketed by the 93 bytes that all windows of a
   block share, and refined in the same way.
3. What is still left are the windows at both ends of repeats; they are bucketed by their 100 bytes, and that settles them.

Only the first of equal runs goes from one round to the next, so copies are met once. A round is one range-partitioned
sort whose key ends with the row's place, so a bucket of any size is cut over tasks; a bucket that touches the border of a
task goes on to the next round. Texts are kept as a table bucketed by row, and every round joins them without an exchange.

Identifiers have 64 bits and are compared together with those of the bucket: a false repeat needs two different runs of one
bucket with equal identifiers, a chance of about 2^-64 for each such pair.

Nulls: a null or empty text has no bytes and keeps none; a null identifier comes before all others. Rows of equal identifiers are
ordered by their place in the table, so of repeated rows the first stays. Texts shorter than a window are kept whole, long
ones are read in parts. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import map_batches, slices, stage
from bondscope.session import Staging, shuffle_partitions

WINDOW, GRAM, BLOCK = 100, 32, 8
#: Window starts handled at once.
CHUNK = 1 << 17
INDEX = np.uint64((1 << 18) - 1)
SAMPLED_KEYS_A_RANGE = 200
SLICE = 2 << 20
FIRST = -(1 << 63)
REPEAT, OPEN = 1, 2

#: ``_at`` tells the first window's start, the smallest distance of a window to the representative, and how many
#: windows follow the first: p << 14 | nearest << 7 | more.
RUN = "_bucket long, _kind long, _id long, _row long, _at long"
TOLD = "_told int, _id long, _row long, _at long"
PIECES = "n_bytes long, spans array<struct<start: long, length: long>>, kept binary"

_LETTERS = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_ONE, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def cut_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, ``n_bytes``, the removed ``spans`` (longest runs) and the bytes ``kept``."""
    spark = docs.sparkSession
    staging = Staging(spark)
    named = F.coalesce(F.col(key).cast("long"), F.lit(FIRST))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        named.alias("_id"),
        F.col(key).cast("long").alias("_key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    )
    texts = staging.table(rows.repartition(shuffle_partitions(spark), "_row"), "texts", "_row")
    settled = [refined(initial_buckets(texts.select("_row", "_id", "_text")))]
    blocks = stage(_in_texts(texts, settled[0], _blocks))
    order = ["_bucket", "_kind", "_id", "_row", "_at"]
    settled.append(refined(blocks.repartitionByRange(*order)))
    settled.append(equal_windows(stage(_in_texts(texts, settled[1], _windows))))
    found = [s.where(F.col("_told") == REPEAT).select("_row", "_at") for s in settled]
    repeats = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("_row").agg(F.collect_list("_at").alias("_ats"))
    whole = texts.join(repeats.withColumnRenamed("_row", "_of"), F.col("_row") == F.col("_of"), "left")
    return map_batches(whole.select("_key", "_text", "_ats"), _cut(key), f"{key} long, {PIECES}", "_text", SLICE)


def identifiers(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket identifiers of all q-grams of 32 and of 64 bytes of a string, by doubling."""
    held, short = _LETTERS[letters], None
    for width in (1, 2, 4, 8, 16, 32):
        short = held if width == GRAM else short
        held = _joined(held[:-width], held[width:])
    return short, held


def _joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The identifier of two neighbouring strings."""
    out = one * _ONE
    out += other
    out ^= out >> np.uint64(32)
    out *= _OTHER
    return out


def _covering(long: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Identifiers of strings of 64 to 192 bytes: those of the q-grams at their begin, middle and end, and the length."""
    rest = lengths - 64
    whole = _joined(_joined(long[starts], long[starts + rest // 2]), long[starts + rest])
    return _joined(whole, lengths.astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


class Letters:
    """The bytes of a batch of texts one after the other, and where each text begins."""

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]

    def chunks(self, beyond: int) -> Iterator[tuple[int, np.ndarray]]:
        """Where each chunk of window starts begins, and its bytes with ``beyond`` more."""
        for start in range(0, len(self.data), CHUNK):
            part = self.data[start : start + CHUNK + beyond]
            if len(part) >= WINDOW:
                yield start, part

    def windows(self, start: int, many: int) -> np.ndarray:
        """Which of the next ``many`` window starts lie in one text with their whole window."""
        first = np.searchsorted(self.bounds, start, side="right") - 1
        last = np.searchsorted(self.bounds, start + many, side="left")
        begins = np.maximum(self.bounds[first:last] - start, 0)
        ends = np.minimum(self.bounds[first + 1 : last + 1] - WINDOW + 1 - start, many)
        real = begins < ends
        steps = np.zeros(many + 1, np.int8)
        np.add.at(steps, begins[real], 1)
        np.add.at(steps, ends[real], -1)
        return np.flatnonzero(np.cumsum(steps[:-1], dtype=np.int8))

    def owners(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right") - 1


def runs(letters: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows that share a representative: bucket, kind, text and ``_at`` of each."""
    parts = []
    for start, part in letters.chunks(WINDOW - 1):
        short, long = identifiers(part)
        many = min(len(part) - WINDOW + 1, CHUNK)
        marked = (short & ~INDEX) | np.arange(len(short), dtype=np.uint64)
        chosen = (_least(marked, WINDOW - GRAM + 1)[:many] & INDEX).astype(np.int64)
        at = letters.windows(start, many)
        if not len(at):
            continue
        anchor = chosen[at]
        begins = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        more = np.diff(np.append(begins, len(at))) - 1
        first, anchor = at[begins], anchor[begins]
        nearest = anchor - first - more
        kind = _joined(_covering(long, first, more + WINDOW), nearest.astype(np.uint64))
        parts.append((short[anchor], kind, letters.owners(start + first), start + first, nearest, more))
    return _told_runs(letters, parts)


def _told_runs(letters: Letters, parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if not parts:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    bucket, kind, owner, first, nearest, more = (np.concatenate(c) for c in zip(*parts, strict=True))
    at = (first - letters.bounds[owner]) << 14 | nearest << 7 | more
    return bucket.view(np.int64), kind.view(np.int64), owner, at


def initial_buckets(texts: DataFrame) -> DataFrame:
    """All runs of all texts, dealt to tasks by ranges of their buckets; a hot bucket is dealt to several."""
    ranges = shuffle_partitions(texts.sparkSession)
    total = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    wanted = min(1.0, ranges * SAMPLED_KEYS_A_RANGE * (WINDOW - GRAM) / 2 / max(total, 1))
    of_texts = min(1.0, 50 * wanted)
    sampled = texts.where(F.pmod(F.xxhash64("_row"), F.lit(1 << 30)) < int(of_texts * (1 << 30)))
    every = max(1, round(of_texts / wanted))

    def sample(batch: pa.RecordBatch) -> pa.RecordBatch:
        bucket, kind, owner, at = runs(Letters(batch.column("_text")))
        chance = _joined(kind.view(np.uint64), owner.astype(np.uint64) + at.astype(np.uint64)) % np.uint64(every) == 0
        return pa.RecordBatch.from_arrays([pa.array(bucket[chance])], names=["_bucket"])

    keys = np.sort(map_batches(sampled, sample, "_bucket long", "_text", SLICE).toArrow().column(0).to_numpy())
    splitters = keys[(np.arange(1, ranges) * len(keys)) // ranges] if len(keys) else keys

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        bucket, kind, owner, at = runs(Letters(batch.column("_text")))
        low, high = np.searchsorted(splitters, bucket, "left"), np.searchsorted(splitters, bucket, "right")
        rows = batch.column("_row").to_numpy()[owner]
        salt = _joined(rows.astype(np.uint64), at.astype(np.uint64)) >> np.uint64(33)
        place = (low + salt.astype(np.int64) % (high - low + 1)).astype(np.int32)
        arrays = [bucket, kind, batch.column("_id").to_numpy()[owner], rows, at, place]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=[*_names(RUN), "_range"])

    dealt = map_batches(texts, deal, f"{RUN}, _range int", "_text", SLICE)
    return dealt.repartitionById(ranges, F.col("_range")).drop("_range")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def refined(dealt: DataFrame) -> DataFrame:
    """Rows of ``RUN`` sorted within their tasks: ``REPEAT`` for all but the first of a kind, ``OPEN`` for first ones of
    buckets with several kinds or at a task's border; first ones of settled buckets are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter = Refinement()
        for batch in batches:
            if batch.num_rows:
                yield sorter.add(*(batch.column(c).to_numpy() for c in _names(RUN)))
        yield sorter.finish()

    return stage(dealt.sortWithinPartitions(*_names(RUN)).mapInArrow(work, TOLD))


class Refinement:
    """Reads the sorted rows of a task and tells repeats and open rows; holds one row back."""

    def __init__(self) -> None:
        self.last: tuple[int, int] | None = None
        self.kinds = 0
        self.edge = True
        self.pending: np.ndarray | None = None

    def add(self, bucket: np.ndarray, kind: np.ndarray, *places: np.ndarray) -> pa.RecordBatch:
        rows = np.column_stack(places)
        new_bucket = np.append(self.last is None or bucket[0] != self.last[0], bucket[1:] != bucket[:-1])
        new_kind = new_bucket | np.append(self.last is None or kind[0] != self.last[1], kind[1:] != kind[:-1])
        first_ever = self.last is None
        # bucket 0 is the one that goes on from the rows before
        number = np.cumsum(new_bucket)
        kinds = np.bincount(number, new_kind, minlength=number[-1] + 1).astype(np.int64)
        kinds[0] += self.kinds
        several = kinds > 1
        several[0] |= self.edge
        if first_ever:
            several[1] = True
        if self.pending is not None and several[0]:
            opened = self.pending
        else:
            opened = np.zeros((0, 3), np.int64)
        told = [rows[~new_kind], opened, rows[new_kind & several[number]]]
        last = number[-1]
        if several[last]:
            self.pending = None
        elif last > 0:
            self.pending = rows[np.flatnonzero(new_kind)[-1:]]
        self.edge = bool(first_ever and last == 1) or bool(self.edge and last == 0)
        self.kinds = int(kinds[last])
        self.last = (int(bucket[-1]), int(kind[-1]))
        return _told(told)

    def finish(self) -> pa.RecordBatch:
        """The bucket at the end touches the task's border."""
        return _told([np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64) if self.pending is None else self.pending])


def _told(parts: list[np.ndarray]) -> pa.RecordBatch:
    """Repeats are in the first part."""
    rows = np.concatenate(parts)
    mark = np.where(np.arange(len(rows)) < len(parts[0]), REPEAT, OPEN).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(mark), *(pa.array(rows[:, c]) for c in range(3))], names=_names(TOLD))


def _in_texts(texts: DataFrame, told: DataFrame, work) -> DataFrame:
    """Finer runs of the open ones, made from their texts by ``work``; a text's open runs are one list."""
    listed = told.where(F.col("_told") == OPEN).groupBy(F.col("_row").alias("_of")).agg(F.collect_list("_at").alias("_ats"))
    met = texts.join(listed, F.col("_row") == F.col("_of")).select("_row", "_id", "_text", "_ats")

    def finer(batch: pa.RecordBatch) -> pa.RecordBatch:
        letters, lists = Letters(batch.column("_text")), batch.column("_ats")
        ats = pc.list_flatten(lists).to_numpy()
        owner = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        first = letters.bounds[owner] + (ats >> 14)
        order = np.argsort(first, kind="stable")
        first, nearest, more = first[order], (ats[order] >> 7) & 127, ats[order] & 127
        parts = []
        for start, part in letters.chunks(2 * WINDOW):
            low, high = np.searchsorted(first, [start, start + CHUNK])
            if low < high:
                _, long = identifiers(part)
                bucket, kind, places, near, wide = work(long, first[low:high] - start, nearest[low:high], more[low:high])
                parts.append((bucket, kind, letters.owners(places + start), places + start, near, wide))
        bucket, kind, of, at = _told_runs(letters, parts)
        arrays = [bucket, kind, batch.column("_id").to_numpy()[of], batch.column("_row").to_numpy()[of], at]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=_names(RUN))

    return map_batches(met, finer, RUN, "_text", SLICE)


def _blocks(long: np.ndarray, first: np.ndarray, nearest: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs cut where the distance to the representative is a multiple of the block: bucketed by what all windows of a block share."""
    anchor, furthest = first + nearest + more, nearest + more
    many = furthest // BLOCK - nearest // BLOCK + 1
    of = np.repeat(np.arange(len(first)), many)
    number = (nearest // BLOCK)[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    near, far = np.maximum(nearest[of], BLOCK * number), np.minimum(furthest[of], BLOCK * number + BLOCK - 1)
    starts, wide = anchor[of] - far, far - near
    shared = _covering(long, anchor[of] - BLOCK * number, np.full(len(of), WINDOW - BLOCK + 1))
    bucket = _joined(shared, number.astype(np.uint64))
    kind = _joined(_covering(long, starts, wide + WINDOW), near.astype(np.uint64))
    return bucket, kind, starts, near, wide


def _windows(long: np.ndarray, first: np.ndarray, nearest: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Single windows with two identifiers that together cover them."""
    of = np.repeat(np.arange(len(first)), more + 1)
    starts = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    none = np.zeros(len(of), np.int64)
    return long[starts], long[starts + WINDOW - 64], starts, none, none


def equal_windows(windows: DataFrame) -> DataFrame:
    """``REPEAT`` for every window but the first of equal ones."""
    place = F.struct("_id", "_row", "_at")
    firsts = windows.groupBy("_bucket", "_kind").agg(F.min(place).alias("_first"), F.count("*").alias("_many"))
    firsts = firsts.where("_many > 1").drop("_many")
    met = windows.join(firsts, ["_bucket", "_kind"]).where(place > F.col("_first"))
    return stage(met.select(F.lit(REPEAT).alias("_told"), "_id", "_row", "_at"))


def _cut(key: str):
    """Work on a batch: texts without the bytes that their repeated windows cover."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = batch.column("_text").cast(pa.binary()).to_pylist()
        lists, spans, kept = batch.column("_ats"), [], []
        bounds = lists.offsets.to_numpy()
        ats, real = lists.values.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
        for n, body in enumerate(bodies):
            if not real[n]:
                spans.append([])
                kept.append(body)
                continue
            found = np.sort(ats[bounds[n] : bounds[n + 1]])
            starts = found >> 14
            ends = np.maximum.accumulate(starts + WINDOW + (found & 127))
            breaks = np.flatnonzero(starts[1:] > ends[:-1])
            starts, ends = starts[np.append(0, breaks + 1)], ends[np.append(breaks, len(ends) - 1)]
            spans.append([{"start": a, "length": b - a} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
            kept.append(b"".join(body[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(body)], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        sizes = pa.array([len(b) for b in bodies], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("_key"), sizes, pa.array(spans, kind), pa.array(kept, pa.binary())],
            names=[key, *(c.split()[0] for c in ("n_bytes", "spans", "kept"))],
        )

    return work
