"""Importance resampling towards a target: array-scored weights, then a distributed quickselect.

Features are the one- and two-word runs of a text, counted in buckets by CRC-32. The bucket counts of
all documents and of the target texts give an array of gains, one for each bucket; a document's weight is the
floored mean of its features' gains, and its score adds Gumbel noise drawn from a digest of its identifier.

The winners are the rows at or before the k-th composite key (score falling, then identifier, then a
hash of the text, then the row's number). Random rows of the open range are the pivots of a pass, which counts
the rows between and at the pivots exactly; the range narrows to the cell that holds the k-th key until that key
is a pivot. Keys are all different, so a hot key or repeated rows cannot fill a cell. Only winners are sorted, by
range, and ranked by the rows counted before their task.

Nulls: a null text has no words, weight 0 and no place among the eligible; a null identifier draws its noise
as if its text form were empty, and comes first among equal scores. Repeated rows are documents of their own. Texts of
any length are read whole. An empty table gives no rows, an empty target counts as no features. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import Words, map_batches, slices, stage

BUCKETS, SMALLEST, PERCENT, SEED = 10_000, 20, 25, 7
#: Pivots of one counting pass.
PIVOTS = 31
#: Word lengths whose CRC shift is looked up; longer ones are hashed with the word before them.
SHIFTS = 64
SCORED = "_id long, _row long, _tie long, n_features long, n_words long, weight long"

#: The composite key: score falling, identifier (a null one first), hash of the text, number of the row.
KEY = ("_down", "_name", "_tie", "_row")
FIRST = -(1 << 63)

#: Lower-case ASCII letters, digits and all bytes from 0x80 on are parts of words, all else parts them.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    smallest: int = SMALLEST,
    seed: int = SEED,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per document: ``key``, ``n_features``, ``weight``, ``score``, ``rank`` (null where not drawn).

    ``percent`` of the documents of at least ``smallest`` words are drawn, the highest scores first.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"), F.monotonically_increasing_id().alias("_row")
    )
    wanted = target.select(F.col(text).cast("string").alias("_text"))
    gains = bucket_gains(bucket_counts(rows), bucket_counts(wanted))
    scored = map_batches(rows.withColumn("_tie", F.xxhash64("_text")), scorer(gains), SCORED, "_text")
    scored = stage(scored.withColumn("score", F.col("weight") + gumbel("_id", seed)))
    eligible = scored.where(F.col("n_words") >= smallest)
    drawn = eligible.count() * percent // 100
    places = (-F.col("score")).alias("_down"), F.coalesce("_id", F.lit(FIRST)).alias("_name"), "_tie", "_row"
    keyed = eligible.select(*places)
    last = select_key(keyed, drawn) if drawn else (FIRST,) * len(KEY)
    ranks = ranked(keyed.where(_beside(last, "<=")))
    whole = scored.join(ranks.withColumnRenamed("_row", "_drawn"), F.col("_row") == F.col("_drawn"), "left")
    return whole.select(F.col("_id").alias(key), "n_features", "weight", "score", "rank")


class Features:
    """The features of a batch of texts: words, then pairs of neighbouring words, and their texts' rows."""

    def __init__(self, texts: pa.Array) -> None:
        words = Words(folded(texts))
        self.n_words = words.counts
        alone, spaced, lengths = _word_sums(words.dictionary)
        second = np.flatnonzero(words.rows[1:] == words.rows[:-1]) + 1
        before, after = words.codes[second - 1], words.codes[second]
        pairs = joined_sums(spaced[before], alone[after], lengths[after])
        for n in np.flatnonzero(lengths[after] > SHIFTS).tolist():
            pairs[n] = zlib.crc32(words.dictionary[int(after[n])].as_buffer(), int(spaced[before[n]]))
        self.buckets = np.concatenate([alone[words.codes], pairs]) % np.uint32(BUCKETS)
        self.rows = np.concatenate([words.rows, words.rows[second]])
        self.counts = words.counts + np.maximum(words.counts - 1, 0)


def folded(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case and a blank for every character that parts words."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if len(texts) == 0:
        return texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = bytes(data[int(bounds[0]) : int(bounds[-1])] if data is not None else b"").translate(_FOLD)
    buffers = [None, pa.py_buffer(bounds - bounds[0]), pa.py_buffer(body)]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def _word_sums(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of words, of words with a blank after them, and the lengths of words in bytes."""
    plain = words.cast(pa.large_binary()).to_pylist()
    alone = np.fromiter(map(zlib.crc32, plain), np.uint32, len(plain))
    spaced = np.fromiter((zlib.crc32(b" ", c) for c in alone.tolist()), np.uint32, len(plain))
    return alone, spaced, np.fromiter(map(len, plain), np.int64, len(plain))


def _shift_tables() -> np.ndarray:
    """For each length, what each byte of a CRC becomes when as many bytes follow: (length, byte, value)."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    tables = np.zeros((SHIFTS + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for length in range(1, SHIFTS + 1):
        tables[length] = (tables[length - 1] >> np.uint32(8)) ^ steps[tables[length - 1] & np.uint32(255)]
    return tables


_TABLES: list[np.ndarray] = []


def joined_sums(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of joined strings from those of the parts; ``lengths`` of the second parts, up to ``SHIFTS``."""
    if not _TABLES:
        _TABLES.append(_shift_tables())
    length, out = np.minimum(lengths, SHIFTS), second.copy()
    for byte in range(4):
        out ^= _TABLES[0][length, byte, (first >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket; every task sends one row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "_text"):
                held += np.bincount(Features(part.column("_text")).buckets, minlength=BUCKETS)
                pa.default_memory_pool().release_unused()
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(held[seen])], names=["bucket", "features"])

    counted = rows.select("_text").mapInArrow(count, "bucket long, features long")
    table = counted.groupBy("bucket").agg(F.sum("features").alias("features")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("features").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and source shares, floored."""
    ahead = (target + 1).astype(float) * float(source.sum() + BUCKETS)
    behind = (source + 1).astype(float) * float(target.sum() + BUCKETS)
    return np.floor(1000 * np.log(ahead / behind)).astype(np.int64)


def scorer(gains: np.ndarray):
    """Work on a batch: the floored mean gain of each text's features."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        features = Features(batch.column("_text"))
        sums = np.zeros(batch.num_rows, np.int64)
        # gains are whole numbers far below 2^53 in sum for any text that fits in a task
        sums += np.bincount(features.rows, gains[features.buckets], batch.num_rows).astype(np.int64)
        weight = sums // np.maximum(features.counts, 1)
        named = {c: batch.column(c) for c in ("_id", "_row", "_tie")}
        told = (features.counts, features.n_words, weight)
        return pa.RecordBatch.from_arrays(
            [*named.values(), *(pa.array(t, pa.int64()) for t in told)], names=[*named, "n_features", "n_words", "weight"]
        )

    return work


def gumbel(key: str, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of a digest of seed and identifier."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def _beside(key: tuple, sign: str) -> Column:
    """Whether a row's composite key is on the side of ``key`` that ``sign`` tells."""
    values = ", ".join(f"{v}L" if v != FIRST else f"bigint('{v}')" for v in key)
    return F.expr(f"struct({', '.join(KEY)}) {sign} struct({values})")


def select_key(keyed: DataFrame, k: int) -> tuple:
    """The ``k``-th smallest composite key, by counting passes between random pivots."""
    low = high = None
    before, turn = 0, 0
    while True:
        open_rows = keyed if low is None else keyed.where(_beside(low, ">"))
        open_rows = open_rows if high is None else open_rows.where(_beside(high, "<"))
        # the rows of the smallest hashes: at random, alike in every run, as many from every task at most
        drawn = open_rows.orderBy(F.xxhash64(F.lit(turn), "_row", "_tie"), *KEY).limit(PIVOTS).collect()
        pivots = sorted(tuple(r) for r in drawn)
        counts = cell_counts(open_rows, pivots)
        cell = int(np.searchsorted(before + np.cumsum(counts), k))
        before += int(counts[:cell].sum())
        if cell % 2:
            return pivots[cell // 2]
        low = pivots[cell // 2 - 1] if cell else low
        high = pivots[cell // 2] if cell // 2 < len(pivots) else high
        turn += 1


def cell_counts(keyed: DataFrame, pivots: list[tuple]) -> np.ndarray:
    """Exact numbers of rows: cell 2n holds keys between pivots n - 1 and n, cell 2n + 1 those equal to pivot n."""
    cells = 2 * len(pivots) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(cells, np.int64)
        for batch in batches:
            parts = [batch.column(c).to_numpy() for c in KEY]
            at = np.zeros(batch.num_rows, np.int64)
            for pivot in pivots:
                above, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
                for part, value in zip(parts, pivot, strict=True):
                    above |= equal & (part > value)
                    equal &= part == value
                at += 2 * above + equal
            held += np.bincount(at, minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(held)], names=["cell", "rows"])

    told = keyed.mapInArrow(count, "cell long, rows long").groupBy("cell").agg(F.sum("rows")).collect()
    counts = np.zeros(cells, np.int64)
    for cell, rows in told:
        counts[cell] = rows
    return counts


def ranked(winners: DataFrame) -> DataFrame:
    """The winners' rows with their ranks from 1: sorted by range, numbered after the rows of earlier tasks."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = [pa.array(np.full(n, task, np.int32)), pa.array(np.arange(at + 1, at + n + 1))]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *places], names=["_row", "_task", "_at"])
            at += n

    ordered = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    placed = stage(ordered.select("_row").mapInArrow(number, "_row long, _task int, _at long"))
    # a row for each task
    sizes = sorted(placed.groupBy("_task").count().collect())
    ahead = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    firsts = placed.sparkSession.createDataFrame(
        [(task, first) for (task, _), first in zip(sizes, ahead, strict=False)], "_task int, _ahead long"
    )
    return placed.join(F.broadcast(firsts), "_task").select("_row", (F.col("_at") + F.col("_ahead")).alias("rank"))
