"""What the operators share: staged tables, Arrow batches, words and hashes."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.session import end_lease, own_folder

SLICE_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: The folder of staged frames of each application.
_STAGES: dict[str, str] = {}


def stage(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later plans start from the files, so lost executors cost no more than one task. The files go with
    ``release_stages``, when the session's JVM ends, or with a later session's ``bondscope.session.sweep``.
    """
    spark = frame.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _STAGES:
        _STAGES[app] = own_folder(spark, "llm")
    place = f"{_STAGES[app]}/{uuid4().hex}"
    frame.write.parquet(place)
    return spark.read.schema(frame.schema).parquet(place)


def release_stages(spark: SparkSession) -> None:
    """Remove all staged files of this application, once the last result that reads them is written."""
    place = _STAGES.pop(spark.sparkContext.applicationId, None)
    if place is not None:
        end_lease(spark, place)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold some megabytes, unless the session sets a bound of its own.

    By rows alone a batch of texts is as large as a whole task's input, and is held several times over: in the
    executor's buffers, which double as they grow, and in each of its Python workers.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(SLICE_BYTES))


def map_batches(
    frame: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | T.StructType,
    text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply ``work`` to Arrow batches of few megabytes of ``text``; a longer text is a batch of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = None
            for part in slices(batch, text, limit):
                yield work(part)
                pa.default_memory_pool().release_unused()
            del part, batch  # else the text stays while the next batch is read, and at the task's end
        give_back()

    bound_batches(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system; a worker otherwise keeps the most that any stage before needed."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def worker_store() -> dict:
    """What a worker process keeps from task to task. Code arrives anew with each task, so its modules cannot hold it."""
    return sys.modules.setdefault("_bondscope_worker", ModuleType("_bondscope_worker")).__dict__


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part but a single long row holds at most ``limit`` bytes of text."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


class Words:
    """The white-space words of a batch of texts: distinct words, and each word's place in them.

    ``codes`` holds the words of all texts one after the other, ``counts`` how many belong to each
    text, ``rows`` the text of every word.
    """

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        empty = pc.index(coded.dictionary, "").as_py()
        if empty >= 0:
            real = codes != empty
            codes, rows = codes[real], rows[real]
        self.codes, self.rows = codes, rows
        self.dictionary = coded.dictionary
        self.counts = np.bincount(rows, minlength=len(sizes)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])


def count_ascii_words(texts: pa.Array) -> np.ndarray:
    """White-space words of each text."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or bounds[-1] == bounds[0]:
        return np.zeros(len(texts), np.int64)
    points = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    solid = ~((points == 32) | ((points >= 9) & (points <= 13)))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    bounds = bounds - bounds[0]
    heads = bounds[:-1][np.diff(bounds) > 0]
    begins[heads] = solid[heads]
    so_far = np.concatenate([[0], np.cumsum(begins)])
    return (so_far[bounds[1:]] - so_far[bounds[:-1]]).astype(np.int64)


BASE = 0x9E3779B97F4A7C15


def hash_words(words: pa.Array, base: int = BASE, at_once: int = 1 << 15) -> np.ndarray:
    """64-bit polynomial hashes of all strings of an array, some thousands at once; ``base`` is odd."""
    parts = [_hash_some(words.slice(at, at_once), base) for at in range(0, len(words), at_once)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _hash_some(words: pa.Array, base: int) -> np.ndarray:
    """Running sums over the bytes of all strings; differences are taken back to each string's begin."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    text = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    powers = np.full(len(text) + 1, base, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    inverse = np.full(len(text) + 1, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    return mix((sums[bounds[1:]] - sums[bounds[:-1]]) * inverse[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers; every input has its own output."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gather_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of runs, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0)) + total) < 1 << 31 else np.int64
    runs = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    runs += np.arange(total, dtype=kind)
    return runs


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Rows whose CRC-32 of the identifier as text has the remainder; a null identifier is held out too."""
    inside = F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)) == remainder
    return F.coalesce(inside, F.lit(True))


GRAIN = 1 << 30


def sample_place(key: str) -> Column:
    """A place below ``GRAIN`` for every key, the same in every run."""
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(GRAIN))


def hashed_sample(frame: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of the key so that a rerun finds the same."""
    if rows >= total:
        return frame
    return frame.where(sample_place(key) < int(GRAIN * rows / total))


def within_bytes(sample: DataFrame, size: Column, max_bytes: int, lot: str = "lot") -> DataFrame:
    """The rows of a staged sample with the smallest lots, as many as hold at most ``max_bytes`` together.

    Sizes are added up by lot, so rows that share one are taken or left as a whole.
    """
    sizes = sample.groupBy(F.col(lot).alias("lot")).agg(F.sum(size).alias("size")).toArrow().sort_by("lot")
    over = np.flatnonzero(np.cumsum(sizes.column("size").to_numpy().astype(np.int64)) > max_bytes)
    return sample.where(F.col(lot) < sizes.column("lot")[int(over[0])].as_py()) if len(over) else sample
