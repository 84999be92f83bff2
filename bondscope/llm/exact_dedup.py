"""Exact dedup by sorting the content.

Rows are range-partitioned by their normalised bytes with splitters that Spark samples, sorted
externally, and every row is compared in full with its neighbour. A run of equal texts is a
group. The sort key goes on with the order in which rows of a group are preferred, and ends with
the identifier, so a group with a third of all rows is cut over as many tasks as it needs. Runs
that meet at a task's border are compared in full too, and joined: two rows for each task, whatever
the size of the table.

The range key holds the first bytes of the text and its digest, so that the sample the splitters
come from stays small when texts are long. The sort within a task ends with the text itself, and
equality is always decided by the whole text.

Nulls: a null text counts as empty, a null identifier sorts first. Empty texts are one group. Rows
that are equal in everything are a group in which one stays. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondscope.llm.common import map_batches, stage

WHITE = b" \t\n\x0b\x0c\r"
PREFIX_BYTES = 32

PREPARED = "_id long, _row long, _length long, _norm binary, _digest binary, _prefix binary"
RUNS = (
    "_id long, _digest binary, _task int, _run long, _keep long, _keep_row long, _keep_length long, _size long,"
    " _first boolean, _edge binary"
)
BORDERS = "_task int, _run long, _group_keep long, _group_size long, _head boolean"
EMITTED_ROWS = 50_000


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``row_hash``.

    Texts are equal when they have the same characters after white space is deleted. The row with
    the most code points stays, then the one with the smallest identifier.
    ``row_hash`` hashes the text, white space and all, of the row that is first in its task.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"), _row_hash(text).alias("_row")
    )
    prepared = map_batches(rows, _prepare, PREPARED, text="_text")
    ahead = [F.col("_prefix"), F.col("_digest")]
    last = [F.desc("_length"), F.asc("_id"), F.asc("_row")]
    ordered = prepared.repartitionByRange(*ahead, *last).sortWithinPartitions(*ahead, F.col("_norm"), *last)
    runs = stage(ordered.drop("_prefix").mapInArrow(_runs, RUNS))
    # two rows for each task at most
    borders = F.broadcast(spark.createDataFrame(_join_borders(runs), BORDERS))
    return runs.join(borders, ["_task", "_run"], "left").select(
        F.col("_id").alias(key),
        F.when(F.col("_group_size").isNull(), F.col("_keep")).otherwise(F.col("_group_keep")).alias("keep_id"),
        F.coalesce("_group_size", "_size").alias("group_size"),
        (F.col("_first") & F.coalesce("_head", F.lit(True))).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        F.col("_keep_row").alias("row_hash"),
    )


def drop_exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns; of rows equal in identifier and text one stays."""
    kept = exact_groups(docs, text, key).where("kept").select(F.col(key).alias("_key"), F.col("row_hash").alias("_kept_row"))
    hashed = docs.withColumn("_row", _row_hash(text))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_row") == F.col("_kept_row"))
    once = Window.partitionBy(key, "_row").orderBy(F.lit(0))
    left = hashed.join(kept.hint("merge"), same, "left_semi").withColumn("_once", F.row_number().over(once))
    return left.where("_once = 1").select(docs.columns)


def _row_hash(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def _prepare(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("_text"), "")
    norms = [t.translate(None, WHITE) for t in texts.cast(pa.binary()).to_pylist()]
    digests = [hashlib.sha256(n).digest() for n in norms]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("_id"),
            batch.column("_row"),
            pc.utf8_length(texts).cast(pa.int64()),
            pa.array(norms, pa.binary()),
            pa.array(digests, pa.binary()),
            pa.array([n[:PREFIX_BYTES] for n in norms], pa.binary()),
        ],
        names=["_id", "_row", "_length", "_norm", "_digest", "_prefix"],
    )


class _OpenRun:
    """The run at the end of the rows read so far; of its rows only the identifiers are held."""

    def __init__(self, batch: pa.RecordBatch, start: int) -> None:
        self.keep, self.row, self.length, self.norm, self.digest = (
            batch.column(c)[start].as_py() for c in ("_id", "_row", "_length", "_norm", "_digest")
        )
        self.ids = [batch.column("_id").slice(start)]

    def rows(self, task: int, run: int, edge: bool) -> Iterator[pa.RecordBatch]:
        size, first = sum(map(len, self.ids)), True
        for ids in self.ids:
            for start in range(0, len(ids), EMITTED_ROWS):
                part = ids.slice(start, EMITTED_ROWS)
                n = len(part)
                yield _emitted(
                    part,
                    pa.array([self.digest] * n, pa.binary()),
                    task,
                    np.full(n, run),
                    pa.array([self.keep] * n, pa.int64()),
                    pa.array([self.row] * n, pa.int64()),
                    np.full(n, self.length),
                    np.full(n, size),
                    np.arange(n) == (0 if first else -1),
                    [self.norm if first and edge else None] + [None] * (n - 1),
                )
                first = False


def _emitted(ids, digests, task, run, keep, row, length, size, first, edge) -> pa.RecordBatch:
    arrays = [ids, digests, pa.array(np.full(len(ids), task, np.int32)), pa.array(run, pa.int64()), keep, row]
    arrays += [pa.array(length, pa.int64()), pa.array(size, pa.int64()), pa.array(first), pa.array(edge, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in RUNS.split(",")])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts in a sorted partition; every row gets its run's first row and size.

    The first rows of the partition's first and last run carry the text, to be compared with the
    neighbouring partitions.
    """
    task, run, open_run = TaskContext.get().partitionId(), 0, None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        norms = batch.column("_norm")
        differs = np.ones(n, bool)
        differs[1:] = pc.not_equal(norms.slice(1), norms.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        differs[0] = open_run is None or norms[0].as_py() != open_run.norm
        starts = np.flatnonzero(differs)
        before = n if len(starts) == 0 else int(starts[0])
        if before:
            open_run.ids.append(batch.column("_id").slice(0, before))
        if len(starts) == 0:
            continue
        if open_run is not None:
            yield from open_run.rows(task, run, edge=run == 0)
            run += 1
        whole = int(starts[-1]) - before
        if whole:
            heads, sizes = starts[:-1], np.diff(starts)
            part = batch.slice(before, whole)
            first = differs[before : before + whole]
            edge = [None] * whole
            if run == 0:
                edge[0] = norms[before].as_py()
            leads = np.repeat(heads, sizes)
            yield _emitted(
                part.column("_id"),
                part.column("_digest"),
                task,
                run + np.repeat(np.arange(len(heads)), sizes),
                batch.column("_id").take(pa.array(leads)),
                batch.column("_row").take(pa.array(leads)),
                batch.column("_length").take(pa.array(leads)),
                np.repeat(sizes, sizes),
                first,
                edge,
            )
            run += len(heads)
        open_run = _OpenRun(batch, int(starts[-1]))
    if open_run is not None:
        yield from open_run.rows(task, run, edge=True)


def _join_borders(runs: DataFrame) -> list[tuple]:
    """The runs that go on over a border: task, run, and the keeper, size and head of the whole group."""
    spark = runs.sparkSession
    edges = runs.where("_edge is not null")
    known = edges.select("_task", "_run", "_keep", "_keep_length", "_size").collect()
    of_task: dict[int, list] = {}
    for row in sorted(known, key=lambda r: (r["_task"], r["_run"])):
        of_task.setdefault(row["_task"], []).append(row)
    tasks = sorted(of_task)
    pairs = [(of_task[a][-1]["_task"], of_task[a][-1]["_run"], b) for a, b in zip(tasks, tasks[1:], strict=False)]
    if not pairs:
        return []
    # one comparison of two whole texts for each border
    left = spark.createDataFrame(pairs, "_task int, _run long, _next int").join(edges, ["_task", "_run"])
    right = edges.where("_run = 0").select(F.col("_task").alias("_next"), F.col("_edge").alias("_other"))
    goes_on = {r[0] for r in left.join(right, "_next").where("_edge = _other").select("_next").collect()}
    groups: list[list] = []
    for task, before in zip(tasks[1:], tasks, strict=False):
        if task not in goes_on:
            continue
        if groups and groups[-1][-1] is of_task[before][-1]:
            groups[-1].append(of_task[task][0])
        else:
            groups.append([of_task[before][-1], of_task[task][0]])
    return [
        (r["_task"], r["_run"], members[0]["_keep"], sum(m["_size"] for m in members), n == 0)
        for members in groups
        for n, r in enumerate(members)
    ]
