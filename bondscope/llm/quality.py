"""Quality by co-training.

Two classifiers look at different sides of a document: one at its content (hashed character n-grams present in the
text, and how many there are), one at the page's metadata and layout (source, language, sizes, lines, shares of upper case, digits, marks and
symbols). Both start from the same labelled rows; in every round each gives its most confident labels
for an unlabelled pool to the other, and learns from what the other told it alone. Log odds of both are calibrated and combined on labelled rows that were not trained
on, and all documents are scored.

Labelled rows and the pool are hashed samples, bounded in rows and in bytes. Nulls: a null text is empty, a null source or language is a
value of its own, null labels and identifiers are not learnt from. Without labels of both kinds every
score is the share of good labels (0.5 without labels). Repeated rows are scored alike; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import GRAIN, map_batches, sample_place, stage, within_bytes
from bondscope.llm.language import ngram_sets, pack_sets
from bondscope.llm.linear import DenseClassifier, SetClassifier, newton, train_dense, train_sets

#: Bounds of the samples in rows, and of both together in bytes of their n-gram cells.
MAX_LABELLED, MAX_POOL, MAX_BYTES = 2_400, 2_400, 192 << 20
ROUNDS = 3
#: Pool rows a view labels in a round, at most this share of each class, and how sure it must be.
SHARE, SURE = 0.1, 0.95
NAMES = 24

#: Patterns counted per character.
SHARES = (r"\p{Lu}", r"\p{Nd}", r"[.,;:!?]", r"[#*$%&|<>]", r"\s", r"!!|\?\?")


def page_columns(batch: pa.RecordBatch) -> np.ndarray:
    """Metadata and layout of documents as numbers."""
    texts = pc.fill_null(batch.column("text"), "")
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(float)
    lines = pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1.0
    columns = [np.log1p(length), np.log1p(lines), np.log1p(length / lines)]
    for pattern in SHARES:
        found = pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        columns.append(np.sqrt(found / np.maximum(length, 1)))
    for name in ("source", "lang"):
        cells = np.array([crc32((v or "").encode()) % NAMES if v is not None else NAMES for v in batch.column(name).to_pylist()], int)
        columns += list((cells[:, None] == np.arange(NAMES + 1)).T.astype(float))
    return np.stack(columns, axis=1)


def content_extras(cells: np.ndarray, starts: np.ndarray, texts: pa.Array) -> np.ndarray:
    """How many distinct n-grams a text has, in all and for its length."""
    sizes = np.diff(starts).astype(float)
    length = pc.utf8_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False)
    return np.stack([np.log1p(sizes), np.log1p(sizes) - np.log1p(length)], axis=1)


@dataclass
class ContentView:
    sets: SetClassifier
    extras: DenseClassifier

    def odds(self, cells: np.ndarray, starts: np.ndarray, extras: np.ndarray) -> np.ndarray:
        values = self.sets.values(cells, starts)
        return values[:, 1] - values[:, 0] + self.extras.odds(extras)


@dataclass
class QualityModel:
    """Both views and the weights of their log odds; without views all scores are ``share``."""

    share: float
    content: ContentView | None = None
    page: DenseClassifier | None = None
    weights: np.ndarray | None = None

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined score and the calibrated scores of both views."""
        if self.content is None:
            same = np.full(batch.num_rows, self.share)
            return same, same, same
        cells, starts = ngram_sets(batch.column("text"))
        content = self.content.odds(cells, starts, content_extras(cells, starts, batch.column("text")))
        page = self.page.odds(page_columns(batch))
        squash = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
        a, b, c = self.weights
        return squash(a * content + b * page + c), squash(content), squash(page)


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED, max_pool: int = MAX_POOL, max_bytes: int = MAX_BYTES
) -> QualityModel:
    """Learn from documents with a ``quality`` label, and by co-training from some without.

    At most about ``max_rows`` labelled and ``max_pool`` other documents are read. They are staged with their cells;
    if those do not fit in ``max_bytes``, the same share of both samples stays.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    marked = marked.agg(F.min("quality").cast("int").alias("_good"))
    place = sample_place("doc_id")

    def drawn(frame: DataFrame, rows: int, total: int) -> DataFrame:
        portion = GRAIN if rows >= total else int(GRAIN * rows / total)
        # the place within the portion, so that a cut takes as much from both samples
        return frame.where(place < portion).withColumn("_lot", F.floor(place / max(portion, 1) * GRAIN).cast("long"))

    chosen = drawn(marked, max_rows, marked.count())
    # as many rows as the documented bounds
    labelled = docs.join(F.broadcast(chosen), "doc_id")
    pool = drawn(docs.where("doc_id is not null"), max_pool, docs.count())
    pool = pool.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti").withColumn("_good", F.lit(-1))
    columns = ["doc_id", "text", "source", "lang", "_good", "_lot"]
    both = labelled.select(*columns).unionByName(pool.select(*columns))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells, starts = ngram_sets(batch.column("text"))
        dense = np.hstack([content_extras(cells, starts, batch.column("text")), page_columns(batch)])
        arrays = [batch.column("doc_id").cast(pa.int64()), batch.column("_lot"), batch.column("_good")]
        arrays += [pack_sets(cells, starts), pa.array(dense.tolist(), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lot", "good", "cells", "dense"])

    schema = "doc_id long, lot long, good int, cells binary, dense array<double>"
    found = stage(map_batches(both, features, schema))
    found = within_bytes(found, F.length("cells"), max_bytes).toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("cells", "ascending")])
    good = found.column("good").to_numpy()
    sets = [np.frombuffer(c, np.int32) for c in found.column("cells").to_pylist()]
    if not sets:
        return QualityModel(0.5)
    dense = np.array(found.column("dense").to_pylist(), float)
    return co_train(sets, dense[:, :2], dense[:, 2:], good)


def co_train(
    sets: list[np.ndarray], extras: np.ndarray, page: np.ndarray, good: np.ndarray, rounds: int = ROUNDS
) -> QualityModel:
    """Exchange confident labels between the views; ``good`` is 1, 0 or -1 for rows of the pool.

    Each view keeps labels of its own, so where both are sure of a row each learns what the other says.
    """
    known = np.flatnonzero(good >= 0)
    share = float(good[known].mean()) if len(known) else 0.5
    apart, base = known[3::4], np.delete(known, np.s_[3::4])
    if len(known) < 8 or any(len(set(good[rows])) < 2 for rows in (apart, base)):
        return QualityModel(share)
    pool = np.flatnonzero(good < 0)
    content_label, page_label, for_content, for_page = good, good, base, base
    for step in range(rounds + 1):
        content = train_content(sets, extras, content_label, for_content)
        side = train_dense(page[for_page], page_label[for_page])
        if step == rounds or len(pool) == 0:
            break
        page_label, for_page = told(good, base, _sure(content_odds(content, sets, extras, pool), pool, share))
        content_label, for_content = told(good, base, _sure(side.odds(page[pool]), pool, share))
    odds = np.column_stack([content_odds(content, sets, extras, apart), side.odds(page[apart])])
    smooth = np.where(good[apart] == 1, 1 - 1 / (len(apart) + 2), 1 / (len(apart) + 2))
    weights = newton(np.column_stack([odds, np.ones(len(apart))]), smooth, 1e-3)
    return QualityModel(share, content, side, weights)


def told(good: np.ndarray, base: np.ndarray, sure: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The labels one view learns from, and their rows: the given ones and what the other view is sure of."""
    label = good.copy()
    for row, value in sure:
        label[row] = value
    return label, np.union1d(base, np.array([row for row, _ in sure], int))


def train_content(sets: list[np.ndarray], extras: np.ndarray, label: np.ndarray, rows: np.ndarray) -> ContentView:
    return ContentView(train_sets([sets[r] for r in rows], label[rows], 2), train_dense(extras[rows], label[rows], 0.1))


def content_odds(view: ContentView, sets: list[np.ndarray], extras: np.ndarray, rows: np.ndarray) -> np.ndarray:
    cells = np.concatenate([sets[r] for r in rows]) if len(rows) else np.zeros(0, np.int32)
    starts = np.concatenate([[0], np.cumsum([len(sets[r]) for r in rows])]).astype(np.int64)
    return view.odds(cells, starts, extras[rows])


def _sure(odds: np.ndarray, rows: np.ndarray, share: float) -> list[tuple[int, int]]:
    """The rows a view is surest of, good and bad in about their labelled shares."""
    least = np.log(SURE / (1 - SURE))
    order = np.argsort(odds, kind="stable")
    bad = order[: max(1, int(SHARE * len(rows) * (1 - share)))]
    good = order[::-1][: max(1, int(SHARE * len(rows) * share))]
    return [(int(rows[i]), 0) for i in bad if odds[i] <= -least] + [(int(rows[i]), 1) for i in good if odds[i] >= least]


def score_quality(docs: DataFrame, model: QualityModel, key: str = "doc_id") -> DataFrame:
    """``key``, ``score``, ``content_score`` and ``page_score`` of every document."""
    rows = docs.select(key, *[F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [pa.array(s.astype(float)) for s in model.scores(batch)]
        return pa.RecordBatch.from_arrays([batch.column(key), *columns], names=[key, "score", "content_score", "page_score"])

    kind = rows.schema[key].dataType.simpleString()
    return map_batches(rows, work, f"{key} {kind}, score double, content_score double, page_score double")
