"""Language identification with a string kernel.

A text is the set of its hashed character n-grams of several lengths (the blended spectrum); the
kernel of two texts is the size of the common set over the geometric mean of both sizes. Landmark
documents give Nystrom features, and kernel ridge regression fits one function for each language
against the rest. As the last steps are linear, features and weights are multiplied into one matrix
of n-gram by language, and a batch of documents is scored by one product with its presence rows.

Learnt from: a hashed sample, evenly over the languages, bounded in rows and in bytes. Landmarks are the rows of each
language with the smallest hashes. How sharp scores are is chosen on a fifth of the sample, by functions fitted to the
rest of it. Only text is an input of a prediction.

Nulls: rows with a null language or text are not learnt from. A null text, an empty one and one without
a letter are ``und`` with score 0; so is every text if there is nothing to learn from. With one language
all texts with letters are of it. Ties go to the language first in order. Repeated rows are predicted
alike, an empty table gives no rows, extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import GRAIN, map_batches, stage, within_bytes

#: Bounds of the sample, in rows and in bytes of their cells (four a cell; a row has at most ``CELLS``).
MAX_LEARNT, MAX_BYTES = 2_400, 96 << 20
MAX_LANDMARKS = 320
LENGTHS = (1, 2, 3)
CELLS = 1 << 18
RIDGE = 1e-3
UNKNOWN = "und"


def ngram_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram cells present in each text, one text after the other, and where each text begins."""
    lowered = pc.utf8_lower(pc.fill_null(texts, "")).to_pylist()
    present = np.zeros(CELLS, bool)
    found = []
    for text in lowered:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        hashed = np.zeros(len(points), np.uint64)
        for n in range(max(LENGTHS)):
            # the hash of the n-gram that begins at each place goes on with the next character
            hashed = hashed[: max(len(points) - n, 0)] * np.uint64(0x100000001B3) + points[n:] + np.uint64(1)
            if n + 1 in LENGTHS:
                present[(hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)] = True
        cells = np.flatnonzero(present)
        present[cells] = False
        found.append(cells.astype(np.int32))
    starts = np.concatenate([[0], np.cumsum([len(c) for c in found])]).astype(np.int64)
    return (np.concatenate(found) if found else np.zeros(0, np.int32)), starts


@dataclass
class LanguageModel:
    """For every cell seen in a landmark (others have row 0) a weight for each language."""

    languages: list[str]
    row_of: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    sharpness: float

    def decide(self, cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Values of the one-versus-rest functions, a row for each text."""
        sizes = np.diff(starts)
        values = np.zeros((len(sizes), len(self.languages)), np.float32)
        filled = np.flatnonzero(sizes)
        if len(filled):
            values[filled] = np.add.reduceat(self.weights[self.row_of[cells]], starts[filled], axis=0)
        return values / np.sqrt(np.maximum(sizes, 1))[:, None] + self.offset

    def shares(self, values: np.ndarray) -> np.ndarray:
        raised = np.exp(self.sharpness * (values - values.max(axis=1, keepdims=True)))
        return raised / raised.sum(axis=1, keepdims=True)


def learn(sets: list[np.ndarray], languages: list[str], landmarks: int = MAX_LANDMARKS) -> LanguageModel | None:
    """Fit on cell sets in a random order; the first of each language are landmarks."""
    if not sets:
        return None
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages])
    share = max(1, landmarks // len(names))
    marks = np.sort(np.concatenate([np.flatnonzero(label == k)[:share] for k in range(len(names))]))
    known = np.unique(np.concatenate([sets[m] for m in marks]))
    row_of = np.zeros(CELLS, np.int32)
    row_of[known] = np.arange(1, len(known) + 1)
    base = np.zeros((len(known) + 1, len(marks)), np.float32)
    for column, m in enumerate(marks):
        base[row_of[sets[m]], column] = 1 / np.sqrt(max(len(sets[m]), 1))
    base[0] = 0
    kernel = np.stack([_common(base, row_of[s]) / np.sqrt(max(len(s), 1)) for s in sets])
    values, vectors = np.linalg.eigh(kernel[marks])
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel @ root
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    fitted, offset = ridge(features, target)
    model = LanguageModel(names, row_of, (base @ (root @ fitted)).astype(np.float32), offset, 1.0)
    apart = np.arange(len(sets)) % 5 == 4
    if apart.any():
        weights, shift = ridge(features[~apart], target[~apart])
        decided, own = features[apart] @ weights + shift, (np.arange(apart.sum()), label[apart])
        losses = {}
        for model.sharpness in (1.0, 2.0, 4.0, 8.0):
            losses[-np.log(np.maximum(model.shares(decided)[own], 1e-12)).mean()] = model.sharpness
        model.sharpness = losses[min(losses)]
    return model


def _common(base: np.ndarray, rows: np.ndarray, at_once: int = 1 << 13) -> np.ndarray:
    """Sums of rows of ``base``, some thousands at once, so that a very long text takes no more memory."""
    parts = [base[rows[at : at + at_once]].sum(axis=0, dtype=float) for at in range(0, len(rows), at_once)]
    return np.sum(parts, axis=0) if parts else np.zeros(base.shape[1])


def ridge(features: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offset of a ridge regression whose offset is not penalised."""
    centre, middle = features.mean(axis=0), target.mean(axis=0)
    spread = (features - centre).T @ (features - centre) + RIDGE * len(features) * np.eye(features.shape[1])
    fitted = np.linalg.solve(spread, (features - centre).T @ (target - middle))
    return fitted, middle - centre @ fitted


def pack_sets(cells: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The cell set of each text as bytes."""
    return pa.array([cells[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())


def fit_languages(
    docs: DataFrame, learnable: Column, max_rows: int = MAX_LEARNT, max_bytes: int = MAX_BYTES
) -> LanguageModel | None:
    """Learn from the rows for which ``learnable`` holds, about as many of each language.

    The sample is staged with its cells; of rows that do not fit in ``max_bytes`` as many stay of each language.
    """
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    portion = F.lit(0)
    for lang, count in sorted(counts.items()):
        aim = min(GRAIN, GRAIN * max_rows // (len(counts) * count))
        portion = F.when(F.col("lang") == lang, F.lit(aim)).otherwise(portion)
    place = F.pmod(F.xxhash64(F.lit("learn"), "doc_id"), F.lit(GRAIN))
    # the place within the portion of the language, so that a cut takes as much from each
    lot = F.floor(place / portion * GRAIN).cast("long").alias("lot")
    sampled = rows.where(place < portion).select(lot, "lang", "text")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        arrays = [batch.column("lot"), batch.column("lang"), pack_sets(*ngram_sets(batch.column("text")))]
        return pa.RecordBatch.from_arrays(arrays, names=["lot", "lang", "cells"])

    found = stage(map_batches(sampled, features, "lot long, lang string, cells binary"))
    found = within_bytes(found, F.length("cells"), max_bytes).toArrow()
    found = found.sort_by([("lot", "ascending"), ("lang", "ascending"), ("cells", "ascending")])
    sets = [np.frombuffer(c, np.int32) for c in found.column("cells").to_pylist()]
    return learn(sets, found.column("lang").to_pylist())


def predict_languages(docs: DataFrame, model: LanguageModel | None, key: str = "doc_id") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("_text"), "")
        letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False) & (model is not None)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if letters.any():
            shares = model.shares(model.decide(*ngram_sets(texts)))
            best = shares.argmax(axis=1)
            scores = np.where(letters, shares[np.arange(len(texts)), best], 0.0)
            names = [model.languages[b] if known else UNKNOWN for b, known in zip(best, letters, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(key), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            names=[key, "lang_pred", "score"],
        )

    rows = docs.select(F.col(key), F.col("text").cast("string").alias("_text"))
    return map_batches(rows, work, f"{key} {rows.schema[key].dataType.simpleString()}, lang_pred string, score double", "_text")
