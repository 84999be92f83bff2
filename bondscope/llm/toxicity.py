"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed parts (the word and its beginnings of three to six characters),
each looked up in two tables by two independent hashes. Filters of several widths slide over the
words of the whole text, each keeps its largest answer, and a logistic layer on the maxima gives the
score. Only text is an input. The model is trained on a bounded, hashed sample of the labelled rows and
broadcast; its size does not depend on the corpus. All labelled rows outside that sample, a quarter of them
at least, are scored where they lie and counted in fine cells of the score by language and label: on these
counts the score is calibrated, and a rejection threshold is chosen for every language. Thresholds decide,
scores do not depend on the language.

Nulls: a null text is scored like an empty one, which has no words; a null label or identifier is not
learnt from; a null or unseen language has the threshold of all languages together. Without labels of
both kinds every score is the share of toxic labels (0 without labels). Repeated rows are scored alike,
an empty table gives no rows, other columns travel along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.llm.common import GRAIN, Words, gather_runs, hash_words, map_batches, mix, sample_place

#: Bounds of the training sample: rows and bytes of text.
MAX_LABELLED = 5_000
MAX_BYTES = 16 << 20
#: Cells to a unit of the uncalibrated log odds, and cells on either side of zero; the outermost are open.
FINE, REACH = 256, 8192
BUCKETS = 1 << 17
HALF = 8
BEGINNINGS = (3, 4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 2
DOCS_A_STEP = 48
SLICE = 4 << 20


@dataclass
class Texts:
    """Words of texts as codes: the parts of every distinct word, and each text's word sequence."""

    buckets: tuple[np.ndarray, np.ndarray]
    part_starts: np.ndarray
    codes: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Texts:
        words = Words(texts)
        bare = pc.utf8_trim(pc.utf8_lower(words.dictionary), characters=".,;:!?\"'()[]")
        length = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
        parts = [hash_words(bare)]
        for k in BEGINNINGS:
            parts.append(mix(hash_words(pc.utf8_slice_codeunits(bare, 0, k)) + np.uint64(k)))
        there = np.stack([length >= k for k in (0, *BEGINNINGS)], axis=1)
        hashes = np.stack(parts, axis=1)[there]
        starts = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
        size = np.uint64(BUCKETS)
        pair = (hashes % size).astype(np.int32), (mix(hashes) % size).astype(np.int32)
        return cls(pair, starts, words.codes, words.starts)


@dataclass
class Cnn:
    """Two embedding tables, a filter bank (width, embedding, filter) and bias for each width, the last layer."""

    tables: list[np.ndarray]
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def start(cls, share: float, seed: int = 7) -> Cnn:
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.normal(size=shape) * 0.3).astype(np.float32)
        banks = [normal(w, 2 * HALF, FILTERS) for w in WIDTHS]
        biases = [np.full(FILTERS, -1, np.float32) for _ in WIDTHS]
        weights = normal(FILTERS * len(WIDTHS))
        return cls([normal(BUCKETS, HALF) * 0.2 for _ in range(2)], banks, biases, weights, float(np.log(share / (1 - share))))

    def prime(self, texts: Texts, labels: np.ndarray) -> None:
        """Begin with embeddings whose first value is the log odds of toxic texts to hold the bucket.

        One filter of each width reads that value. A largest answer passes the gradient to one word of a
        text only, so from a random start the words that matter are seldom found.
        """
        yes, no = max(float(labels.sum()), 1.0), max(float((1 - labels).sum()), 1.0)
        counts = [np.zeros((2, BUCKETS)) for _ in self.tables]
        for at in range(0, len(labels), 500):
            rows = np.arange(at, min(at + 500, len(labels)))
            part = subset(texts, rows)
            text = np.repeat(np.arange(len(rows)), np.diff(part.starts))
            pairs = np.unique(text * (len(part.part_starts) - 1) + part.codes)
            text, word = np.divmod(pairs, max(len(part.part_starts) - 1, 1))
            lengths = part.part_starts[word + 1] - part.part_starts[word]
            slots, text = gather_runs(part.part_starts[word], lengths), np.repeat(text, lengths)
            for count, place in zip(counts, part.buckets, strict=True):
                text_once, cell = np.divmod(np.unique(text * BUCKETS + place[slots]), BUCKETS)
                np.add.at(count, (labels[rows][text_once].astype(int), cell), 1)
        for table, (others, toxic) in zip(self.tables, counts, strict=True):
            table[:, 0] = (np.log((toxic + 1) / (yes + 2)) - np.log((others + 1) / (no + 2))) / 4
        for bank, n in zip(self.banks, range(len(self.banks)), strict=True):
            bank[:, :, 0] = 0
            bank[0, [0, HALF], 0] = 1
            self.weights[n * FILTERS] = 0.5

    def embed(self, texts: Texts) -> np.ndarray:
        """Embeddings of the distinct words, and a row of zeros for what lies beyond a text."""
        words = len(texts.part_starts) - 1
        rows = np.zeros((words + 1, 2 * HALF), np.float32)
        for half, (table, place) in enumerate(zip(self.tables, texts.buckets, strict=True)):
            if words:
                rows[:-1, half * HALF : (half + 1) * HALF] = np.add.reduceat(table[place], texts.part_starts[:-1], axis=0)
        return rows

    def answers(self, texts: Texts, embedded: np.ndarray) -> list[np.ndarray]:
        """For every width the largest answer of each filter in each text, before the bias."""
        out = []
        filled = np.flatnonzero(np.diff(texts.starts))
        for bank in self.banks:
            best = np.zeros((len(texts.starts) - 1, FILTERS), np.float32)
            if len(filled):
                best[filled] = np.maximum.reduceat(self.slide(texts, embedded, bank), texts.starts[filled], axis=0)
            out.append(best)
        return out

    @staticmethod
    def slide(texts: Texts, embedded: np.ndarray, bank: np.ndarray) -> np.ndarray:
        """A filter bank's answer at every word; windows that leave the text go on with zeros."""
        total = None
        for step, layer in enumerate(bank):
            part = (embedded @ layer)[shifted(texts, step, len(embedded) - 1)]
            total = part if total is None else total + part
        return total

    def logits(self, texts: Texts) -> np.ndarray:
        best = self.answers(texts, self.embed(texts))
        hidden = np.hstack([np.maximum(b + bias, 0) for b, bias in zip(best, self.biases, strict=True)])
        return hidden @ self.weights + self.offset

    def scores(self, texts: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.logits(texts) + self.shift)))


def shifted(texts: Texts, step: int, beyond: int) -> np.ndarray:
    """The word ``step`` places on from every word, ``beyond`` past the end of its text."""
    if step == 0:
        return texts.codes
    on = np.full(len(texts.codes), beyond, texts.codes.dtype)
    on[:-step] = texts.codes[step:]
    ends = texts.starts[1:]
    for back in range(1, step + 1):
        at = ends - back
        on[at[at >= texts.starts[:-1]]] = beyond
    return on


def subset(texts: Texts, rows: np.ndarray) -> Texts:
    """Some of the texts, with only their words."""
    lengths = texts.starts[rows + 1] - texts.starts[rows]
    used, codes = np.unique(texts.codes[gather_runs(texts.starts[rows], lengths)], return_inverse=True)
    part_lengths = texts.part_starts[used + 1] - texts.part_starts[used]
    parts = gather_runs(texts.part_starts[used], part_lengths)
    starts = lambda n: np.concatenate([[0], np.cumsum(n)])
    return Texts(tuple(b[parts] for b in texts.buckets), starts(part_lengths), codes, starts(lengths))


def train(texts: Texts, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Cnn:
    """Fit by Adagrad on small groups of texts; the gradient follows each filter's best window."""
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    net = Cnn.start(share, seed)
    net.prime(texts, labels)
    dense = [*net.banks, *net.biases, net.weights]
    seen = [np.full_like(x, 1e-2) for x in dense]
    seen_tables = [np.full_like(t, 1e-3) for t in net.tables]
    seen_offset, rare = 1e-2, np.sqrt((1 - share) / share)
    order = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = 0.1 * (1 - epoch / epochs)
        shuffled = order.permutation(len(labels))
        for at in range(0, len(shuffled), DOCS_A_STEP):
            rows = shuffled[at : at + DOCS_A_STEP]
            part, want = subset(texts, rows), labels[rows]
            embedded = net.embed(part)
            words = np.repeat(np.arange(len(rows)), np.diff(part.starts))
            filled = np.flatnonzero(np.diff(part.starts))
            hidden, places = [], []
            for bank, bias in zip(net.banks, net.biases, strict=True):
                best, place = np.zeros((len(rows), FILTERS), np.float32), np.full((len(rows), FILTERS), -1)
                if len(filled):
                    answer = net.slide(part, embedded, bank)
                    best[filled] = np.maximum.reduceat(answer, part.starts[filled], axis=0)
                    spot, which = np.nonzero(answer == best[words])
                    place[words[spot], which] = spot
                hidden.append(np.maximum(best + bias, 0))
                places.append(place)
            flat = np.hstack(hidden)
            miss = 1 / (1 + np.exp(-(flat @ net.weights + net.offset))) - want
            miss = (miss * np.where(want == 1, rare, 1 / rare) / len(rows)).astype(np.float32)
            back = np.outer(miss, net.weights) * (flat > 0)
            grads: list[np.ndarray] = []
            bias_grads = []
            on_words = np.zeros_like(embedded)
            for n, (width, bank, place) in enumerate(zip(WIDTHS, net.banks, places, strict=True)):
                own = back[:, n * FILTERS : (n + 1) * FILTERS]
                grad = np.zeros_like(bank)
                row, which = np.nonzero((own != 0) & (place >= 0))
                error, spot = own[row, which], place[row, which]
                for step in range(width):
                    word = shifted(part, step, len(embedded) - 1)[spot]
                    np.add.at(grad[step].T, which, error[:, None] * embedded[word])
                    np.add.at(on_words, word, error[:, None] * bank[step].T[which])
                grads.append(grad)
                bias_grads.append(own.sum(axis=0))
            for x, s, g in zip(dense, seen, [*grads, *bias_grads, flat.T @ miss], strict=True):
                s += g * g
                x -= rate * g / np.sqrt(s)
            seen_offset += float(miss.sum()) ** 2
            net.offset -= rate * float(miss.sum()) / np.sqrt(seen_offset)
            moved = np.flatnonzero(np.abs(on_words[:-1]).sum(axis=1))
            lengths = part.part_starts[moved + 1] - part.part_starts[moved]
            slots, owners = gather_runs(part.part_starts[moved], lengths), np.repeat(moved, lengths)
            for half, (table, past, place) in enumerate(zip(net.tables, seen_tables, part.buckets, strict=True)):
                cells, inverse = np.unique(place[slots], return_inverse=True)
                grad = np.zeros((len(cells), HALF), np.float32)
                np.add.at(grad, inverse, on_words[owners, half * HALF : (half + 1) * HALF])
                past[cells] += grad * grad
                table[cells] -= rate * grad / np.sqrt(past[cells])
    return net


def calibrate(net: Cnn, logits: np.ndarray, toxic: np.ndarray, others: np.ndarray) -> None:
    """Fit slope and shift of the score on counts of rows not trained on, with smoothed targets."""
    yes, no = toxic.sum(), others.sum()
    rows, target = toxic + others, toxic * (yes + 1) / (yes + 2) + others / (no + 2)
    at, x = np.array([1.0, 0.0]), np.stack([logits, np.ones_like(logits)], axis=1).astype(float)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ at))
        spread = (x * (rows * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at -= np.clip(np.linalg.solve(spread, x.T @ (rows * p - target) + 1e-3 * (at - [1, 0])), -2, 2)
    net.slope, net.shift = max(float(at[0]), 1e-3), float(at[1])


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the scores between which the F1 measure of rejecting is best."""
    return best_cut(scores, scores, labels, 1 - labels)


def best_cut(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, others: np.ndarray) -> float:
    """The same for counted cells, each with its lowest and highest score."""
    order = np.argsort(-high, kind="stable")
    low, high, hits = low[order], high[order], np.cumsum(toxic[order])
    f1 = 2 * hits / (np.cumsum((toxic + others)[order]) + toxic.sum())
    last = np.append(high[1:] != high[:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    below = high[best + 1] if best + 1 < len(high) else 0.0
    return float(np.clip((low[best] + below) / 2, 0.3, 0.9))


@dataclass
class ToxicityModel:
    """A trained classifier and the rejection thresholds; ``thresholds[None]`` holds for other languages."""

    net: Cnn | None
    share: float
    thresholds: dict[str | None, float]

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.share)
        return self.net.scores(Texts.of(texts)).astype(float)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_LABELLED,
    max_bytes: int = MAX_BYTES,
    least: int = 20,
) -> ToxicityModel:
    """Learn from documents whose ``doc_id`` has a ``toxic`` label.

    At most about three quarters of ``max_rows`` of them are read to train, and at most ``max_bytes`` of
    text: a bounded sample by a hash of the identifier. All others calibrate. A language has its own
    threshold where the calibration rows hold ``least`` toxic and ``least`` other documents.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    total = marked.count()
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    below = int(GRAIN * 3 / 4 * min(1, max_rows / max(total, 1)))

    size = F.coalesce(F.octet_length("text"), F.lit(0))

    def teaches() -> Column:
        # a text above the bound alone can only calibrate
        return (sample_place("doc_id") < below) & (size <= max_bytes)

    def taught() -> DataFrame:
        # as many rows as the documented bound: 16 bytes each
        chosen = F.broadcast(marked.where(sample_place("doc_id") < below))
        return known.where(teaches()).join(chosen, "doc_id")

    below = place_within(taught().select(sample_place("doc_id").alias("place"), size.alias("size")), max_bytes, below)
    rows = taught().toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    toxic = rows.column("_toxic").to_numpy().astype(np.float32)
    if len(toxic) < 6 or toxic.min() == toxic.max():
        share = known.select("doc_id").join(marked, "doc_id").agg(F.avg("_toxic")).first()[0]
        return ToxicityModel(None, float(share or 0), {None: 0.7})
    net = train(Texts.of(rows.column("text").combine_chunks()), toxic)
    cells = count_cells(known.where(~teaches()), marked, net, least)
    thresholds: dict[str | None, float] = {None: 0.7}
    if cells.num_rows:
        sums = [("low", "min"), ("high", "max"), ("toxic", "sum"), ("others", "sum")]
        whole = cells.group_by("cell").aggregate(sums).sort_by("cell")
        low, high, yes, no = (whole.column("_".join(c)).to_numpy() for c in sums)
        calibrate(net, (low + high) / 2, yes, no)
        score = lambda odds: 1 / (1 + np.exp(-(net.slope * odds + net.shift)))
        thresholds[None] = best_cut(score(low), score(high), yes, no)
        for lang in pc.unique(cells.column("lang").drop_null()).to_pylist():
            own = cells.filter(pc.equal(cells.column("lang"), lang))
            low, high, yes, no = (own.column(c).to_numpy() for c, _ in sums)
            thresholds[lang] = best_cut(score(low), score(high), yes, no)
    return ToxicityModel(net, float(toxic.mean()), thresholds)


def place_within(sample: DataFrame, max_bytes: int, below: int) -> int:
    """The place below which the rows of a bounded sample hold at most ``max_bytes``; ``below`` where all fit."""
    rows = sample.toArrow().sort_by("place")
    over = np.flatnonzero(np.cumsum(rows.column("size").to_numpy().astype(np.int64)) > max_bytes)
    return rows.column("place")[int(over[0])].as_py() if len(over) else below


def count_cells(apart: DataFrame, marked: DataFrame, net: Cnn, least: int) -> pa.Table:
    """Toxic and other documents in each cell of the log odds, and the lowest and highest log odds there.

    Languages with ``least`` of both kinds are counted apart, all others together under null. Texts are scored
    before labels are joined, so that no text is exchanged.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        logits = net.logits(Texts.of(pc.fill_null(batch.column("text"), ""))).astype(float)
        cells = np.clip(np.round(logits * FINE), -REACH, REACH).astype(np.int32)
        arrays = [batch.column("doc_id"), batch.column("lang"), pa.array(cells), pa.array(logits)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "cell", "odds"])

    schema = T.StructType([apart.schema["doc_id"], apart.schema["lang"]]).add("cell", "integer").add("odds", "double")
    judged = map_batches(apart.where("doc_id is not null"), work, schema, limit=SLICE).join(marked, "doc_id")
    totals = [F.sum("toxic").alias("toxic"), F.sum("others").alias("others"), F.min("low").alias("low"), F.max("high").alias("high")]
    bad = F.when(F.col("_toxic") > 0, 1).otherwise(0)
    counted = judged.select("lang", "cell", bad.alias("toxic"), (1 - bad).alias("others"), F.col("odds").alias("low"), F.col("odds").alias("high"))
    counted = counted.groupBy("lang", "cell").agg(*totals)
    tongue = Window.partitionBy("lang")
    enough = F.least(F.sum("toxic").over(tongue), F.sum("others").over(tongue)) >= least
    own = F.when(enough & (F.col("lang") != ""), F.col("lang"))
    counted = counted.select(own.alias("lang"), "cell", "toxic", "others", "low", "high").groupBy("lang", "cell").agg(*totals)
    return counted.toArrow().sort_by([("lang", "ascending"), ("cell", "ascending")])


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All documents with ``score``, the ``threshold`` of their language and whether it ``rejected`` them."""
    kept = [c for c in docs.columns if c not in ("score", "threshold", "rejected")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(pc.fill_null(batch.column("text"), ""))
        own = [model.thresholds.get(lang, model.thresholds[None]) for lang in batch.column("lang").to_pylist()]
        arrays = [*batch.columns, pa.array(scores), pa.array(own, pa.float64()), pa.array(scores >= np.array(own))]
        return pa.RecordBatch.from_arrays(arrays, names=[*kept, "score", "threshold", "rejected"])

    added = T.StructType().add("score", "double").add("threshold", "double").add("rejected", "boolean")
    schema = T.StructType([*docs.schema.fields, *added.fields])
    return map_batches(docs, work, schema, limit=SLICE)
