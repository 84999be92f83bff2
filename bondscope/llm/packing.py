"""Packing along a space-filling curve.

A document's words are hashed into a vector, the vector is projected to few dimensions, and the point's
place on a Hilbert curve is the sort key, with a hash of the identifier below it so that equal texts can be
parted. Splitters from a hashed sample of the keys cut the curve into ranges of about equal rows; each task
sorts its range and packs its documents one after the other, so neighbours on the curve share sequences.
Documents are cut at sequence ends. What is left at the end of a range becomes sequences whose lengths
are powers of two, so nothing is padded.

Nulls: a null or empty text is the end token alone, at the middle of the curve; a null identifier is kept.
Repeated rows are documents of their own. A text longer than a sequence spans several; one text at a
time must fit in a task. An empty table gives no rows, extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import Words, gather_runs, give_back, hash_words, hashed_sample, map_batches, slices, worker_store

TOKENIZER, END_ID = "word_bpe_49k.json", 2
SEQUENCE = 4096
DIMENSIONS, BITS, HASH_BITS = 4, 11, 19
OTHER_BASE = 0xA24BAED4963EE407
FEATURES = 1 << 14
SCALE = 6.0
SAMPLED_KEYS_A_RANGE = 200
SLICE = 1 << 20

PIECES = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(
    docs: DataFrame, key: str = "doc_id", tokenizer: str = TOKENIZER, end_id: int = END_ID, sequence: int = SEQUENCE
) -> DataFrame:
    """One row per piece of a document: where it begins there, its ``ids`` and its place in a sequence.

    ``ids`` are unsigned 32-bit numbers, little-endian. ``sequence_id`` is unique, not gapless.
    """
    rows = docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("_text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.xxhash64(F.coalesce(F.col(key), F.lit(0))))
    sampled = hashed_sample(salted, key, ranges * SAMPLED_KEYS_A_RANGE, salted.count())
    keys = map_batches(sampled, _curve_keys, "_curve long", "_text", SLICE)
    splitters = _quantiles(np.sort(keys.toArrow().column(0).to_numpy()), ranges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder.of_worker(tokenizer)
        for batch in batches:
            part = None
            for part in slices(batch, "_text", SLICE):
                words = Words(part.column("_text"))
                ids, lengths = coder.encode(words, end_id)
                curve = curve_keys(words, part.column("_salt"))
                at = np.searchsorted(splitters, curve, side="right").astype(np.int32)
                del words
                arrays = [part.column(key), _binary(ids, lengths), pa.array(curve), pa.array(at)]
                del ids
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "_ids", "_curve", "_range"])
                del arrays
                give_back()
            del part, batch
        give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store().pop("coders", None)  # all texts are coded by now
        packer = Packer(sequence, TaskContext.get().partitionId())
        for batch in batches:
            part = ids = None
            for part in slices(batch, "_ids", SLICE):
                lengths = pc.binary_length(part.column("_ids")).to_numpy().astype(np.int64) // np.dtype(kind).itemsize
                ids = np.frombuffer(b"".join(part.column("_ids").to_pylist()), kind).astype("<u4")
                yield _rows(packer.add(part.column(key), ids, lengths), key)
            del part, ids, batch
        yield _rows(packer.finish(), key)
        del packer
        give_back()

    kind = id_kind(tokenizer)
    placed = salted.mapInArrow(place, f"{key} long, _ids binary, _curve long, _range int")
    ordered = placed.repartitionById(ranges, F.col("_range")).sortWithinPartitions("_curve", key, "_ids")
    return ordered.select(key, "_ids").mapInArrow(run, f"{key} long, {PIECES}")


def _binary(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ids as little-endian bytes."""
    bounds = (np.concatenate([[0], np.cumsum(lengths)]) * ids.itemsize).astype(np.int32)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(ids))]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


def _curve_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys = curve_keys(Words(batch.column("_text")), batch.column("_salt"))
    return pa.RecordBatch.from_arrays([pa.array(keys)], names=["_curve"])


def curve_keys(words: Words, salts: pa.Array) -> np.ndarray:
    """Sort keys: the place on the curve, and below it some bits of the salt."""
    salt = salts.to_numpy() & ((1 << HASH_BITS) - 1)
    return (hilbert_keys(points(words)).astype(np.int64) << HASH_BITS) | salt


def _quantiles(ranked: np.ndarray, ranges: int) -> np.ndarray:
    if len(ranked) == 0 or ranges < 2:
        return np.zeros(0, np.int64)
    return ranked[(np.arange(1, ranges) * len(ranked)) // ranges]


def points(words: Words) -> np.ndarray:
    """Cells of texts in a few dimensions: the mean of their hashed words' random directions."""
    directions = np.random.default_rng(11).normal(size=(FEATURES, DIMENSIONS)).astype(np.float32)
    own = directions[(hash_words(pc.utf8_lower(words.dictionary)) % np.uint64(FEATURES)).astype(np.int64)]
    sums = np.stack(
        [np.bincount(words.rows, weights=own[:, d][words.codes], minlength=len(words.counts)) for d in range(DIMENSIONS)], axis=1
    )
    mean = SCALE * sums / np.maximum(words.counts, 1)[:, None]
    unit = 1 / (1 + np.exp(-np.clip(mean, -30, 30)))
    return np.minimum((unit * (1 << BITS)).astype(np.uint64), (1 << BITS) - 1)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer points: undo the turns of each level, Gray-decode, interleave."""
    axes = [cells[:, d].astype(np.uint64) for d in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        low = np.uint64(level - 1)
        for d in range(len(axes)):
            upper = (axes[d] & np.uint64(level)) != 0
            swapped = np.where(upper, np.uint64(0), (axes[0] ^ axes[d]) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ swapped)
            if d:
                axes[d] = axes[d] ^ swapped
        level >>= 1
    for d in range(1, len(axes)):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros(len(cells), np.uint64)
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((axes[-1] & np.uint64(level)) != 0, turn ^ np.uint64(level - 1), turn)
        level >>= 1
    place = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << np.uint64(1)) | (((axis ^ turn) >> np.uint64(bit)) & np.uint64(1))
    return place


def id_kind(tokenizer: str) -> str:
    """The shortest unsigned numbers that hold a vocabulary's ids; they make the exchange smaller."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(public_tokenizers.path(tokenizer)).get_vocab_size() <= 1 << 16 else "<u4"


class WordNumbers:
    """Numbers of words in the order they came, found by two 64-bit hashes in a table with open addresses."""

    def __init__(self, places: int) -> None:
        self.bits = max(places - 1, 1).bit_length()
        self.hashes = np.zeros((0, 2), np.uint64)
        self.table = np.full(1 << self.bits, -1, np.int32)

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for unknown ones."""
        out, at, left = np.full(len(hashes), -1, np.int64), self._first(hashes), np.arange(len(hashes))
        while len(left):
            held = self.table[at[left]]
            left, held = left[held >= 0], held[held >= 0]
            same = (self.hashes[held] == hashes[left]).all(axis=1)
            out[left[same]] = held[same]
            left = left[~same]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number words that are unknown and all different."""
        numbers = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        self.hashes = np.concatenate([self.hashes, hashes])
        at, left = self._first(hashes), np.arange(len(hashes))
        while len(left):
            free = left[self.table[at[left]] < 0]
            self.table[at[free]] = numbers[free]
            left = left[self.table[at[left]] != numbers[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def keep(self, numbers: np.ndarray) -> None:
        """Forget all other words; those kept are numbered anew."""
        hashes, self.hashes = self.hashes[numbers], np.zeros((0, 2), np.uint64)
        self.table[:] = -1
        self.add(hashes)


class WordCoder:
    """Token ids of texts, cut word by word: the tokenizer's pattern never joins across white space, nor do its special tokens.

    A word of Latin letters is one match of that pattern, and so is a mark after it. Such words are
    lower-cased here and given to the tokenizer's model many at once, without its normaliser and pattern;
    their end-of-word tokens tell them apart. All other words are encoded alone by the whole tokenizer.
    """

    MARKS = ".,;:!?"
    LATIN = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+$"
    #: Words a worker keeps from slice to slice and task to task.
    HELD = 600_000
    AT_ONCE = 2_000

    def __init__(self, name: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(public_tokenizers.path(name))
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        marks = [c.ids for c in self.whole.encode_batch_fast(list(self.MARKS), add_special_tokens=False)]
        #: Marks of one token; a word with another mark is encoded alone.
        self.marks = {mark: ids[0] for mark, ids in zip(self.MARKS, marks, strict=True) if len(ids) == 1}
        self.kind = "<u2" if len(self.ends) <= 1 << 16 else "<u4"
        #: Words met so far, the ids of all of them one after the other, and how many each has.
        self.known, self.ids, self.sizes = WordNumbers(2 * self.HELD), np.zeros(0, self.kind), np.zeros(0, np.int64)

    @classmethod
    def of_worker(cls, name: str) -> WordCoder:
        """The coder that this worker process keeps."""
        held = worker_store().setdefault("coders", {})
        if name not in held:
            held[name] = cls(name)
        return held[name]

    def encode(self, words: Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end_id``, and how many every text has."""
        flat, sizes = self.words(words.dictionary)
        own = sizes[words.codes]
        lengths = np.bincount(words.rows, weights=own, minlength=len(words.counts)).astype(np.int64) + 1
        out = np.full(int(lengths.sum()), end_id, self.kind)
        body = np.ones(len(out), bool)
        body[np.cumsum(lengths) - 1] = False
        out[body] = flat[gather_runs((np.cumsum(sizes) - sizes)[words.codes], own)]
        return out, lengths

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after the other, and how many each has."""
        last = pc.utf8_slice_codeunits(words, -1)
        marked = pc.and_(pc.is_in(last, pa.array(list(self.marks), pa.string())), pc.greater(pc.utf8_length(words), 1))
        core = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        latin = pc.match_substring_regex(core, self.LATIN)
        coded = pc.if_else(latin, pc.utf8_lower(core), words).dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        starts = np.cumsum(self.sizes) - self.sizes
        marked = pc.and_(marked, latin).to_numpy(zero_copy_only=False)
        whole = self.sizes[place] + marked
        flat = np.zeros(int(whole.sum()), self.kind)
        at_mark = np.zeros(len(flat), bool)
        at_mark[(np.cumsum(whole) - 1)[marked]] = True
        flat[~at_mark] = self.ids[gather_runs(starts[place], self.sizes[place])]
        table = np.zeros(128, self.kind)
        for mark, token in self.marks.items():
            table[ord(mark)] = token
        flat[at_mark] = table[np.frombuffer("".join(last.filter(pa.array(marked)).to_pylist()).encode(), np.uint8)]
        return flat, whole

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the words stand among the known ones; new ones are learnt, and all others go if there are too many."""
        hashes = np.stack([hash_words(words), hash_words(words, OTHER_BASE)], axis=1)
        found = self.known.find(hashes)
        fresh = found < 0
        if len(self.sizes) + fresh.sum() > self.HELD:
            kept = found[~fresh]
            starts = np.cumsum(self.sizes) - self.sizes
            self.ids, self.sizes = self.ids[gather_runs(starts[kept], self.sizes[kept])], self.sizes[kept]
            self.known.keep(kept)
            found[~fresh] = np.arange(len(kept))
        if not fresh.any():
            return found
        new = words.filter(pa.array(fresh))
        latin = pc.match_substring_regex(new, self.LATIN)
        order = np.argsort(~latin.to_numpy(zero_copy_only=False), kind="stable")
        letters, others = new.filter(latin).to_pylist(), new.filter(pc.invert(latin)).to_pylist()
        learnt = [(self.ids, self.sizes), *self._letters(letters), *self._alone(others)]
        found[np.flatnonzero(fresh)[order]] = len(self.sizes) + np.arange(len(order))
        self.known.add(hashes[fresh][order])
        self.ids, self.sizes = (np.concatenate(c) for c in zip(*learnt, strict=True))
        return found

    def _letters(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(words), self.AT_ONCE):
            group = words[at : at + self.AT_ONCE]
            (code,) = self.plain.encode_batch_fast([" ".join(group)], add_special_tokens=False)
            ids = np.array(code.ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group):
                yield ids, np.diff(ends, prepend=0)
            else:
                yield from self._alone(group)

    def _alone(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(words), self.AT_ONCE):
            coded = self.whole.encode_batch_fast(words[at : at + self.AT_ONCE], add_special_tokens=False)
            ids = [c.ids for c in coded]
            yield np.array([i for one in ids for i in one], self.kind), np.array([len(one) for one in ids], np.int64)


@dataclass
class Stretch:
    """Documents, or what is still to place of them, one after the other."""

    keys: pa.Array
    starts: np.ndarray
    lengths: np.ndarray
    wholes: np.ndarray
    ids: np.ndarray


class Packer:
    """Cuts a stream of documents into sequences; holds less than one sequence back."""

    def __init__(self, sequence: int, task: int) -> None:
        self.sequence, self.number = sequence, task << 40
        nothing = np.zeros(0, np.int64)
        self.held = Stretch(pa.array([], pa.int64()), nothing, nothing, nothing, np.zeros(0, "<u4"))

    def add(self, keys: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> tuple[Stretch, np.ndarray, np.ndarray]:
        held = self.held
        stream = Stretch(
            pa.concat_arrays([held.keys, keys]),
            np.concatenate([held.starts, np.zeros(len(lengths), np.int64)]),
            np.concatenate([held.lengths, lengths]),
            np.concatenate([held.wholes, lengths]),
            np.concatenate([held.ids, ids]),
        )
        full = len(stream.ids) // self.sequence
        return self._cut(stream, np.arange(full + 1) * self.sequence)

    def finish(self) -> tuple[Stretch, np.ndarray, np.ndarray]:
        """The rest in sequences of power-of-two lengths, the longest first."""
        left = len(self.held.ids)
        sizes = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        return self._cut(self.held, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def _cut(self, stream: Stretch, bounds: np.ndarray) -> tuple[Stretch, np.ndarray, np.ndarray]:
        """The pieces between sequence bounds, their sequences and offsets; what follows is held."""
        ends = np.cumsum(stream.lengths)
        begins, last = ends - stream.lengths, int(bounds[-1])
        cuts = np.unique(np.concatenate([begins[begins < last], bounds[:-1]])).astype(np.int64)
        doc = np.searchsorted(begins, cuts, side="right") - 1
        place = np.searchsorted(bounds, cuts, side="right") - 1
        pieces = Stretch(
            stream.keys.take(pa.array(doc)),
            stream.starts[doc] + cuts - begins[doc],
            np.diff(np.append(cuts, last)) if len(cuts) else cuts,
            stream.wholes[doc],
            stream.ids[:last],
        )
        left = np.flatnonzero(ends > last)
        gone = np.maximum(last - begins[left], 0)
        self.held = Stretch(
            stream.keys.take(pa.array(left)),
            stream.starts[left] + gone,
            stream.lengths[left] - gone,
            stream.wholes[left],
            stream.ids[last:],
        )
        sequences = self.number + place
        self.number += len(bounds) - 1
        return pieces, sequences, cuts - bounds[place]


def _rows(packed: tuple[Stretch, np.ndarray, np.ndarray], key: str) -> pa.RecordBatch:
    pieces, sequences, offsets = packed
    arrays = [pieces.keys, *(pa.array(x.astype(np.int64)) for x in (pieces.starts, pieces.lengths, pieces.wholes, sequences, offsets)),
              _binary(pieces.ids, pieces.lengths)]
    return pa.RecordBatch.from_arrays(arrays, names=[key, *(c.split()[0] for c in PIECES.split(", "))])
