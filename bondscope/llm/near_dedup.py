"""Near-duplicate classes by BagMinHash.

A document is the multiset of its five-word shingles; two are near copies when the overlap of the
multisets (sum of smaller counts over sum of larger counts) is at least 0.8. Documents with the same
words in the same order are one text, and only one of them goes on.

Signature: every shingle has Poisson processes, one for each dyadic interval of counts, whose points carry
a time, a slot and a height. A point below the shingle's count takes part; the first point of each slot is the
signature, so two signatures agree in a slot with probability equal to the overlap. Processes are advanced
until every slot is filled. Bands of slots are hashed into buckets.

Candidates: in each bucket all members are compared with the one that meets most others in all its
buckets, which settles groups made from one text in one step. In buckets that still hold several classes, longer signatures are compared in blocks, and
pairs of different classes whose signatures could belong to near copies are compared as well. Every candidate
is verified on the texts. Classes are the connected components of the links found.

A bucket of any size is dealt over tasks in blocks, and a text compared with very many others is sent to
several tasks. The loss of a link of overlap 0.8 is the chance that none of the bands agrees, about 1e-5
with the defaults, or that an estimate falls more than four deviations short.

Nulls: a null or empty text has no shingles, and all such are one class. A text of fewer than five words is
one shingle. A row with a null identifier is a class of its own with null as its class, and is kept.
Repeated rows are copies; rows that share an identifier are documents of their own, told apart by their texts, though
their classes may then have the same ``class_id``. An empty table gives no rows; extra columns are not read. Words are told apart by white space and compared in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondscope.llm.common import Words, give_back, hash_words, map_batches, mix, slices, stage

SHINGLE, SIMILARITY = 5, 0.8
BAND_ROWS, BANDS = 5, 30
#: Slots of the longer signatures that are compared in blocks, and texts in a block.
SKETCH_SLOTS, BLOCK = 512, 512
#: Texts compared with one text in one task.
COMPARED = 1_000
SLICE = 2 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
FACTOR = np.uint64(0x100000001B3)

FEATURES = "_key long, _hash long, _words binary, _bands array<long>"


def near_classes(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per document: ``key``, ``class_id`` (the smallest identifier), ``class_size``, ``kept``."""
    return _classes(docs, text, key, similarity).drop("_hash")


def _classes(docs: DataFrame, text: str, key: str, similarity: float = SIMILARITY) -> DataFrame:
    """The same with the hash of each row's text, which tells texts of one identifier apart."""
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64(F.coalesce("_text", F.lit(""))))
    known = rows.where("_key is not null")
    features = stage(map_batches(known, signatures, FEATURES, "_text", SLICE).withColumn("_row", F.monotonically_increasing_id()))
    # a text is known by the first row that has its words, and numbered as it is written
    first = F.min(F.struct("_key", "_hash", "_row")).alias("_first")
    texts = features.groupBy("_words").agg(first, F.count("*").alias("_rows"), F.first("_bands").alias("_bands"))
    texts = stage(texts.withColumn("_text_id", F.monotonically_increasing_id()))
    buckets = texts.select(F.explode("_bands").alias("_bucket"), F.col("_text_id").alias("_id"))
    shared = buckets.groupBy("_bucket").agg(F.count("*").alias("_members")).where("_members > 1")
    members = stage(led_buckets(stage(buckets.join(shared, "_bucket"))))
    first_pairs = members.where("_id <> _lead").select("_lead", "_id").distinct()
    # the texts that any comparison needs, by one exchange of all texts whatever their number
    met = texts.select(F.col("_text_id").alias("_id"), F.col("_first._key").alias("_its"), F.col("_first._hash").alias("_its_hash"))
    met = met.join(members.select("_id").distinct(), "_id", "left_semi").hint("merge")
    known = known.join(met, (F.col("_key") == F.col("_its")) & (F.col("_hash") == F.col("_its_hash")))
    known = stage(known.select("_id", "_text"))
    links = stage(verify(first_pairs, known, similarity))
    classes = stage(components(links.select("_lead", "_id")))
    rest = contested(members, classes, texts, known, similarity)
    more = stage(verify(rest, known, similarity))
    if not more.isEmpty():
        classes = stage(components(links.select("_lead", "_id").unionByName(more.select("_lead", "_id"))))
    classed = texts.join(classes, F.col("_text_id") == F.col("_node"), "left")
    classed = classed.select("_words", "_first", "_rows", F.coalesce("_class", "_text_id").alias("_class"))
    heads = classed.groupBy("_class").agg(F.min("_first").alias("_head"), F.sum("_rows").alias("class_size"))
    of_text = classed.select("_words", "_class").join(heads, "_class").select("_words", "_head", "class_size")
    whole = features.select("_key", "_hash", "_row", "_words").join(of_text, "_words").select(
        F.col("_key").alias(key),
        F.col("_head._key").alias("class_id"),
        "class_size",
        (F.col("_row") == F.col("_head._row")).alias("kept"),
        "_hash",
    )
    nameless = rows.where("_key is null").select(
        F.col("_key").alias(key), F.col("_key").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"), "_hash"
    )
    return whole.unionByName(nameless)


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each class, the first of its smallest identifier, and the rows without an identifier."""
    kept = _classes(docs.where(F.col(key).isNotNull()), text, key).where("kept")
    kept = kept.select(F.col(key).alias("_its"), F.col("_hash").alias("_its_hash")).hint("merge")
    own = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    left = docs.withColumn("_own_hash", own).join(kept, (F.col(key) == F.col("_its")) & (F.col("_own_hash") == F.col("_its_hash")), "left_semi")
    once = Window.partitionBy(key, "_own_hash").orderBy(F.lit(0))
    left = left.withColumn("_once", F.row_number().over(once)).where("_once = 1").select(docs.columns)
    return left.unionByName(docs.where(F.col(key).isNull()))


def led_buckets(members: DataFrame) -> DataFrame:
    """Buckets with their lead: the member that meets most others over all its buckets.

    The text that a group of copies was made from is nearer to all of them than they are to each other.
    """
    met = members.groupBy("_id").agg(F.sum("_members").alias("_met"))
    ranked = members.join(met, "_id")
    leads = ranked.groupBy("_bucket").agg(F.max(F.struct("_met", (-F.col("_id")).alias("_minus"))).alias("_top"))
    return members.join(leads.select("_bucket", (-F.col("_top._minus")).alias("_lead")), "_bucket")


def shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """Hashes of the word shingles of each text, the text of every shingle, the words and their hashes."""
    words = Words(pc.utf8_lower(pc.fill_null(texts, "")))
    own = hash_words(words.dictionary)[words.codes]
    counts = words.counts
    many = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(counts)), many)
    first = words.starts[:-1][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
    hashed = np.zeros(len(rows), np.uint64)
    last = words.starts[1:][rows]
    for step in range(n):
        at = first + step
        inside = at < last
        hashed = mix(hashed * FACTOR + np.where(inside, own[np.minimum(at, max(len(own) - 1, 0))], 0) + inside) if len(own) else hashed
    return hashed, rows, words, own


def signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The identity of each text's word sequence and its band buckets."""
    hashed, rows, words, own = shingles(batch.column("_text"))
    n, slots = batch.num_rows, BAND_ROWS * BANDS
    # word sequences by two independent polynomial hashes
    place = np.arange(len(own), dtype=np.uint64) - np.repeat(words.starts[:-1], words.counts).astype(np.uint64)
    sums = np.zeros((n, 2), np.uint64)
    if len(own):
        filled = np.flatnonzero(words.counts)
        for half in range(2):
            terms = mix(mix(own + np.uint64(half)) + place * ODD)
            sums[filled, half] = np.add.reduceat(terms, words.starts[:-1][filled])
    identity = np.column_stack([sums, words.counts.astype(np.uint64)])
    points = bag_min_hash(hashed, rows, n, slots)
    bands = np.zeros((n, BANDS), np.uint64)
    for row in range(BAND_ROWS):
        bands = mix(bands * FACTOR + points[:, row::BAND_ROWS])
    bands = mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * ODD).astype(np.int64)
    # texts without words meet by their identity alone
    lists = [b if c else [] for b, c in zip(bands.tolist(), words.counts.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("_key"),
            batch.column("_hash"),
            pa.array([r.tobytes() for r in identity], pa.binary()),
            pa.array(lists, pa.list_(pa.int64())),
        ],
        names=["_key", "_hash", "_words", "_bands"],
    )


def bag_min_hash(hashed: np.ndarray, rows: np.ndarray, n: int, slots: int) -> np.ndarray:
    """For every text and slot the number of the first point of its shingles' Poisson processes."""
    weights = np.bincount(rows, minlength=n)
    order = np.argsort(mix(hashed + mix(rows.astype(np.uint64) * ODD)), kind="stable")
    shingle, owner = hashed[order], rows[order]
    new = np.ones(len(order), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    count = np.diff(np.append(begins, len(order)))
    shingle, owner = shingle[begins], owner[begins]
    # intervals [0, 1), [1, 2), [2, 4), [4, 8) ... as far as the count reaches
    levels, low = [(np.arange(len(count)), 0, 1)], 1
    while len(over := np.flatnonzero(count > low)):
        levels.append((over, low, low))
        low *= 2
    element = np.concatenate([e for e, _, _ in levels])
    bottom = np.concatenate([np.full(len(e), b) for e, b, _ in levels]).astype(float)
    width = np.concatenate([np.full(len(e), w) for e, _, w in levels]).astype(float)
    seed = mix(shingle[element] + mix(bottom.astype(np.uint64) + ODD))
    text, ceiling = owner[element], count[element].astype(float)
    step = np.ones(len(seed), np.uint64)
    number = mix(seed + step * ODD)
    time = _wait(number) / width
    best = np.full(n * slots, np.inf)
    found = np.zeros(n * slots, np.uint64)
    limit = slots * (np.log(slots) + 3) / np.maximum(weights, 1)
    waiting = np.arange(len(seed))
    while True:
        ready = waiting[time[waiting] <= limit[text[waiting]]]
        while len(ready):
            drawn = mix(number[ready] ^ FACTOR)
            slot = ((drawn >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
            height = bottom[ready] + np.floor((drawn & np.uint64(0xFFFFFFFF)).astype(float) / 2**32 * width[ready])
            takes = height < ceiling[ready]
            at = text[ready][takes] * slots + slot[takes].astype(np.int64)
            when = time[ready][takes]
            np.minimum.at(best, at, when)
            first = when == best[at]
            found[at[first]] = number[ready][takes][first]
            step[ready] += np.uint64(1)
            number[ready] = mix(seed[ready] + step[ready] * ODD)
            time[ready] += _wait(number[ready]) / width[ready]
            ready = ready[time[ready] <= limit[text[ready]]]
        open_texts = np.isinf(best).reshape(n, slots).any(axis=1) & (weights > 0)
        if not open_texts.any():
            return found.reshape(n, slots)
        limit[open_texts] *= 2
        waiting = np.flatnonzero(open_texts[text])


def _wait(number: np.ndarray) -> np.ndarray:
    """Exponential waiting times from uniform hashes."""
    return -np.log(((number >> np.uint64(11)).astype(float) + 0.5) / 2**53)


def verify(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """The pairs (``_lead``, ``_id``) whose texts overlap enough, with their ``_overlap``.

    Each text ``_lead`` meets the texts it is compared with in tasks of at most about ``COMPARED`` of them.
    """
    pairs = stage(pairs)
    parts = pairs.groupBy("_lead").agg(F.ceil(F.count("*") / COMPARED).alias("_parts"))
    led = pairs.join(parts, "_lead")
    members = led.select("_lead", F.pmod(F.xxhash64("_id"), "_parts").alias("_part"), "_id", F.lit(1).alias("_role"))
    heads = parts.select(
        "_lead",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"),
        F.col("_lead").alias("_id"),
        F.lit(0).alias("_role"),
    )
    told = members.unionByName(heads).join(known.hint("merge"), "_id")
    met = told.repartition("_lead", "_part").sortWithinPartitions("_lead", "_part", "_role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, bag = None, None
        for batch in batches:
            part = hashed = rows = words = None
            for part in slices(batch, "_text", SLICE):
                hashed, rows, words, _ = shingles(part.column("_text"))
                bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
                found = []
                leads, ids, roles = (part.column(c).to_pylist() for c in ("_lead", "_id", "_role"))
                for n in range(part.num_rows):
                    own = np.unique(hashed[bounds[n] : bounds[n + 1]], return_counts=True)
                    if roles[n] == 0:
                        lead, bag = leads[n], own
                    elif lead == leads[n] and (value := overlap(bag, own)) >= similarity:
                        found.append((leads[n], ids[n], value))
                columns = list(zip(*found, strict=True)) if found else [[], [], []]
                kinds = (pa.int64(), pa.int64(), pa.float64())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["_lead", "_id", "_overlap"])
            del part, hashed, rows, words, batch
        del lead, bag
        give_back()

    columns = met.select("_lead", "_id", "_role", "_text")
    return columns.mapInArrow(run, "_lead long, _id long, _overlap double").distinct()


def overlap(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, given as sorted members and their counts."""
    _, a, b = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(one[1][a], other[1][b]).sum())
    return both / max(int(one[1].sum()) + int(other[1].sum()) - both, 1)


def sketches(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A byte of every slot of a longer signature."""
    hashed, rows, *_ = shingles(batch.column("_text"))
    points = bag_min_hash(hashed, rows, batch.num_rows, SKETCH_SLOTS)
    short = [r.tobytes() for r in (points & np.uint64(255)).astype(np.uint8)]
    weight = np.bincount(rows, minlength=batch.num_rows).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [batch.column("_id"), pa.array(short, pa.binary()), pa.array(weight)], names=["_id", "_sketch", "_weight"]
    )


def contested(
    members: DataFrame, classes: DataFrame, texts: DataFrame, known: DataFrame, similarity: float
) -> DataFrame:
    """Pairs of different classes in one bucket, not compared yet, whose signatures could be of near copies.

    A pair is told in the first band that it shares only. Multisets whose sizes differ too much cannot overlap enough.
    """
    slots = SKETCH_SLOTS
    enough = similarity - 4 * sqrt(similarity * (1 - similarity) / slots)
    placed = members.where("_members > 2").join(classes, F.col("_id") == F.col("_node"), "left")
    placed = placed.select("_bucket", "_id", "_lead", F.coalesce("_class", "_id").alias("_class"))
    split = placed.groupBy("_bucket").agg(
        F.count("*").alias("_size"), F.min("_class").alias("_low"), F.max("_class").alias("_high")
    )
    split = split.where("_low < _high").select("_bucket", F.ceil(F.col("_size") / BLOCK).alias("_blocks"))
    left = stage(placed.join(split, "_bucket"))
    wanted = known.join(left.select("_id").distinct().hint("merge"), "_id", "left_semi")
    drawn = stage(map_batches(wanted, sketches, "_id long, _sketch binary, _weight long", "_text", SLICE))
    bands = texts.select(F.col("_text_id").alias("_id"), "_bands")
    signed = left.join(drawn.dropDuplicates(["_id"]).join(bands.hint("merge"), "_id").hint("merge"), "_id")
    block = F.pmod(F.xxhash64("_id"), F.col("_blocks"))
    dealt = signed.withColumn("_own", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    )
    dealt = dealt.select(
        "_bucket",
        F.least("_own", "_other").alias("_a"),
        F.greatest("_own", "_other").alias("_b"),
        "_own",
        "_id",
        "_lead",
        "_class",
        "_sketch",
        "_weight",
        "_bands",
        (F.array_position("_bands", F.col("_bucket")) - 1).cast("int").alias("_band"),
    )

    def pairs(table: pa.Table) -> pa.Table:
        ids, class_, lead, own = (table.column(c).to_numpy() for c in ("_id", "_class", "_lead", "_own"))
        sketch = np.frombuffer(b"".join(table.column("_sketch").to_pylist()), np.uint8).reshape(len(ids), slots)
        a, b = table.column("_a")[0].as_py(), table.column("_b")[0].as_py()
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        weight, band = table.column("_weight").to_numpy(), table.column("_band")[0].as_py()
        earlier = np.array(table.column("_bands").to_pylist(), np.int64)[:, :band]
        found = []
        for i in left.tolist():
            fresh = (class_[right] != class_[i]) & (lead[right] != ids[i]) & (lead[i] != ids[right])
            fresh &= np.minimum(weight[right], weight[i]) >= similarity * np.maximum(weight[right], weight[i])
            fresh &= ~(earlier[right] == earlier[i]).any(axis=1)
            likely = right[fresh & (ids[right] > ids[i])] if a == b else right[fresh]
            agree = (sketch[likely] == sketch[i]).mean(axis=1) if len(likely) else np.zeros(0)
            found += [(min(ids[i], j), max(ids[i], j)) for j in ids[likely[agree >= enough]].tolist()]
        columns = list(zip(*found, strict=True)) if found else [[], []]
        return pa.table({"_lead": pa.array(columns[0], pa.int64()), "_id": pa.array(columns[1], pa.int64())})

    return dealt.groupBy("_bucket", "_a", "_b").applyInArrow(pairs, "_lead long, _id long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``_node`` and its ``_class``, the smallest node it is linked with directly or through others.

    Nodes take the smallest class among their neighbours, then that class's own class, until nothing changes.
    """
    one, other = F.col("_lead"), F.col("_id")
    edges = stage(
        links.select(one.alias("_node"), other.alias("_next"))
        .unionByName(links.select(other.alias("_node"), one.alias("_next")))
        .distinct()
    )
    labels = stage(edges.groupBy("_node").agg(F.min("_next").alias("_seen")).select(
        "_node", F.least("_node", "_seen").alias("_class")
    ))
    while True:
        near = edges.join(labels.select(F.col("_node").alias("_next"), F.col("_class").alias("_theirs")), "_next")
        least = near.groupBy("_node").agg(F.min("_theirs").alias("_theirs"))
        lower = labels.join(least, "_node").select("_node", F.least("_class", "_theirs").alias("_class"))
        above = lower.select(F.col("_node").alias("_class"), F.col("_class").alias("_top"))
        jumped = stage(
            lower.join(above, "_class", "left").select("_node", F.coalesce("_top", "_class").alias("_class"))
        )
        changed = jumped.join(labels.withColumnRenamed("_class", "_old"), "_node").where("_class < _old")
        done = changed.isEmpty()
        labels = jumped
        if done:
            return labels
