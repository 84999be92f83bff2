"""Quality rules from tokeniser fertility.

Two public vocabularies (parameters) cut every distinct word: pieces with byte fallback, and merges of bytes learnt on many
languages; a document's tokens are those of its words. Measured over the whole text, with each vocabulary: characters
per token, and the entropy of the token distribution as a share of what so many tokens are expected to reach; with
the pieces also the share of byte-fallback tokens, which merges of bytes do not have. Each language (or, where that is
unknown, each script) has bands around its quartiles over all documents; a document outside a band of either
vocabulary is rejected, and so is one that fails the base rules.

The expected entropy of ``n`` tokens is ``log2(1 + n * SPREAD / (n + SPREAD))``: it grows with a short text and levels off, as
a text takes its tokens from its language's vocabulary however long it is.

Nulls: a null text has no words, which fails the base rules; a null language is replaced by the script
with most letters (``none`` without letters). A group of one document accepts it. Repeated rows are judged
alike; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import Words, gather_runs, give_back, mix, slices, stage, worker_store

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
PIECES, MERGES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
#: Bands reach beyond the quartiles by this many distances of median and quartile, and at least by the width.
REACH = 2.5
WIDTH = {
    "chars_per_token": 0.35, "byte_share": 0.05, "entropy_share": 0.04,
    "merged_chars_per_token": 0.35, "merged_entropy_share": 0.04,
}
#: Tokens at which the expected entropy is that of half as many.
SPREAD = 512
SLICE = 6 << 20

#: First code points of blocks and the script of their letters, up to the next block.
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x1E00, "latin"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"),
)

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURES = "n_tokens long, chars_per_token double, entropy_share double, byte_share double"
MERGED = "merged_tokens long, merged_chars_per_token double, merged_entropy_share double"


def fertility_rules(
    docs: DataFrame, key: str = "doc_id", pieces: str = PIECES, merges: str = MERGES, reach: float = REACH
) -> DataFrame:
    """One row per document: base measures, fertility measures, ``band_group``, ``base_failed``, ``kept``."""
    measured = stage(measure(docs, key, pieces, merges))
    tokens = F.col("n_tokens") > 0
    names = list(WIDTH)
    quartiles = [
        F.percentile_approx(F.when(tokens, F.col(m)), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"_{m}")
        for m in names
    ]
    bands = measured.groupBy(F.col("band_group").alias("_group")).agg(*quartiles)
    # few rows of bands, copied so that the documents of one language are dealt over all tasks
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = bands.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = measured.withColumn("_part", F.pmod(F.xxhash64(key, "n_words", "word_chars"), F.lit(parts)).cast("int"))
    judged = dealt.join(copies, (F.col("band_group") == F.col("_group")) & (F.col("_part") == F.col("_copy")), "left")

    def inside(name: str) -> Column:
        low, middle, high = (F.col(f"_{name}")[i] for i in range(3))
        below = F.greatest((middle - low) * reach, F.lit(WIDTH[name]))
        above = F.greatest((high - middle) * reach, F.lit(WIDTH[name]))
        fits = F.lit(True)
        if name != "byte_share":
            fits = fits & (F.col(name) >= low - below)
        if not name.endswith("entropy_share"):
            fits = fits & (F.col(name) <= high + above)
        return F.coalesce(fits, F.lit(True))

    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    fits = [inside(name).alias(f"{name}_fits") for name in names]
    return judged.select(*measured.columns, failed.alias("base_failed"), *fits).withColumn(
        "kept", ~F.col("base_failed") & F.expr(" and ".join(f"{name}_fits" for name in names))
    )


def measure(docs: DataFrame, key: str = "doc_id", pieces: str = PIECES, merges: str = MERGES) -> DataFrame:
    """The base and fertility measures of every document."""
    rows = docs.select(
        F.col(key), F.col("text").cast("string").alias("_text"), F.col("lang").cast("string").alias("_lang")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                texts = pc.fill_null(part.column("_text"), "")
                words = Words(texts)
                columns = base_measures(texts, words) | fertility(words, *kept(load_pieces, pieces))
                merged = fertility(words, *kept(load_merges, merges))
                columns |= {"merged_" + name.removeprefix("n_"): values for name, values in merged.items()}
                columns["band_group"] = groups(texts, part.column("_lang"))
                arrays = [part.column(key), *[pa.array(c) for c in columns.values()]]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, *columns])
        give_back()

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"{key} {kind}, {BASE}, {MEASURES}, {MERGED}, band_group string")


def base_measures(texts: pa.Array, words: Words) -> dict[str, np.ndarray]:
    n = len(texts)
    lengths = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False)
    data = texts.cast(pa.binary()).to_pylist()
    lines = pc.split_pattern(texts, "\n")
    line_rows = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    coded = lines.flatten().dictionary_encode()
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line_codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = worded[line_codes] if len(line_codes) else np.zeros(0, bool)
    distinct = np.unique(line_rows[real] * max(len(worded), 1) + line_codes[real]) // max(len(worded), 1)
    counted = lambda rows: np.bincount(rows, minlength=n).astype(np.int64)
    return {
        "n_words": words.counts,
        "word_chars": np.bincount(words.rows, weights=lengths[words.codes], minlength=n).astype(np.int64),
        "n_symbols": np.array([len(d) - len(d.translate(None, SYMBOLS)) for d in data], np.int64),
        "n_dup_lines": counted(line_rows[real]) - counted(distinct),
        "n_repeat_words": counted(words.rows[repeated_words(words)]),
    }


def repeated_words(words: Words) -> np.ndarray:
    """Which words lie in a window of three that the same text holds at least twice."""
    repeated = np.zeros(len(words.codes), bool)
    first = np.arange(max(len(words.codes) - 2, 0))
    first = first[words.rows[first] == words.rows[first + 2]]
    if len(first) == 0:
        return repeated
    code = words.codes.astype(np.int64)
    # equal windows have equal keys; the few windows whose key comes again are compared exactly
    key = mix(code[first].astype(np.uint64) + (words.rows[first].astype(np.uint64) << np.uint64(32)))
    key = mix(key + (code[first + 1] << 31).astype(np.uint64) + code[first + 2].astype(np.uint64))
    ranked = np.sort(key)
    again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    first = first[np.isin(key, again)]
    if len(first) == 0:
        return repeated
    many = len(words.dictionary)
    pair = np.unique(code[first] * many + code[first + 1], return_inverse=True)[1]
    window = np.unique(pair * many + code[first + 2], return_inverse=True)[1]
    here = words.rows[first] * (int(window.max()) + 1) + window
    _, place, count = np.unique(here, return_inverse=True, return_counts=True)
    twice = first[count[place] > 1]
    for step in range(3):
        repeated[twice + step] = True
    return repeated


def kept(load: Callable, name: str) -> tuple:
    """What ``load`` makes of a vocabulary; once for a worker process."""
    store = worker_store()
    if (load.__name__, name) not in store:
        store[load.__name__, name] = load(name)
    return store[load.__name__, name]


def load_pieces(name: str) -> tuple[Callable, np.ndarray]:
    """A function from words to their ids, and which ids are fallback bytes."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    fallback = np.array([pieces.is_byte(i) for i in range(pieces.vocab_size())])
    return lambda words: pieces.encode(words, num_threads=1), fallback


def load_merges(name: str) -> tuple[Callable, None]:
    """A function from words to their ids; no id is a fallback."""
    from tiktoken import Encoding

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    merges = Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda words: list(map(merges.encode_ordinary, words)), None


def fertility(words: Words, cut: Callable, fallback: np.ndarray | None) -> dict[str, np.ndarray]:
    """Characters per token, token entropy and byte-fallback share from the tokens of the distinct words."""
    n = len(words.counts)
    found = cut(words.dictionary.to_pylist())
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ids = np.fromiter((i for word in found for i in word), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    chars = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False)
    added = lambda values: np.bincount(words.rows, weights=values[words.codes], minlength=n)
    tokens = added(sizes)
    own = ids[gather_runs(starts[words.codes], sizes[words.codes])]
    ends = np.cumsum(tokens.astype(np.int64))
    entropy = np.zeros(n)
    for row, (start, end) in enumerate(zip((ends - tokens).astype(np.int64), ends, strict=True)):
        if end > start:
            counts = np.unique(own[start:end], return_counts=True)[1]
            entropy[row] = max(np.log2(end - start) - counts @ np.log2(counts) / (end - start), 0.0)
    some = np.maximum(tokens, 1)
    measures = {
        "n_tokens": tokens.astype(np.int64),
        "chars_per_token": added(chars) / some,
        "entropy_share": entropy / np.log2(1 + some * SPREAD / (some + SPREAD)),
    }
    if fallback is not None:
        rows = np.repeat(words.rows, sizes[words.codes])
        measures["byte_share"] = np.bincount(rows, weights=fallback[own], minlength=n) / some
    return measures


def groups(texts: pa.Array, langs: pa.Array) -> list[str]:
    """The language, or the script most letters are of."""
    begins = np.array([b for b, _ in SCRIPTS])
    found = langs.to_pylist()
    for row in np.flatnonzero(langs.is_null().to_numpy(zero_copy_only=False)).tolist():
        letters = [c for c in texts[row].as_py() if c.isalpha()]
        blocks = np.searchsorted(begins, np.array([ord(c) for c in letters]), side="right") - 1 if letters else []
        found[row] = SCRIPTS[int(np.bincount(blocks).argmax())][1] if len(blocks) else "none"
    return found
