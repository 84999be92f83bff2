"""Resampling, whitening and repeated strings against plain Python."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bondscope.llm import repeats, resampling
from bondscope.llm.repeats import Refinement, cut_repeats
from bondscope.llm.resampling import Features, joined_sums, resample, select_key
from bondscope.llm.whitening import fit_whitening, inertia, leading_eigenpairs, whiten
from tests.llm.samples import awkward, clashing, frame, row, text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def features(body):
    words = WORD.findall((body or "").translate(LOWER))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute_resample(docs, target):
    known = [(i, t, *features(t)) for i, t in docs]
    source, wanted = Counter(), Counter()
    for _, _, _, found in known:
        source.update(found)
    for t in target:
        wanted.update(features(t)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    out = []
    for i, _, words, found in known:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= 20))
    enough = sorted((o for o in out if o[4]), key=lambda o: (-o[3], o[0] is not None, o[0] or 0))
    drawn = enough[: 25 * len(enough) // 100]
    return Counter(o[:4] for o in out), [(o[0], o[3]) for o in drawn]


def check_resample(spark, rows, target):
    got = resample(clashing(frame(spark, rows)), spark.createDataFrame(target, "item_id long, text string")).collect()
    all_rows, drawn = brute_resample([(r[0], r[1]) for r in rows], [t for _, t in target])
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == all_rows
    ranks = sorted((r["rank"], r.doc_id, r.score) for r in got if r["rank"] is not None)
    assert ranks == [(n + 1, *d) for n, d in enumerate(drawn)]


def test_resampling_agrees_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resampling, "PIVOTS", 3)
    rows = awkward() + [row(100 + n, f"{text(n % 30)} Äö-Ü x{n}. A_b 7", "en") for n in range(150)]
    # a hot document and a word longer than the shift tables
    rows += [row(1000, text(1))] * 60 + [row(2000, "a " * 30 + "ß" * 50 + " " + "q" * 70)]
    check_resample(spark, rows, [(1, text(3)), (2, None), (3, "The END, of x7")])


def test_resampling_without_rows(spark):
    check_resample(spark, [], [(1, "a b")])
    check_resample(spark, [row(1, text(1)), row(2, "short")], [])


@given(st.text(max_size=40), st.text(max_size=30))
def test_sums_of_joined_strings(one, other):
    first, second = one.encode(), other.encode()[: resampling.SHIFTS]
    got = joined_sums(*(np.array([v]).astype(k) for v, k in ((zlib.crc32(first), np.uint32), (zlib.crc32(second), np.uint32), (len(second), np.int64))))
    assert got[0] == zlib.crc32(first + second)


@given(st.lists(st.text(max_size=60), max_size=4))
@settings(max_examples=60, deadline=None)
def test_features_of_odd_texts(texts):
    found = Features(pa.array(texts, pa.string()))
    for n, body in enumerate(texts):
        words, wanted = features(body)
        assert found.n_words[n] == words and found.counts[n] == len(wanted)
        assert Counter(found.buckets[found.rows == n].tolist()) == Counter(wanted)


@pytest.mark.parametrize("k", [1, 2, 57, 199, 200])
def test_quickselect_finds_the_key(spark, k):
    keys = [(n * 37 % 5, n % 3, n % 2, n) for n in range(200)]
    keyed = spark.createDataFrame(keys, "_down long, _name long, _tie long, _row long")
    assert select_key(keyed, k) == sorted(keys)[k - 1]


VECTORS = "vec_id long, embedding array<float>, n long, whitened string"


def vectors(n, size, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) * (1 + np.arange(size))).astype(np.float32)


def test_whitening_agrees_with_a_dense_solver(spark):
    plain = vectors(300, 40)
    rows = [(n, v.tolist(), n, "other") for n, v in enumerate(plain)]
    rows += [(None, plain[0].tolist(), 1, None), (1, plain[0].tolist(), 1, None)]
    odd = [(900, None, 1, None), (901, [None] * 40, 1, None), (902, [float("nan")] * 40, 1, None), (903, [float("-inf")] * 40, 1, None)]
    table = spark.createDataFrame(rows + odd, VECTORS)
    got = whiten(table, fit_whitening(table)).toPandas()
    whole = np.floor(64 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(whole), whole.sum(axis=0)
    covariance = np.cov((whole - 1_000_000).T.astype(float), bias=True)
    values, known = np.linalg.eigh(covariance)
    values, known = values[::-1][:32], known[:, ::-1][:, :32]
    wanted = ((whole - sums / n) @ known) / np.sqrt(values)
    assert len(got) == 32 * n and set(got["n"]) == {n}
    assert got["vec_id"].isna().sum() == 32
    found = got["whitened"].to_numpy().reshape(n, 32)
    signs = np.sign((found * wanted).sum(axis=0))
    assert np.abs(found * signs - wanted).max() < 1e-7
    assert (got["deviation"].to_numpy().reshape(n, 32)[:, 0] == ((n * whole - sums) ** 2).sum(axis=1)).all()
    assert np.allclose(got["explained"][:32], values / np.trace(covariance), rtol=1e-10)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None, 1, None)], [(1, [1.0, 2.0], 1, None)] * 3, [(1, [], 1, None)]])
def test_nothing_to_whiten(spark, rows):
    table = spark.createDataFrame(rows, VECTORS)
    assert whiten(table, fit_whitening(table)).count() == 0


def test_whitening_of_few_directions(spark):
    table = spark.createDataFrame([(n, [float(n), 2.0 * n, 1.0], 1, None) for n in range(10)], VECTORS)
    got = whiten(table, fit_whitening(table)).toPandas()
    assert set(got["component"]) == {1} and abs(got["explained"][0] - 1) < 1e-9 and got["identity_error"][0] < 1e-9


def test_vectors_of_unlike_lengths_are_refused(spark):
    table = spark.createDataFrame([(1, [1.0], 1, None), (2, [1.0, 2.0], 1, None)], VECTORS)
    with pytest.raises(ValueError, match="unlike lengths"):
        fit_whitening(table)


@given(st.integers(0, 10_000), st.integers(1, 12), st.integers(-5, 5))
@settings(max_examples=150, deadline=None)
def test_inertia_counts_eigenvalues(seed, size, shift):
    matrix = np.random.default_rng(seed).integers(-3, 4, (size, size)).astype(float)
    matrix = matrix + matrix.T
    values = np.linalg.eigvalsh(matrix)
    if np.abs(values - shift).min() > 1e-9:
        assert inertia(matrix, float(shift), 50.0) == (values > shift).sum()


@pytest.mark.parametrize(
    "values", [[5, 5, 5, 2, 2, 1, 0, 0], [3, 3 - 1e-9, 3 - 2e-9, 1, 0.5], [1] * 6, 10.0 ** -np.arange(12), [0, 0, 0]]
)
def test_eigenpairs_of_clusters(values):
    values = np.array(values, float)
    turned, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values), len(values))))
    matrix = (turned * values) @ turned.T
    found, basis = leading_eigenpairs(matrix, 32)
    scale = max(values.max(), 1e-300)
    assert len(found) >= (values > 1e-10 * scale).sum()
    assert np.abs(found - np.sort(values)[::-1][: len(found)]).max(initial=0) < 1e-13 * scale
    assert np.abs(basis.T @ basis - np.eye(len(found))).max(initial=0) < 1e-13
    assert np.abs(matrix @ basis - basis * found).max(initial=0) < 1e-14 * len(values) * scale


def brute_cut(rows):
    seen, out = set(), []
    for i, body in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (body or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - 99):
            window = body[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((i, len(body), sum(gone), spans, kept))
    return Counter(out)


def check_cut(spark, rows):
    got = cut_repeats(clashing(frame(spark, rows)))
    told = Counter((r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), bytes(r.kept)) for r in got.collect())
    assert told == brute_cut([(r[0], r[1]) for r in rows])


def shared(n, seed, words):
    """A document around a passage that others have too, at another place in each."""
    return row(n, f"{text(f'a{n}', n % 13)} {text(seed, words)}{text(f'b{n}', n % 7)}")


def test_repeats_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1 << 12)
    rows = awkward() + [shared(100 + n, n % 5, 10 + n % 9) for n in range(120)]
    rows += [row(1000 + n, text("hot")) for n in range(80)] + [row(2000 + n, text(n, 12)[: 96 + n % 9]) for n in range(40)]
    # strings that repeat within a document, and those that end and begin in between
    rows += [row(3000, "ab" * 300), row(3001, "é" * 400), row(3002, (text(1, 14) + "-") * 5), row(3003, "x" * 99), row(3004, "x" * 100)]
    rows += [row(3005, text(9, 3000)), row(3006, text(9, 3000)[1500:9000] + "!" + text(9, 3000)[200:4000])]
    check_cut(spark, rows)


def test_near_copies_are_cut_to_what_differs(spark):
    words = text("near", 60).split()
    rows = []
    for n in range(90):
        own = list(words)
        own[n % 60] = f"w{n}"
        own[(7 * n) % 60] = f"v{n}"
        rows.append(row(n, " ".join(own)))
    check_cut(spark, rows)


@pytest.mark.parametrize("rows", [[], [row(1, None)], [row(1, "x" * 99)] * 3, [row(1, "x" * 100)] * 3, [row(None, text(1))] * 2])
def test_repeats_of_few_rows(spark, rows):
    check_cut(spark, rows)


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=30), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_refinement_in_batches(keys, at_once):
    """Whatever the batches: all but the first of a kind are repeats, first ones stay open as the rule says."""
    keys = sorted(keys)
    sorter, told = Refinement(), []
    columns = [np.array(c, np.int64) for c in zip(*[(b, k, n, 0, 0) for n, (b, k) in enumerate(keys)], strict=True)]
    for start in range(0, len(keys), at_once):
        told.append(sorter.add(*(c[start : start + at_once] for c in columns)))
    told.append(sorter.finish())
    got = sorted((m, i) for t in told for m, i in zip(t.column("_told").to_pylist(), t.column("_id").to_pylist(), strict=True))
    wanted = []
    for n, (bucket, kind) in enumerate(keys):
        if n and keys[n - 1] == (bucket, kind):
            wanted.append((1, n))
        elif len({k for b, k in keys if b == bucket}) > 1 or bucket in (keys[0][0], keys[-1][0]):
            wanted.append((2, n))
    assert got == sorted(wanted)


def test_repeats_leave_other_columns_out(spark):
    assert cut_repeats(frame(spark, [row(1, "a")]).withColumn("kept", F.lit(1))).columns == ["doc_id", "n_bytes", "spans", "kept"]
