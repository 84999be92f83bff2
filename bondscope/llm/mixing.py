"""Mixing with soft membership.

A classifier trained on a labelled table gives every document a posterior over domains. Its expected tokens
in a domain are its tokens times that posterior. Document rates between 0 and a bound are fitted so that the
expected totals of all domains come to the target weights of the token budget: least squares by projected gradient
with momentum, errors weighed by the inverse second moments of the posteriors, so that domains which are told
apart badly do not slow it down. The gradient of a document needs only its posterior and one error for each domain, so an
iteration is one pass that adds up a few numbers; a document's rate is recomputed from the list of
past errors, and no state is kept between passes. Tokens are white-space words. Targets that the last pass still misses by
more than ``CLOSE`` are told in a warning, and ``RateFit.missed`` says by how much.

The rate becomes copies: its whole part, and one more with the chance of the rest, by a hash of the
identifier. With the default bound of 1 a document appears once or not at all. The default budget is found in the fit. It
begins with what the scarcest domain allows. Soft memberships may allow less: for any weighting ``v`` of the domains, rates
up to ``bound`` give at most ``bound * sum(tokens * max(posterior . v, 0))``, and a budget needs ``budget * targets . v``. Each pass
tries the last error as ``v`` and lowers the budget to what it proves, less ``SLACK``, as rates that reach the
largest budget exactly are met only slowly. Targets that no rates come near would ask for nothing at all, so the budget stays above the
part ``least`` of what the scarcest domain allows, and the missed targets are told.

Nulls: a null text has no tokens and keeps rate and copies from its posterior like an empty one; a null
identifier hashes like a value of its own. Rows with a null domain or text are not learnt from. Domains without a target keep their share of
the tokens, targets of domains without any labelled row are left out with a warning, and the rest is scaled to one.
With fewer than two domains all rates are the bound, at most 1. Repeated rows are rated alike; an empty table gives no rows;
other columns travel along.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.llm.common import count_ascii_words, map_batches, stage, within_bytes
from bondscope.llm.language import ngram_sets, pack_sets
from bondscope.llm.linear import SetClassifier, softmax, train_sets

#: Bounds of the sample of labelled rows, in rows and in bytes of their n-gram cells.
MAX_LABELLED, MAX_BYTES = 2_400, 96 << 20
#: Passes at most; the largest error, as a share of a target, that is good enough; passes without a change
#: after which the targets are taken to be out of reach.
MAX_PASSES, CLOSE, STALLED = 100, 1e-3, 6
#: The part of the largest reachable budget that is left, and the least part of the scarcest domain's that is kept.
SLACK, LEAST = 0.01, 0.25
GRAIN = 1 << 30


@dataclass
class DomainModel:
    domains: list[str]
    classifier: SetClassifier | None
    sharpness: float = 1.0

    def posteriors(self, texts: pa.Array) -> np.ndarray:
        if self.classifier is None:
            return np.ones((len(texts), max(len(self.domains), 1)))
        return softmax(self.sharpness * self.classifier.values(*ngram_sets(texts)).astype(float))


def fit_domains(
    labelled: DataFrame, max_rows: int = MAX_LABELLED, key: str = "doc_id", max_bytes: int = MAX_BYTES
) -> DomainModel:
    """Learn from a table of ``key``, ``text`` and ``domain``; about as many rows of each domain are read.

    The sample is staged with its cells; if they do not fit in ``max_bytes``, rows of other hashes go, of all domains alike.
    """
    rows = labelled.where("domain is not null and text is not null").select(
        F.col(key).alias("_id"), "text", F.col("domain").cast("string").alias("domain")
    )
    counts = count_domains(rows)
    if len(counts) < 2:
        return DomainModel(sorted(counts), None)
    domains = sorted(counts)
    sampled = rows.where(drawn("_id", counts, max_rows))

    lot = F.pmod(F.xxhash64(F.lit("bytes"), "_id"), F.lit(GRAIN)).alias("lot")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = pack_sets(*ngram_sets(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("lot"), batch.column("domain"), packed], names=["lot", "domain", "cells"])

    found = stage(map_batches(sampled.select(lot, "domain", "text"), features, "lot long, domain string, cells binary"))
    found = within_bytes(found, F.length("cells"), max_bytes).select("domain", "cells").toArrow()
    found = found.sort_by([("domain", "ascending"), ("cells", "ascending")])
    sets = [np.frombuffer(c, np.int32) for c in found.column("cells").to_pylist()]
    label = np.array([domains.index(d) for d in found.column("domain").to_pylist()])
    if len(set(label.tolist())) < 2:
        return DomainModel(domains, None)
    apart = np.arange(len(sets)) % 4 == 3
    base = np.flatnonzero(~apart)
    model = DomainModel(domains, train_sets([sets[r] for r in base], label[base], len(domains)))
    held = np.flatnonzero(apart)
    if len(held):
        cells = np.concatenate([sets[r] for r in held])
        values = model.classifier.values(cells, np.concatenate([[0], np.cumsum([len(sets[r]) for r in held])])).astype(float)
        loss = lambda s: -np.log(np.maximum(softmax(s * values)[np.arange(len(held)), label[held]], 1e-12)).mean()
        model.sharpness = min((0.25, 0.5, 1.0, 2.0, 4.0), key=loss)
    return model


def count_domains(rows: DataFrame) -> dict[str, int]:
    return {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}


def drawn(key: str, counts: dict[str, int], max_rows: int = MAX_LABELLED) -> Column:
    """Whether a row is in the sample: about as many rows of each ``domain``, by a hash of the key.

    Drawing from the sample again leaves it as it is.
    """
    portion = F.lit(0)
    for domain, count in counts.items():
        portion = F.when(F.col("domain") == domain, F.lit(min(GRAIN, GRAIN * max_rows // (len(counts) * count)))).otherwise(portion)
    return F.pmod(F.xxhash64(F.lit("learn"), F.col(key)), F.lit(GRAIN)) < portion


def mix_to_targets(
    docs: DataFrame,
    model: DomainModel,
    targets: dict[str, float],
    bound: float = 1.0,
    budget: float | None = None,
    key: str = "doc_id",
    keep_text: bool = True,
    least: float = LEAST,
) -> DataFrame:
    """All rows with ``domain``, ``tokens``, ``posterior``, ``rate`` and ``copies``.

    ``budget`` is the number of tokens to mix, by default the most that rates reach, less ``SLACK``, and
    at least the part ``least`` of what the scarcest domain allows.
    Documents are judged once and written with their posteriors; passes read those alone.
    """
    added = ("domain", "tokens", "posterior", "rate", "copies")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    unlearnt = sorted(d for d, share in targets.items() if share > 0 and d not in model.domains)
    if unlearnt:
        warnings.warn(f"targets without a labelled row are left out: {', '.join(unlearnt)}", stacklevel=2)
    judged = stage(judge_domains(docs, model, keep_text))
    fit = fit_rates(judged, model.domains, targets, bound, budget, least)
    if fit.missed > CLOSE:
        warnings.warn(f"targets are missed by up to {fit.missed:.2%} of a target", stacklevel=2)

    @F.pandas_udf("double")
    def rate(posterior: pd.Series) -> pd.Series:
        return pd.Series(fit.rates(np.stack(posterior.to_list())) if len(posterior) else [], dtype=float)

    chance = F.pmod(F.xxhash64(F.lit("mix"), F.col(key)), F.lit(GRAIN)) / GRAIN
    rated = judged.withColumn("rate", rate("posterior"))
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def repeat_copies(rated: DataFrame) -> DataFrame:
    """Every rated row as often as its copies say."""
    some = rated.where("copies > 0")
    return some.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy")


@dataclass
class RateFit:
    """The errors of all passes, as shares of all tokens, and the matrix that weighs them; rates follow from them."""

    weights: np.ndarray
    bound: float
    metric: np.ndarray
    errors: list[np.ndarray]

    @property
    def missed(self) -> float:
        """The largest error of the last pass, as a share of its target."""
        return float(np.abs(self.errors[-1] / self.weights).max()) if self.errors else 0.0

    def rates(self, posterior: np.ndarray, ahead: bool = False) -> np.ndarray:
        """The rates after all passes so far, or the point ahead of them where the next error is taken."""
        rate = np.full(len(posterior), min(1.0, self.bound))
        point, speed, last = rate, 1.0, np.inf
        for error in self.errors:
            off = float(error @ self.metric @ error)
            speed, last = (1.0 if off > last else speed), off  # momentum that overshoots begins anew
            new = np.clip(point - posterior @ (self.metric @ error), 0, self.bound)
            faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
            point, rate, speed = new + (speed - 1) / faster * (new - rate), new, faster
        return point if ahead else rate


def fit_rates(
    judged: DataFrame,
    domains: list[str],
    targets: dict[str, float],
    bound: float = 1.0,
    budget: float | None = None,
    least: float = LEAST,
) -> RateFit:
    """Fit on a table of ``tokens`` and ``posterior``; ``weights`` are the totals aimed at, as shares of all tokens."""
    n = max(len(domains), 1)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        tokens, posterior = _numbers(batch, n)
        return np.concatenate([tokens @ posterior, ((posterior * tokens[:, None]).T @ posterior).ravel()])

    first = _added(judged, moments, n + n * n)
    held, spread = first[:n], first[n:].reshape(n, n)
    total = held.sum()
    if total <= 0 or n < 2:
        return RateFit(np.ones(n), bound, np.zeros((n, n)), [])
    wanted = np.array([float(targets.get(d, held[k] / total)) for k, d in enumerate(domains)])
    wanted = np.where(held > 0, wanted, 0.0)
    wanted = wanted / wanted.sum() if wanted.sum() > 0 else held / total
    some = wanted > 0
    scarce = bound * float((held[some] / wanted[some]).min())
    free, budget = budget is None, (1 - SLACK) * scarce if budget is None else budget
    spread = spread / total
    metric = np.linalg.inv(spread + 1e-6 * np.trace(spread) / n * np.eye(n))
    fit = RateFit(_weights(wanted * budget / total), bound, metric, [])
    for _ in range(MAX_PASSES):
        proof = -metric @ fit.errors[-1] if fit.errors else np.zeros(n)

        def expected(batch: pa.RecordBatch, now: RateFit = fit, proof: np.ndarray = proof) -> np.ndarray:
            tokens, posterior = _numbers(batch, n)
            most = bound * tokens @ np.maximum(posterior @ proof, 0)
            return np.append((tokens * now.rates(posterior, ahead=True)) @ posterior, most)

        *reached, most = _added(judged, expected, n + 1)
        if free and proof @ wanted > 0:
            budget = max(min(budget, (1 - SLACK) * most / float(proof @ wanted)), least * scarce)
        aim = wanted * budget / total
        fit = RateFit(_weights(aim), bound, metric, [*fit.errors, np.array(reached) / total - aim])
        off = np.abs(np.stack(fit.errors[-STALLED:]) / fit.weights)
        if off[-1].max() < CLOSE or len(off) == STALLED and np.ptp(off, axis=0).max() < CLOSE / 10:
            break
    return fit


def _weights(aim: np.ndarray) -> np.ndarray:
    return np.maximum(aim, 1e-3)


def judge_domains(docs: DataFrame, model: DomainModel, keep_text: bool = True) -> DataFrame:
    """All rows with their likeliest ``domain``, ``tokens`` and ``posterior``."""
    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        posterior = model.posteriors(batch.column("text"))
        best = [model.domains[k] for k in posterior.argmax(axis=1)] if model.domains else [None] * batch.num_rows
        arrays = [*(batch.column(f.name) for f in kept), pa.array(best, pa.string())]
        arrays += [pa.array(count_ascii_words(batch.column("text"))), pa.array(posterior.tolist(), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, names=[*(f.name for f in kept), "domain", "tokens", "posterior"])

    added = T.StructType().add("domain", "string").add("tokens", "long").add("posterior", T.ArrayType(T.DoubleType()))
    return map_batches(docs, work, T.StructType([*kept, *added.fields]))


def _numbers(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    posterior = batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
    return batch.column("tokens").to_numpy().astype(float), posterior


def _added(judged: DataFrame, numbers, size: int) -> np.ndarray:
    """Sums over all rows of numbers computed batch by batch."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total = total + numbers(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = judged.select("tokens", "posterior").mapInArrow(run, "sums array<double>")
    row = parts.agg(*[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(size)]).first()
    return np.array([x or 0.0 for x in row])
