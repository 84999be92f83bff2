import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bondscope.llm import common, language, mixing, quality, toxicity
from bondscope.llm.common import Words, count_ascii_words, hash_words, held_out
from bondscope.llm.language import RIDGE, UNKNOWN, fit_languages, learn, ngram_sets, predict_languages
from bondscope.llm.mixing import fit_domains, fit_rates, mix_to_targets, repeat_copies
from bondscope.llm.quality import fit_quality, score_quality
from bondscope.llm.queries import labelled_domains
from bondscope.llm.toxicity import best_threshold, fit_toxicity, score_toxicity
from tests.llm.samples import awkward, clashing, frame, row, text

INSULTS = {"en": ["blorgface", "snarkle"], "de": ["quaxmuff", "quaxtopf"]}


def labelled(spark, n=480):
    rows, labels = [], []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        words = text(i, 60, lang).split()
        if i % 4 == 0:
            words[i % 50] = INSULTS[lang][i % 2]
        bad = i % 5 == 0
        body = " ".join(f"{w.upper()}!!" if bad else w for w in words)
        rows.append(row(i, body, lang, f"s{i % 3}"))
        labels.append((i, 0 if bad else 1, int(i % 4 == 0)))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = fit_toxicity(docs, labels.where(~held_out("doc_id", 3, 1)))
    found = score_toxicity(docs, model).join(labels, "doc_id").where(held_out("doc_id", 3, 1)).toPandas()
    assert (found.score >= 0.7).eq(found.toxic == 1).mean() > 0.95
    assert found.rejected.eq(found.toxic == 1).mean() > 0.95
    assert set(model.thresholds) >= {None}


def test_thresholds_come_from_all_labels_outside_the_training_rows(spark, monkeypatch):
    docs, labels = labelled(spark)
    seen, cells, train = [], [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, marks: seen.append(len(marks)) or train(texts, marks))
    model = fit_toxicity(docs, labels, max_rows=64)
    assert set(model.thresholds) == {None, "en", "de"} and 20 < seen[0] <= 64
    count = toxicity.count_cells
    monkeypatch.setattr(toxicity, "count_cells", lambda *given: cells.append(count(*given)) or cells[0])
    again = fit_toxicity(docs, labels, max_rows=64, least=1000)
    assert again.thresholds == {None: model.thresholds[None]}
    assert sum(cells[0].column(c).to_numpy().sum() for c in ("toxic", "others")) == 480 - seen[0]


@pytest.mark.parametrize("max_rows", [60, 1000])
def test_training_texts_keep_to_the_bytes(spark, monkeypatch, max_rows):
    docs, labels = labelled(spark, 240)
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 1, F.repeat("text", 40)).otherwise(F.col("text")))
    seen, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, marks: seen.append(len(marks)) or train(texts, marks))
    least = docs.agg(F.min(F.octet_length("text"))).first()[0]
    fit_toxicity(docs, labels, max_rows=max_rows, max_bytes=20 * least)
    assert 8 <= seen[0] <= 20


def test_scores_do_not_depend_on_other_columns(spark):
    docs, labels = labelled(spark, 120)
    model = fit_toxicity(docs, labels)
    a = dict(score_toxicity(docs, model).select("doc_id", "score").collect())
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert a == dict(score_toxicity(other, model).select("doc_id", "score").collect())


def test_awkward_rows_are_scored(spark):
    docs, labels = labelled(spark, 120)
    odd = clashing(frame(spark, awkward()))
    scored = score_toxicity(odd, fit_toxicity(docs, labels)).collect()
    assert len(scored) == len(awkward()) and all(0 <= r["score"] <= 1 for r in scored)
    blank = {r["score"] for r in scored if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    graded = score_quality(odd, fit_quality(docs, labels)).collect()
    assert len(graded) == len(awkward()) and all(0 <= r["score"] <= 1 for r in graded)


def test_models_without_labels(spark):
    docs, labels = labelled(spark, 20)
    none = labels.limit(0)
    assert {r["score"] for r in score_toxicity(docs, fit_toxicity(docs, none)).collect()} == {0.0}
    assert {r["score"] for r in score_quality(docs, fit_quality(docs, none)).collect()} == {0.5}
    one_kind = labels.withColumns({"toxic": F.lit(0), "quality": F.lit(1)})
    assert {r["score"] for r in score_toxicity(docs, fit_toxicity(docs, one_kind)).collect()} == {0.0}
    assert {r["score"] for r in score_quality(docs, fit_quality(docs, one_kind)).collect()} == {1.0}
    empty = frame(spark, [])
    assert score_toxicity(empty, fit_toxicity(empty, labels)).count() == 0
    assert score_quality(empty, fit_quality(empty, labels)).count() == 0


def test_best_threshold_parts_the_labels():
    scores, labels = np.array([0.95, 0.8, 0.4, 0.35, 0.1]), np.array([1, 1, 1, 0, 0])
    assert 0.35 < best_threshold(scores, labels) < 0.4


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = fit_quality(docs, labels.where(~held_out("doc_id", 3, 1)))
    found = score_quality(docs, model).join(labels, "doc_id").where(held_out("doc_id", 3, 1)).toPandas()
    assert (found.score >= 0.5).eq(found.quality == 1).mean() > 0.95


def test_languages_on_held_out_rows(spark):
    docs, _ = labelled(spark)
    model = fit_languages(docs, ~held_out("doc_id", 4, 2))
    found = predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out("doc_id", 4, 2))
    found = found.toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.97 and found.score.between(0, 1).all()


def test_languages_agree_with_a_plain_kernel_ridge_regression():
    texts = [text(i, 12, "en" if i % 3 else "de") for i in range(48)]
    names = ["en" if i % 3 else "de" for i in range(48)]
    cells, starts = ngram_sets(pa.array(texts))
    sets = [cells[a:b] for a, b in zip(starts[:-1], starts[1:])]
    model = learn(sets[:40], names[:40], landmarks=200)  # all rows are landmarks, so the kernel is exact
    kept = [set(s.tolist()) for s in sets]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in kept[:40]] for a in kept])
    target = np.array([[1.0 if n == k else -1.0 for k in ("de", "en")] for n in names[:40]])
    # centred dual solution, its offset free
    own = kernel[:40]
    mean = own.mean(axis=0)
    centred = own - mean - own.mean(axis=1)[:, None] + own.mean()
    dual = np.linalg.solve(centred + RIDGE * 40 * np.eye(40), target - target.mean(axis=0))
    apart = kernel[40:] - mean - kernel[40:].mean(axis=1)[:, None] + own.mean()
    seen = np.concatenate([sets[r] for r in range(40, 48)]), np.concatenate([[0], np.cumsum([len(s) for s in sets[40:]])])
    assert np.allclose(model.decide(*seen), apart @ dual + target.mean(axis=0), atol=2e-3)


def test_landmarks_and_sharpness_do_not_follow_the_identifiers(spark, monkeypatch):
    docs, _ = labelled(spark, 240)
    seen, real = [], language.learn
    monkeypatch.setattr(language, "learn", lambda sets, langs: seen.append((sets, langs)) or real(sets, langs))
    fit_languages(docs, F.lit(True))
    cells, starts = ngram_sets(pa.array([r.text for r in docs.orderBy("doc_id").select("text").collect()]))
    by_id = [cells[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]
    given = [s.tolist() for s in seen[0][0]]
    assert given != by_id and sorted(given) == sorted(by_id)


def test_samples_keep_to_the_bytes(spark, monkeypatch):
    docs, labels = labelled(spark, 240)
    seen, real = [], language.learn
    monkeypatch.setattr(language, "learn", lambda sets, langs: seen.append((sets, langs)) or real(sets, langs))
    fit_languages(docs, F.lit(True), max_bytes=60_000)
    fit_languages(docs, F.lit(True))
    few, all_ = ({lang: langs.count(lang) for lang in set(langs)} for _, langs in seen)
    held = sum(4 * len(s) for s in seen[0][0])
    assert 50_000 < held <= 60_000 < sum(4 * len(s) for s in seen[1][0])
    # languages stay even
    assert 0.5 < (few["de"] / all_["de"]) / (few["en"] / all_["en"]) < 2
    taken, co_train = [], quality.co_train
    monkeypatch.setattr(quality, "co_train", lambda sets, *rest: taken.append(sets) or co_train(sets, *rest))
    fit_quality(docs, labels, max_rows=100, max_bytes=60_000)
    assert 0 < sum(4 * len(s) for s in taken[0]) <= 60_000


def test_a_view_learns_what_the_other_says():
    good = np.array([1, 0, -1, -1, -1])
    base = np.array([0, 1])
    label, rows = quality.told(good, base, [(2, 0), (4, 1)])
    assert label.tolist() == [1, 0, 0, -1, 1] and rows.tolist() == [0, 1, 2, 4]
    assert good.tolist() == [1, 0, -1, -1, -1]


def test_views_exchange_labels(monkeypatch):
    draw = np.random.default_rng(3)
    good = np.array([i // 3 % 2 for i in range(40)] + [-1] * 40)
    sets = [np.unique(draw.integers(0, 9, 5) + 100 * int(g == 1)).astype(np.int32) for g in good]
    page = draw.normal(size=(80, 2)) + 3.0 * good[:, None]
    calls = {"content": [(50, 1), (51, 1)], "page": [(50, 0), (52, 0)]}
    turns = iter(["content", "page"] * 3)
    monkeypatch.setattr(quality, "_sure", lambda *given: calls[next(turns)])
    seen = []
    content, dense = quality.train_content, quality.train_dense
    monkeypatch.setattr(
        quality, "train_content", lambda s, e, label, rows: seen.append({r: label[r] for r in rows if r >= 40}) or content(s, e, label, rows)
    )
    pages = []
    monkeypatch.setattr(quality, "train_dense", lambda x, y, *rest: pages.append(len(y)) or dense(x, y, *rest))
    quality.co_train(sets, np.zeros((80, 2)), page, good)
    assert seen[0] == {} and seen[1:] == [{50: 0, 52: 0}] * 3  # what the page view says, its own guess of row 51 not
    assert set(pages) == {30, 32}


def test_languages_of_awkward_rows(spark):
    docs, _ = labelled(spark, 60)
    odd = frame(spark, awkward() + [row(50, "12 34 !?")])
    got = predict_languages(clashing(odd), fit_languages(docs, F.lit(True))).collect()
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(awkward()) + 1
    assert all(pred[n] == (UNKNOWN, 0.0) for n in (1, 2, 3, 50)) and pred[4][0] == "en"
    unlearnt = predict_languages(odd, fit_languages(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)))
    assert {r["lang_pred"] for r in unlearnt.collect()} == {UNKNOWN}
    one = fit_languages(docs.where("lang = 'de'"), F.lit(True))
    assert {r["lang_pred"] for r in predict_languages(docs, one).collect()} == {"de"}
    assert predict_languages(docs.limit(0), one).count() == 0


def test_ngram_sets_are_sets_of_all_ngrams():
    cells, starts = ngram_sets(pa.array(["abab", None, "", "ABAB"]))
    one, blank, none, other = (cells[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True))
    assert len(one) == 6 and one == other and blank == none == []  # a b ab ba aba bab


def test_rates_meet_the_targets(spark):
    docs, labels = labelled(spark)
    marked = docs.join(labels, "doc_id").withColumn("domain", F.when(F.col("quality") == 0, "low").otherwise(F.col("lang")))
    model = fit_domains(marked)
    targets = {"en": 0.5, "de": 0.4, "low": 0.1}
    found = mix_to_targets(docs, model, targets).toPandas()
    posterior = np.array(found.posterior.tolist())
    total = (posterior * (found.tokens * found.rate).to_numpy()[:, None]).sum(axis=0)
    assert np.allclose(total / total.sum(), [targets[d] for d in model.domains], atol=0.01)
    assert found.rate.between(0, 1).all() and found.copies.isin([0, 1]).all()
    assert abs(found.copies.mean() - found.rate.mean()) < 0.08
    more = mix_to_targets(docs, model, targets, bound=3.0)
    assert repeat_copies(more).count() == more.agg(F.sum("copies")).first()[0]


def test_rare_domains_are_found_among_many_labels(spark):
    rare = set(range(0, 20_000, 1_000))
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("the text "), "id").alias("text"),
        F.when(F.col("id").isin(rare), "fr").otherwise("en").alias("lang"),
    )
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = labelled_domains(docs, labels).toPandas()
    assert set(found[found.domain == "fr"].doc_id) == rare
    assert 900 < (found.domain == "en").sum() < 1_500 and found.doc_id.is_unique
    twice = labelled_domains(docs.unionByName(docs), labels).where("domain = 'fr'")
    assert twice.count() == 2 * len(rare)


def test_domain_samples_keep_to_the_bytes(spark, monkeypatch):
    docs, labels = labelled(spark, 240)
    rows = docs.join(labels.where("doc_id is not null"), "doc_id").withColumn("domain", F.col("lang"))
    rows = rows.withColumn("text", F.when(F.col("doc_id") == 7, F.repeat("text", 90)).otherwise(F.col("text")))
    taken, train = [], mixing.train_sets
    monkeypatch.setattr(mixing, "train_sets", lambda sets, marks, n: taken.append((sets, marks)) or train(sets, marks, n))
    assert fit_domains(rows, max_bytes=60_000).domains == fit_domains(rows).domains == ["de", "en"]
    (few, marks), (every, _) = taken
    assert sum(4 * len(s) for s in few) <= 60_000 < sum(4 * len(s) for s in every)
    assert set(marks.tolist()) == {0, 1}


def test_targets_out_of_reach_are_told(spark):
    rows = [([0.6, 0.4], 10), ([0.4, 0.6], 10)] * 20
    judged = spark.createDataFrame(rows, "posterior array<double>, tokens long")
    assert fit_rates(judged, ["a", "b"], {"a": 0.5, "b": 0.5}).missed <= mixing.CLOSE
    assert fit_rates(judged, ["a", "b"], {"a": 0.95, "b": 0.05}, budget=300.0).missed > 0.05


def test_rates_agree_with_a_plain_descent(spark):
    rng = np.random.default_rng(2)
    posterior = rng.dirichlet([0.4] * 3, 300)
    tokens = rng.integers(1, 50, 300)
    judged = spark.createDataFrame([(int(t), p.tolist()) for t, p in zip(tokens, posterior, strict=True)], "tokens long, posterior array<double>")
    targets = {"a": 0.2, "b": 0.3, "c": 0.5}
    fit = fit_rates(judged, ["a", "b", "c"], targets)
    rate, weights = np.ones(300), fit.weights
    for _ in range(4000):
        error = (tokens * rate) @ posterior / tokens.sum() - weights
        rate = np.clip(rate - weights.min() * posterior @ (error / weights), 0, 1)
    both = [(tokens * r) @ posterior / tokens.sum() for r in (rate, fit.rates(posterior))]
    assert np.allclose(both[0], both[1], atol=2e-3)


def largest_budget(tokens, posterior, targets):
    """The least bound over weightings of three domains, by finer and finer grids around the best."""
    bound = lambda v: tokens @ np.maximum(posterior @ v, 0) / (v @ targets)
    best, width = np.eye(3)[(tokens @ posterior / targets).argmin()], 2.0
    while width > 1e-5:
        around = [best + width * np.array(d) for d in np.ndindex(9, 9, 9)]
        around = [v - 4 * width for v in around]
        found = min([v / (v @ targets) for v in around if v @ targets > 0.05] + [best / (best @ targets)], key=bound)
        best, width = found, width / 3
    return bound(best)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_budget_is_the_largest_that_rates_reach(spark, seed):
    rng = np.random.default_rng(seed)
    posterior, tokens, wanted = rng.dirichlet([0.4] * 3, 600), rng.integers(1, 50, 600), rng.dirichlet([3] * 3)
    rows = [(int(t), p.tolist()) for t, p in zip(tokens, posterior, strict=True)]
    judged = spark.createDataFrame(rows, "tokens long, posterior array<double>").repartition(2)
    fit = fit_rates(judged, ["a", "b", "c"], dict(zip("abc", wanted.tolist(), strict=True)))
    most = largest_budget(tokens, posterior, wanted) / tokens.sum()
    scarce = (tokens @ posterior / wanted).min() / tokens.sum()
    assert fit.missed < mixing.CLOSE
    assert 0.97 * most < fit.weights.sum() < most < scarce + 1e-9
    reached = (tokens * fit.rates(posterior)) @ posterior / tokens.sum()
    assert np.allclose(reached / reached.sum(), wanted, atol=5e-3)


def test_targets_that_nothing_comes_near_keep_a_part(spark):
    judged = spark.createDataFrame([([0.5, 0.5], 10)] * 30, "posterior array<double>, tokens long")
    with_least = fit_rates(judged, ["a", "b"], {"a": 0.9, "b": 0.1})
    assert with_least.missed > 0.1
    assert with_least.weights.sum() == pytest.approx(mixing.LEAST * 0.5 / 0.9, rel=0.01)
    assert with_least.rates(np.array([[0.5, 0.5]]))[0] > 0.05


def test_mixing_awkward_rows(spark):
    docs, labels = labelled(spark, 120)
    model = fit_domains(docs.join(labels, "doc_id").withColumn("domain", F.col("lang")))
    odd = clashing(frame(spark, awkward()))
    got = mix_to_targets(odd, model, {"en": 1.0}).collect()
    assert len(got) == len(awkward()) and all(0 <= r["rate"] <= 1 for r in got)
    alone = mix_to_targets(odd, fit_domains(docs.limit(0).withColumn("domain", F.col("lang"))), {})
    assert {r["rate"] for r in alone.collect()} == {1.0}
    assert mix_to_targets(frame(spark, []), model, {}).count() == 0


def test_words_and_counts():
    texts = pa.array([" a  b ", None, "", "\n\t", "b\x0ba c"])
    words = Words(texts)
    assert words.counts.tolist() == [2, 0, 0, 0, 3]
    assert [words.dictionary[c].as_py() for c in words.codes] == ["a", "b", "b", "a", "c"]
    assert count_ascii_words(texts).tolist() == [2, 0, 0, 0, 3]
    assert count_ascii_words(texts.slice(4)).tolist() == [3]
    a = hash_words(pa.array(["x", "yy", "", "x"]))
    assert a[0] == a[3] and len(set(a.tolist())) == 3
    assert hash_words(pa.array(["q", "x"]).slice(1))[0] == a[0]


@pytest.mark.parametrize("rows", [10, 5000])
def test_a_sample_is_the_same_again(spark, rows):
    from bondscope.llm.common import hashed_sample

    ids = spark.range(10_000).withColumnRenamed("id", "doc_id")
    one, two = (sorted(r[0] for r in hashed_sample(ids, "doc_id", rows, 10_000).collect()) for _ in range(2))
    assert one == two and len(one) < 2 * rows


def test_frames_are_staged_in_the_shared_folder(spark):
    place = common.stage(spark.range(5)).inputFiles()[0].removeprefix("file://")
    assert place.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_staged_files_go_when_released(spark):
    first, second = common.stage(spark.range(5)), common.stage(spark.range(6))
    assert os.path.exists(first.inputFiles()[0].removeprefix("file://")) and second.count() == 6
    places = [f.inputFiles()[0].removeprefix("file://") for f in (first, second)]
    common.release_stages(spark)
    assert not any(map(os.path.exists, places))
    common.release_stages(spark)
    assert common.stage(spark.range(7)).count() == 7
