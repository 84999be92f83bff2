"""The pipeline against brute-force versions of its stages, over tables with copies and awkward rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bondscope.llm.common import held_out
from bondscope.llm.mixing import fit_domains, mix_to_targets
from bondscope.llm.queries import TARGETS, labelled_domains
from bondscope.llm.toxicity import fit_toxicity, score_toxicity
from tests.llm.samples import DOCS, awkward, frame, row, text
from tests.llm.test_dedup import WHITE, brute_classes, edited
from tests.llm.test_models import labelled


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and labels."""
    docs, labels = labelled(spark, 240)
    more = [row(1000 + n, "  " + text(n % 4, 60).replace(" ", "\n")) for n in range(12)]
    more += [row(1100 + n, edited(77, n)) for n in range(12)]
    odd = [row(None if r[0] is None else 2000 + r[0], *r[1:4]) for r in awkward()]
    folder = tmp_path_factory.mktemp("tables")
    docs.unionByName(frame(spark, more + odd)).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_agree_with_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]

    clean = corpus_pipeline.stage(stages["toxicity"](spark, docs, tables))
    assert clean.columns == docs.columns
    model = fit_toxicity(docs, labels.where(~held_out("doc_id", 3, 1)))
    rejected = Counter(r["doc_id"] for r in score_toxicity(docs, model).where("rejected").collect())
    before, after = rows(docs), rows(clean)
    assert Counter(r[0] for r in before) - Counter(r[0] for r in after) == rejected and rejected

    once = corpus_pipeline.stage(stages["exact_dedup"](spark, clean, tables))
    best = {}
    for r in after:
        body = (r[1] or "").translate(WHITE)
        rank = (-len(r[1] or ""), r[0] is not None, r[0] or 0)
        if body not in best or rank < best[body][0]:
            best[body] = (rank, r)
    assert Counter(rows(once)) == Counter(r for _, r in best.values())

    apart = corpus_pipeline.stage(stages["near_dedup"](spark, once, tables))
    classes = brute_classes([r for r in rows(once) if r[0] is not None])
    kept = [r for r in rows(once) if r[0] is None or classes[r[0]] == r[0]]
    assert Counter(rows(apart)) == Counter(kept)

    mixed = corpus_pipeline.stage(stages["mixing"](spark, apart, tables))
    rated = mix_to_targets(apart, fit_domains(labelled_domains(apart, labels)), TARGETS)
    expected = Counter(tuple(r)[:5] for r in rated.where("copies = 1").collect())
    assert Counter(rows(mixed)) == expected and mixed.columns == docs.columns

    packed = stages["packing"](spark, mixed, tables)
    whole = corpus_pipeline.run(spark, tables)
    assert packed.schema == whole.schema
    as_rows = lambda f: Counter(map(tuple, f.drop("sequence_id").collect()))
    assert as_rows(packed) == as_rows(whole)
    assert {r["doc_id"] for r in whole.collect()} == {r[0] for r in rows(mixed)}


def test_stages_over_no_documents(spark, tables):
    empty = spark.createDataFrame([], DOCS)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, tables).count() == 0


def test_stages_keep_extra_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(40)
    docs = docs.withColumns({n: F.lit("x") for n in ("score", "kept", "_text", "rate", "tokens")})
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, tables).columns == docs.columns
