"""The corpus pipeline: its stages in order, each over all rows that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bondscope.llm.common import held_out, read_table, stage
from bondscope.llm.exact_dedup import drop_exact_copies
from bondscope.llm.mixing import fit_domains, mix_to_targets, repeat_copies
from bondscope.llm.near_dedup import drop_near_copies
from bondscope.llm.packing import pack
from bondscope.llm.queries import TARGETS, labelled_domains, piece_digests
from bondscope.llm.toxicity import fit_toxicity, score_toxicity

#: Trained models, iterated classes and fitted rates have no SQL form.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose toxicity reaches the threshold of their language. Held-out labels are not learnt."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.where("not rejected").select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept at the rates that bring the domains to their target weights."""
    model = fit_domains(labelled_domains(docs, read_table(spark, sf_dir, "labels")))
    return repeat_copies(mix_to_targets(docs, model, TARGETS)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return piece_digests(pack(docs))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each but the last written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs if number == 0 else stage(docs), sf_dir)
    return docs
