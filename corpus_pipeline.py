"""The corpus pipeline: stages over ``documents``, each stored and read again by the next.

Toxic documents go, of equal texts and of near-duplicates one stays, sources are mixed to target
weights (documents repeated or left out by their draw), and what is left is packed into sequences.
Every stage works on all rows its predecessor kept and returns the columns it was given; the last one
returns the pieces with their places.

Defined results
---------------
* ids keep all 64 bits; null ids, null, empty and very long texts, ties and rows repeated as a whole are
  treated as the operators' modules state; repeated rows are copies, of which one stays
* further columns, whatever their names, pass all stages but the last as they are
* without examples of both classes no document is taken for toxic, and a warning says so
* empty documents: every stage returns an empty table of the same columns
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakevault.llm import exact_dedup, near_dedup, packing, poisson_mix, toxicity
from lakevault.llm.common import stored, table, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones among ``docs``, takes for toxic go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest id stays."""
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated by their Poisson count, in a new global order."""
    mixed_ = poisson_mix.mix(docs, copy_col=unused(docs, "mix_copy"), key_col=unused(docs, "mix_key"))
    return mixed_.select(*[f"`{c}`" for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("source_mix", mixed), ("best_fit_packing", packed)]

#: a trained model and a packing search are no SQL; tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
