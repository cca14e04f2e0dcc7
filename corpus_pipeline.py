"""A training corpus from documents: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stallkeep.llm import mixing, packing, passages, quality_rules, setsketch
from stallkeep.llm.queries import RANKS, VOCABULARY, table, tokenizer_file
from stallkeep.session import new_folder, release, tune, work

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    """A stage that first deletes what the stages before have stored for themselves: their results are written by now."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "pipeline", docs)
        with work("pipeline"):
            return function(spark, docs.select(*COLUMNS), sf_dir)

    return run


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_rows(docs, quality_rules.fitted_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; a document given twice stays once. Texts without a word are no duplicates."""
    return setsketch.without_near_duplicates(docs)


@stage
def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id holds; those of nothing else go."""
    return passages.without_repeated_passages(docs)


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as op3's mixture takes them: those not mostly of another domain once, the others as often as the targets ask."""
    model = mixing.fitted_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixing.taken_rows(docs, model, keep_anchor=True)


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_file(RANKS), tokenizer_file(VOCABULARY))


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("substring dedup", passage_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifiers, sketches and packing are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    release(spark, "pipeline", docs)
    return docs
