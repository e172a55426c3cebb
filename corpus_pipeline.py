"""Corpus pipeline: five stages over ``documents``, each one of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and reads it back as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm import decontaminate, jaccard_join, language_id, sharding
from lakestar.llm.common import Scratch
from lakestar.llm.queries import SHARDS, mixture, table, tokenizer_path

MIN_SCORE = 0.5  # least posterior of the predicted language
MIX_FRACTION = 0.8  # token budget as a share of what reaches the mixing stage


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, no clear prediction, or
    letters far less probable than in the predicted language's own texts."""
    *model, bounds = language_id.train(docs, vocabulary=tokenizer_path("piece_bpe_32k.model"), likelihoods=True)
    told = language_id.identify(docs, tuple(model), bounds=bounds)
    return told.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
                      & F.col("likely")).select(docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chooses the documents of the mixture, each at most once (one epoch)."""
    return mixture(docs, fraction=MIX_FRACTION, epochs=1).select(docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the mixture into shards."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("language_id", language_stage),
    ("jaccard_join", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The language stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
