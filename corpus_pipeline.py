"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import jaccard, mixing, quality, toxicity
from episodica.llm.queries import token_digests
from episodica.session import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, doesn't call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark))
    return docs.filter(toxicity.score(model)(F.col("text")) < 0.5)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the weakly supervised verdict."""
    return quality.keep(docs, Scratch(spark))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one(docs, Scratch(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, once, or left out so that sources meet their target weights."""
    return mixing.apply(docs, Scratch(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left, as often as the mix repeats it."""
    return token_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each),
    ("mix", mix_sources),
    ("pieces", encode),
]

# Learned verdicts, graph components and token merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``; the last stage's rows."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
