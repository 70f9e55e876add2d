"""Corpus pipeline: language ID, toxicity, near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and reread as the next stage's ``docs``; all but the last return the columns of the
documents. Each stage is judged on its own input and learns from that input.

Defined cases: a document whose language cannot be told (null text, no letter), or that needs
too many bits a letter in every learned language (another language, random letters), goes; so
does one predicted toxic; of each group of near duplicates the document with the least
id stays (null ids last), documents without words stay; the mix repeats or leaves out
documents by their source's target; null texts pack as their end id. Empty tables pass
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartpath.llm import language, mixing, packing, similarity, toxicity
from cartpath.llm.common import documents, labels, materialize

# Near duplicates: five words, a similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY = "0.8"
# At 0.8 a set has more parts than at 0.85 anyway: fewer spare ones keep its keys few.
SPARE_PARTS = 1.15


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_languages(docs, language.learn_languages(docs))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.learn_lexicon(docs, labels(spark, sf_dir)))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similarity.first_of_each(docs, SHINGLE_WORDS, SIMILARITY, SPARE_PARTS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", remove_toxic),
    ("ngram_jaccard", remove_near_duplicates),
    ("mix_sources", mix),
    ("pack_documents", pack),
]

# Learned models and tokenizers cannot be written in SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
