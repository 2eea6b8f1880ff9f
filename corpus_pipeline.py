"""Corpus cleaning in stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns what
it keeps with the columns of ``documents``; the last returns token digests. Classifiers learn from
the labelled documents among a stage's own input.

Defined cases: an empty input passes through every stage. Without usable labels nothing is rejected.
Rows are judged by their text, whatever their doc_id: rows that share an id or have none are told apart by it, and
of near copies the one with the smallest id stays, a null id last. Rows equal in id and text are one document.
Columns beside doc_id and text pass through unchanged up to the last stage.

A stage's result is computed when its caller writes it, so stages that end in Python leave the session with small Arrow
batches (``use_small_batches``); ``run`` puts the session's own back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from waybill.llm import decontamination, jaccard, quality, toxicity
from waybill.llm.queries import MODEL, token_digests
from waybill.llm.tables import keep, small_batches, use_small_batches

TOXIC, GOOD = 0.7, 0.3
_SCORE = "__score"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``."""
    use_small_batches(spark)
    lexicon = toxicity.toxicity_model(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.scored(docs, lexicon, _SCORE).filter(F.col(_SCORE) < TOXIC).drop(_SCORE)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``GOOD``; all without labels of both values."""
    use_small_batches(spark)
    space = quality.quality_model(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    if len(set(space.labels)) < 2:
        return docs  # labels of one value tell nothing apart
    return quality.scored(docs, space, name=_SCORE).filter(F.col(_SCORE) >= GOOD).drop(_SCORE)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id (``jaccard.one_of_each_group``)."""
    return jaccard.one_of_each_group(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span of ten words, or whole shorter item, with the benchmark."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and their decoding."""
    use_small_batches(spark)
    return token_digests(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("toxicity", remove_toxic),
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", remove_contaminated),
    ("SentencePiece encoding and decoding", tokenize),
]

# scores of trained models, similarity components and tokenization are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what every stage returns is stored and read by the next."""
    docs = _table(spark, sf_dir, "documents")
    with small_batches(spark):
        for _, stage in STAGES:
            docs = keep(stage(spark, docs, sf_dir), "stage")
    return docs
