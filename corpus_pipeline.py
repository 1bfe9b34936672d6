"""From raw documents to token ids: the stages, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import bpe, jaccard, mixing, pii, toxicity
from logloom.llm.common import small_batches, staged, table

#: Near duplicates: words of a shingle, and the similarity in percent.
SHINGLE, SIMILARITY = 5, 80
#: The mixture has this share of the tokens that reach it, and takes no document twice.
SHARE, EPOCHS = 0.75, 1


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage with small batches to Python, also where its result is run by the caller."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join with staged ids, broadcast only up to a checked number of them."""
    ids = staged(ids, "pipeline-ids")
    return docs.join(F.broadcast(ids) if ids.count() <= jaccard.BROADCAST_IDS else ids, "doc_id", how).select(*docs.columns)


@bounded
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; null and empty texts have no matches and stay."""
    return toxicity.not_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@bounded
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest doc_id stays; documents without words and
    those with a null id have no group and stay."""
    found = jaccard.joined(docs, SHINGLE, SIMILARITY)
    return only(docs, found.where("doc_id <> component_id").select("doc_id").distinct(), "left_anti")


@bounded
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets, n_chars is counted anew."""
    return pii.redacted(docs)


@bounded
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture; those without words or with a null id aren't in it."""
    return only(docs, mixing.select(docs, SHARE, max_epochs=EPOCHS).select("doc_id").distinct(), "left_semi")


@bounded
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return bpe.encode(docs, with_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("pii", redact),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: No stage but the mixture can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
