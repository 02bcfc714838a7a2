"""Corpus pipeline: the stages that turn raw documents into training data.

Each stage takes (spark, docs, sf_dir) and returns the rows for the next one;
``run`` writes every result as Parquet and reads it again. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import bpe, language, minhash, mixing, secrets
from cardsentry.llm.common import read, small_batches
from cardsentry.sources.storage import materialize

# A document whose best language is less likely than this is of none of them.
LEAST_SCORE = 0.4


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters, or of no language that the
    network tells apart, go. The network is trained on the stage's input. The kept
    rows are written here: Python workers serve later stages too and keep the
    memory that their largest batch took."""
    net = language.fit_languages(docs)
    labelled = language.with_language(docs, net)
    kept = labelled.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    with small_batches(spark):
        return materialize(kept.select(*docs.columns), "identified")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup, five-word shingles and a similarity of 0.8: the
    document with the smallest id of each group stays. Every row is a document:
    rows that share an id go only if their own text is a near copy. Texts without
    words, and rows without an id, are in no group and all stay."""
    return minhash.first_of_groups(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every secret in a text is replaced by its kind."""
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every source gets the same weight, one epoch in all; documents
    are repeated as drawn and shuffled."""
    return mixing.mix_sources(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: the token ids of every document, and whether they decode to its text."""
    return bpe.with_round_trip(docs).select(
        *docs.columns,
        "ids",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language", identify),
    ("near_dedup", near_dedup),
    ("secrets", redact),
    ("mix", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Language identification is a trained network, which SQL cannot express;
# tests check each stage against a plain version of it instead.
ORACLE_SQL: str | None = None
