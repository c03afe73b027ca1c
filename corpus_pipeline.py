"""A training-data pipeline over `documents`: language ID, line and document deduplication, secrets, packing.

Each stage takes all that the one before kept, written as Parquet and read again. A table without rows passes through;
null texts have no letter, so they go with the first stage. Columns beside those of `documents` are not carried on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave.llm import langid, linededup, neardup, packing, secrets
from quillweave.llm.common import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without one get it."""
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    found = langid.predict(docs, model, carry=True).where(~F.col("rejected"))
    return found.select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier one; a document of which no word is left goes."""
    docs = docs.select(*COLUMNS)
    kept = linededup.remove_lines(docs, linededup.match_lines(docs, least=linededup.EVERY))
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return neardup.without_duplicates(docs.select(*COLUMNS)).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their live-looking secrets masked; widely copied examples stay."""
    return secrets.mask(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Language ID is a fitted model and packing depends on how rows are dealt, so no SQL gives the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the table documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    previous = None
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if previous is not None:
            scratch.drop(previous)
        previous = docs
    return docs
