"""From classified pairs to the time-indexed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.stats import noisy_or

EDGE = ("head_id", "tail_id", "label")


def _years(documents: DataFrame) -> DataFrame:
    """Never broadcast: by the size of its files, most of which other columns may be thought to fill, a table of millions of rows looks small."""
    return documents.select("pmid", "year").hint("merge")


def document_evidence(relations: DataFrame, documents: DataFrame, min_confidence: float = S.MIN_CONFIDENCE) -> DataFrame:
    """One row per document and pair: the surest passing sentence's label and confidence, and how many sentences pass.

    Ties go to the first sentence, then the first label. The filter runs in the scan; the join's partitioning by document
    serves the aggregation, so relations are shuffled once.
    """
    passing = relations.where((F.col("label") != S.NO_RELATION) & (F.col("confidence") >= min_confidence))
    dated = passing.select("pmid", "sentence_index", *EDGE, "confidence").join(_years(documents), "pmid")
    best = F.min(F.struct((-F.col("confidence")).alias("c"), "sentence_index", "label", "year"))
    found = dated.groupBy("pmid", "head_id", "tail_id").agg(best.alias("b"), F.count("*").alias("n_sentences"))
    return found.select("pmid", F.col("b.year").alias("year"), "head_id", "tail_id", F.col("b.label").alias("label"), (-F.col("b.c")).alias("confidence"), "n_sentences")


def edges(evidence: DataFrame) -> DataFrame:
    """One row per (head, tail, label) over all documents; years that are null don't count for first and last."""
    c = F.col("confidence")
    return evidence.groupBy(*EDGE).agg(
        F.count("*").alias("n_docs"), F.sum("n_sentences").alias("n_sentences"), F.avg(c).alias("mean_confidence"), F.max(c).alias("max_confidence"),
        noisy_or(c).alias("combined_confidence"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
    )


def edge_years(evidence: DataFrame) -> DataFrame:
    """Documents and mean confidence of each edge in each year; evidence without a year is left out."""
    return evidence.where(F.col("year").isNotNull()).groupBy(*EDGE, "year").agg(F.count("*").alias("n_docs"), F.avg("confidence").alias("mean_confidence"))


def dated_mentions(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """(entity, document, year) with the number of mentions: summed per document before anything is counted distinct, so
    a hub entity's rows shrink in every task. The join's partitioning by document serves it."""
    return mentions.select("pmid", "entity_id").join(_years(documents), "pmid").groupBy("pmid", "entity_id").agg(F.count("*").alias("n"), F.min("year").alias("year"))


def entity_stats(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents, mentions, first and last year of each entity. Documents without a year count."""
    return dated_mentions(mentions, documents).groupBy("entity_id").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_mentions"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def entity_years(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents that mention an entity in a year."""
    return dated_mentions(mentions, documents).where(F.col("year").isNotNull()).groupBy("entity_id", "year").agg(F.count("*").alias("n_docs"))


def year_docs(documents: DataFrame) -> DataFrame:
    """Processed documents of each year: extracted, with a scope other than none, with a year."""
    done = F.col("extracted") & (F.col("nlp_scope") != S.SCOPE_NONE) & F.col("year").isNotNull()
    return documents.where(done).groupBy("year").agg(F.count("*").alias("n_docs"))


def graph_tables(relations: DataFrame, documents: DataFrame, mentions: DataFrame, min_confidence: float = S.MIN_CONFIDENCE) -> dict[str, DataFrame]:
    """The derived tables by name."""
    found = document_evidence(relations, documents, min_confidence)
    return {"edges": edges(found), "edge_years": edge_years(found), "entity_stats": entity_stats(mentions, documents), "entity_years": entity_years(mentions, documents), "year_docs": year_docs(documents)}
