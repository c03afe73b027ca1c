"""Search plans and what their results are labelled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.operators.linking import numbered

# Parts of a search term, kinds of a search, topics, defaults.
HAS_ABSTRACT, NOT_ENGLISH = "hasabstract", "NOT english[Language]"
YEARLY, NON_ENGLISH = "yearly", "non_english"
TOPICS = {
    "alzheimer": '"Alzheimer Disease"[MeSH Terms]',
    "parkinson": '"Parkinson Disease"[MeSH Terms]',
    "als": '"Amyotrophic Lateral Sclerosis"[MeSH Terms]',
    "epilepsy": '"Epilepsy"[MeSH Terms]',
    "multiple_sclerosis": '"Multiple Sclerosis"[MeSH Terms]',
}
START, STOP, PER_YEAR, NON_ENGLISH_PER_YEAR = 2005, 2024, 30, 3


def topics(spark, queries: dict[str, str] | None = None) -> DataFrame:
    queries = TOPICS if queries is None else queries
    if not queries:
        raise ValueError("a plan needs at least one topic")
    return spark.createDataFrame([(k, q, i) for i, (k, q) in enumerate(queries.items())], "label string, query string, ordinal long")


def plan_queries(topics: DataFrame, start: int = START, stop: int = STOP, per_year: int = PER_YEAR, non_english: int = NON_ENGLISH_PER_YEAR) -> DataFrame:
    """(ordinal, label, term, retmax, year, kind): a search for each topic (label, query, ordinal) and year, and one for
    articles in other languages unless non_english is 0. In the order of topic, year and kind."""
    if start > stop:
        raise ValueError("the plan ends before it starts")
    S.check_least(per_year, 1, "per_year")
    S.check_least(non_english, 0, "non_english")
    kinds = [F.struct(F.lit(YEARLY).alias("kind"), F.lit(per_year).alias("retmax"), F.lit("").alias("more"), F.lit(0).alias("k"))]
    if non_english:
        kinds.append(F.struct(F.lit(NON_ENGLISH).alias("kind"), F.lit(non_english).alias("retmax"), F.lit(f" {NOT_ENGLISH}").alias("more"), F.lit(1).alias("k")))
    each = topics.select("label", "query", F.col("ordinal").alias("t"), F.explode(F.sequence(F.lit(start), F.lit(stop))).alias("year")).select("*", F.explode(F.array(*kinds)).alias("s"))
    term = F.concat("query", F.lit(f" AND {HAS_ABSTRACT} AND "), F.col("year").cast("string"), F.lit("[dp]"), "s.more")
    flat = each.select("label", term.alias("term"), "s.retmax", "year", "s.kind", "t", F.col("s.k").alias("k"))
    return numbered(flat, ["t", "year", "k"]).drop("t", "k")


def first_labels(hits: DataFrame) -> DataFrame:
    """(pmid, query_label): each document is labelled by the first search (ordinal) that found it."""
    return hits.groupBy("pmid").agg(F.min(F.struct("ordinal", "label")).alias("f")).select("pmid", F.col("f.label").alias("query_label"))


def search_counts(results: DataFrame) -> DataFrame:
    """(label, year, kind, total, retrieved) of searched plans (…, total, ids)."""
    return results.select("label", F.col("year").cast("int").alias("year"), "kind", F.col("total").cast("int").alias("total"), F.size("ids").alias("retrieved"))


def run_ingest(spark, client, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Search every row of a plan and fetch what was found: (documents with query_label, search counts). The service's calls
    are rate limited, so they run one after another on the driver; a plan has a few hundred rows."""
    found = [(r.ordinal, r.label, r.year, r.kind, *client.search(r.term, r.retmax)) for r in plan.orderBy("ordinal").collect()]
    results = spark.createDataFrame(found, "ordinal long, label string, year int, kind string, ids array<string>, total int")
    labels = first_labels(results.select("ordinal", "label", F.explode("ids").alias("pmid")))
    documents = client.articles(spark, list(dict.fromkeys(i for r in found for i in r[4])))
    return documents.join(labels, "pmid", "left").withColumn("query_label", F.coalesce("query_label", F.lit(""))), search_counts(results)
