"""The driver's star-schema tables as documents, relations, entities and mentions."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.operators import evidence
from quillweave.operators.shared import dealt
from quillweave.plans.graph import KnowledgeGraph


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: the year of the order, the scope by its status, the priority as language."""
    status = F.col("o_orderstatus")
    scope = F.when(status == "F", S.SCOPE_FULL).when(status == "O", S.SCOPE_TITLE).when(status == "P", S.SCOPE_NONE)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"), F.year("o_orderdate").alias("year"), F.array("o_orderpriority").alias("languages"), scope.alias("nlp_scope"), F.lit(True).alias("extracted"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as classified pairs of a brand and the customer's nation; the quantity's share of 50 is the confidence.
    Parts and customers are small beside the lines, and left to the optimizer to broadcast. Lines are dealt by document once, for the join
    with orders and for all joins and groups by document that follow."""
    nations = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    owners = table(spark, sf_dir, "orders").join(nations, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").cast("string").alias("pmid"), "n_name")
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    label = F.when(flag == "A", "Association").when((flag == "N") & (state == "F"), "Positive_Correlation").when((flag == "R") & (state == "F"), "Negative_Correlation").otherwise(S.NO_RELATION)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("pmid"), "l_partkey", "l_linenumber", "l_quantity", label.alias("label"))
    branded = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    joined = dealt(branded, "pmid").join(owners.hint("merge"), "pmid")
    return joined.select(
        "pmid", F.col("l_linenumber").alias("sentence_index"), F.concat(F.lit("brand:"), "p_brand").alias("head_id"), F.concat(F.lit("nation:"), "n_name").alias("tail_id"),
        "label", (F.col("l_quantity") / 50.0).alias("confidence"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.lit(" of order "), "pmid").alias("sentence"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands (genes), nations (diseases) and part types (chemicals, which nothing mentions)."""
    part = table(spark, sf_dir, "part")
    brands = part.select("p_brand").distinct().select(F.concat(F.lit("brand:"), "p_brand").alias("entity_id"), F.lit(S.GENE).alias("type"), F.col("p_brand").alias("name"), F.col("p_brand").rlike("[24]$").alias("matched"))
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("nation:"), "n_name"), F.lit(S.DISEASE), "n_name", F.lit(True)).distinct()
    types = part.select("p_type").distinct().select(F.concat(F.lit("type:"), "p_type"), F.lit(S.CHEMICAL), "p_type", F.lit(False))
    return brands.union(nations).union(types)


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of every relation."""
    both = F.explode(F.array(F.struct(F.col("head_id").alias("id"), F.lit(S.GENE).alias("type")), F.struct(F.col("tail_id").alias("id"), F.lit(S.DISEASE).alias("type"))))
    return relations(spark, sf_dir).select("pmid", "sentence_index", both.alias("m")).select(
        "pmid", "sentence_index", F.lit(0).alias("start_char"), F.length("m.id").alias("end_char"), F.col("m.id").alias("surface"), F.col("m.type").alias("type"), F.col("m.id").alias("entity_id")
    )


def graph(spark: SparkSession, sf_dir: str, min_confidence: float = S.MIN_CONFIDENCE) -> KnowledgeGraph:
    base = {"documents": documents(spark, sf_dir), "relations": relations(spark, sf_dir), "entities": entities(spark, sf_dir), "mentions": mentions(spark, sf_dir)}
    return KnowledgeGraph(base | evidence.graph_tables(base["relations"], base["documents"], base["mentions"], min_confidence))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text documents as articles: the first line is the title, the rest the abstract."""
    parts = F.split("text", "\n", 2)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pmid"), F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("title"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("abstract"), F.array("lang").alias("languages"))


@cache
def sql_base() -> str:
    """The same tables as common table expressions of SQL: gd, gr, ge, gm (documents, relations, entities, mentions) and
    the derived ev, ed, ey, es, ny, yd (evidence, edges, edge years, entity stats, entity years, documents of a year)."""
    return """gd AS (SELECT CAST(o_orderkey AS VARCHAR) AS pmid, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS languages,
                 CASE o_orderstatus WHEN 'F' THEN 'title+abstract' WHEN 'O' THEN 'title' WHEN 'P' THEN 'none' END AS nlp_scope FROM orders),
        gr AS (SELECT CAST(l_orderkey AS VARCHAR) AS pmid, l_linenumber AS sentence_index, 'brand:' || p_brand AS head_id, 'nation:' || n_name AS tail_id,
                 CASE WHEN l_returnflag = 'A' THEN 'Association' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Positive_Correlation'
                      WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Negative_Correlation' ELSE 'None' END AS label,
                 l_quantity / 50.0 AS confidence, 'line ' || l_linenumber || ' of order ' || l_orderkey AS sentence
               FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
               JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
        ge AS (SELECT DISTINCT 'brand:' || p_brand AS entity_id, 'Gene' AS type, p_brand AS name, regexp_matches(p_brand, '[24]$') AS matched FROM part
               UNION SELECT 'nation:' || n_name, 'Disease', n_name, true FROM nation
               UNION SELECT 'type:' || p_type, 'Chemical', p_type, false FROM part),
        gm AS (SELECT pmid, sentence_index, head_id AS entity_id, 'Gene' AS type FROM gr UNION ALL SELECT pmid, sentence_index, tail_id, 'Disease' FROM gr),
        ev AS (SELECT pmid, year, head_id, tail_id, label, confidence, n_sentences FROM (
                 SELECT gr.*, year, count(*) OVER w AS n_sentences,
                        row_number() OVER (PARTITION BY pmid, head_id, tail_id ORDER BY confidence DESC, sentence_index, label) AS k
                 FROM gr JOIN gd USING (pmid) WHERE label <> 'None' AND confidence >= 0.5 WINDOW w AS (PARTITION BY pmid, head_id, tail_id)) WHERE k = 1),
        ed AS (SELECT head_id, tail_id, label, count(*) AS n_docs, CAST(sum(n_sentences) AS BIGINT) AS n_sentences, avg(confidence) AS mean_confidence,
                 max(confidence) AS max_confidence, 1 - product(1 - confidence) AS combined_confidence, min(year) AS first_year, max(year) AS last_year
               FROM ev GROUP BY ALL),
        ey AS (SELECT head_id, tail_id, label, year, count(*) AS n_docs, avg(confidence) AS mean_confidence FROM ev WHERE year IS NOT NULL
               GROUP BY head_id, tail_id, label, year),
        es AS (SELECT entity_id, count(DISTINCT pmid) AS n_docs, count(*) AS n_mentions, min(year) AS first_year, max(year) AS last_year
               FROM gm JOIN gd USING (pmid) GROUP BY entity_id),
        ny AS (SELECT entity_id, year, count(DISTINCT pmid) AS n_docs FROM gm JOIN gd USING (pmid) WHERE year IS NOT NULL GROUP BY entity_id, year),
        yd AS (SELECT year, count(*) AS n_docs FROM gd WHERE nlp_scope <> 'none' AND year IS NOT NULL GROUP BY year)"""
