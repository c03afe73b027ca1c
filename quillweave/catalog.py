"""The engine's own queries over the driver's tables, and the SQL that gives the same rows.

Doubles are rounded to six places on both sides, as sums of doubles depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import catalog_files, catalog_text
from quillweave import schemas as S
from quillweave.functions.stats import slope
from quillweave.operators import evidence, store
from quillweave.plans import ingest
from quillweave.sources import adapters

def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes))


def _graph(make: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(make(adapters.graph(spark, sf_dir)))


def _brand(spark: SparkSession, sf_dir: str) -> str:
    """The entity that the queries ask about: the first brand by name."""
    return adapters.table(spark, sf_dir, "part").agg(F.min(F.concat(F.lit("brand:"), "p_brand"))).first()[0]


def _about(make: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(make(adapters.graph(spark, sf_dir), _brand(spark, sf_dir)))


def _nation(g) -> str:
    return g["entities"].where(F.col("type") == S.DISEASE).agg(F.min("entity_id")).first()[0]


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to 1999 are stored; those from 1998 on or without a date arrive, two years later. Together they are all."""
    docs = adapters.documents(spark, sf_dir).withColumn("query_label", F.lit("first"))
    arriving = docs.where(F.coalesce(F.col("year") >= 1998, F.lit(True))).withColumns({"year": F.col("year") + 2, "query_label": F.lit("second"), "extracted": F.lit(False)})
    return rounded(store.upsert_documents(docs.where("year <= 1999"), arriving)).select("pmid", "year", "query_label", "nlp_scope", "extracted")


def _replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of orders divisible by four are replaced by their first sentences'."""
    old = adapters.mentions(spark, sf_dir).select("pmid", "sentence_index", "entity_id")
    new = old.where((F.col("pmid").cast("long") % 4 == 0) & (F.col("sentence_index") == 1))
    done = adapters.documents(spark, sf_dir).where(F.col("pmid").cast("long") % 4 == 0).select("pmid")
    return rounded(store.replace_by_document(old, new, done).groupBy("pmid", "entity_id").agg(F.count("*").alias("n")))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = adapters.table(spark, sf_dir, "region").select(F.col("r_name").alias("label"), F.lower("r_name").alias("query"), F.col("r_regionkey").cast("long").alias("ordinal"))
    return rounded(ingest.plan_queries(topics, 2005, 2008, 30, 3))


def _first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts found under several suppliers' searches: the lowest supplier number is the first search."""
    hits = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ordinal"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("label"), F.col("l_partkey").cast("string").alias("pmid"))
    return ingest.first_labels(hits)


SHOWN = "round(mean_confidence, 6) AS mean_confidence"
_NEIGHBOR = """SELECT {eid} AS entity_id, neighbor_id, name AS neighbor_name, type AS neighbor_type, label, n_docs, round(mean, 6) AS mean_confidence,
        CAST(first_year AS BIGINT) AS first_year, CAST(last_year AS BIGINT) AS last_year
    FROM (SELECT CASE WHEN head_id = {eid} THEN tail_id ELSE head_id END AS neighbor_id, label, CAST(sum(n_docs) AS BIGINT) AS n_docs,
                 sum(n_docs * mean_confidence) / sum(n_docs) AS mean, min(year) AS first_year, max(year) AS last_year
          FROM ey WHERE (head_id = {eid} OR tail_id = {eid}) AND {where} GROUP BY head_id, tail_id, label)
    JOIN ge ON entity_id = neighbor_id WHERE n_docs >= {least} ORDER BY n_docs DESC, mean DESC, neighbor_id, label LIMIT {limit}"""
_EID = "(SELECT 'brand:' || min(p_brand) FROM part)"
_NID = "(SELECT 'nation:' || min(n_name) FROM nation)"
_ENTITY = "SELECT ge.entity_id, type, name, matched, coalesce(n_docs, 0) AS n_docs, coalesce(n_mentions, 0) AS n_mentions FROM ge LEFT JOIN es USING (entity_id)"
_TRENDS = """t AS (SELECT year, n_docs AS total, year > (SELECT max(year) FROM yd) - {recent} AS late FROM yd),
        k AS (SELECT head_id, tail_id, label, sum(n_docs) AS n, string_agg(year || ':' || n_docs, ' ' ORDER BY year) AS series FROM ey GROUP BY ALL),
        d AS (SELECT k.head_id, k.tail_id, k.label, t.year, total, late, coalesce(ey.n_docs, 0) AS c FROM k CROSS JOIN t
              LEFT JOIN ey ON ey.head_id = k.head_id AND ey.tail_id = k.tail_id AND ey.label = k.label AND ey.year = t.year),
        s AS (SELECT head_id, tail_id, label, CAST(sum(c) FILTER (NOT late) AS BIGINT) AS early_docs, CAST(sum(c) FILTER (late) AS BIGINT) AS recent_docs,
                     sum(total) FILTER (NOT late) AS et, sum(total) FILTER (late) AS rt, regr_slope(1000.0 * c / total, year) AS slope FROM d GROUP BY ALL)"""

_G: dict[str, tuple[Callable, str]] = {
    "neighbors": (_about(lambda g, e: g.neighbors(e)), _NEIGHBOR.format(eid=_EID, where="true", least=1, limit=25)),
    "neighbors_window": (_about(lambda g, e: g.neighbors(e, since=1996, until=1998)), _NEIGHBOR.format(eid=_EID, where="year BETWEEN 1996 AND 1998", least=1, limit=25)),
    "neighbors_label_mindocs": (_about(lambda g, e: g.neighbors(e, label="Association", min_docs=2, limit=10)), _NEIGHBOR.format(eid=_EID, where="label = 'Association'", least=2, limit=10)),
    "neighbors_with_evidence": (
        _about(lambda g, e: g.neighbors_with_evidence(e, 3, limit=10).select("neighbor_id", "label", "n_docs", F.array_join(F.transform("evidence", lambda x: F.concat_ws("/", x["pmid"], x["year"], x["label"])), " ").alias("evidence"))),
        f"SELECT b.neighbor_id, b.label, b.n_docs, evidence FROM ({_NEIGHBOR.format(eid=_EID, where='true', least=1, limit=10)}) b LEFT JOIN "
        f"""(SELECT neighbor_id, string_agg(pmid || '/' || year || '/' || label, ' ' ORDER BY k) AS evidence FROM (
                SELECT tail_id AS neighbor_id, pmid, year, label, row_number() OVER (PARTITION BY tail_id ORDER BY confidence DESC, pmid, sentence_index, label) AS k
                FROM gr JOIN gd USING (pmid) WHERE head_id = {_EID} AND label <> 'None') WHERE k <= 3 GROUP BY neighbor_id) e USING (neighbor_id)""",
    ),
    "document_evidence": (_graph(lambda g: evidence.document_evidence(g["relations"], g["documents"])), "SELECT pmid, CAST(year AS BIGINT) AS year, head_id, tail_id, label, round(confidence, 6) AS confidence, n_sentences FROM ev"),
    "evidence_high_confidence": (
        _graph(lambda g: evidence.document_evidence(g["relations"], g["documents"], 0.9).groupBy("label").agg(F.count("*").alias("n"), F.sum("n_sentences").alias("n_sentences"))),
        "SELECT label, count(*) AS n, CAST(sum(c) AS BIGINT) AS n_sentences FROM (SELECT label, count(*) OVER w AS c, row_number() OVER (PARTITION BY pmid, head_id, tail_id ORDER BY confidence DESC, sentence_index, label) AS k "
        "FROM gr JOIN gd USING (pmid) WHERE label <> 'None' AND confidence >= 0.9 WINDOW w AS (PARTITION BY pmid, head_id, tail_id)) WHERE k = 1 GROUP BY label",
    ),
    "edges": (_graph(lambda g: g["edges"]), f"SELECT head_id, tail_id, label, n_docs, n_sentences, {SHOWN}, round(max_confidence, 6) AS max_confidence, round(combined_confidence, 6) AS combined_confidence, CAST(first_year AS BIGINT) AS first_year, CAST(last_year AS BIGINT) AS last_year FROM ed"),
    "edge_years": (_graph(lambda g: g["edge_years"]), f"SELECT head_id, tail_id, label, CAST(year AS BIGINT) AS year, n_docs, {SHOWN} FROM ey"),
    "entity_stats": (_graph(lambda g: g["entity_stats"]), "SELECT entity_id, n_docs, n_mentions, CAST(first_year AS BIGINT) AS first_year, CAST(last_year AS BIGINT) AS last_year FROM es"),
    "entity_years": (_graph(lambda g: g["entity_years"]), "SELECT entity_id, CAST(year AS BIGINT) AS year, n_docs FROM ny"),
    "year_docs": (_graph(lambda g: g["year_docs"]), "SELECT CAST(year AS BIGINT) AS year, n_docs FROM yd"),
    "entities": (_graph(lambda g: g.entities()), _ENTITY),
    "top_entities": (_graph(lambda g: g.top_entities(limit=10)), "SELECT entity_id, name, type, CAST(sum(n_docs) AS BIGINT) AS n_docs FROM ny JOIN ge USING (entity_id) GROUP BY ALL ORDER BY n_docs DESC, name, entity_id LIMIT 10"),
    "top_entities_type_since": (_graph(lambda g: g.top_entities("Gene", 1998, 5)), "SELECT entity_id, name, type, CAST(sum(n_docs) AS BIGINT) AS n_docs FROM ny JOIN ge USING (entity_id) WHERE type = 'Gene' AND year >= 1998 GROUP BY ALL ORDER BY n_docs DESC, name, entity_id LIMIT 5"),
    "find_entities_exact": (_about(lambda g, e: g.find_entities(e.split(":")[1].upper())), f"SELECT * FROM ({_ENTITY}) WHERE lower(name) = (SELECT lower(min(p_brand)) FROM part) ORDER BY n_docs DESC, entity_id LIMIT 10"),
    "find_entities_substring": (_graph(lambda g: g.find_entities("and#1")), f"SELECT * FROM ({_ENTITY}) WHERE lower(name) LIKE '%and#1%' ORDER BY n_docs DESC, entity_id LIMIT 10"),
    "find_entities_id": (_about(lambda g, e: g.find_entities(e)), f"SELECT * FROM ({_ENTITY}) WHERE entity_id = {_EID} ORDER BY n_docs DESC, entity_id LIMIT 10"),
    "evidence_sentences": (
        _about(lambda g, e: g.evidence_sentences(_nation(g), e, since=1996)),
        f"SELECT pmid, CAST(year AS BIGINT) AS year, label, round(confidence, 6) AS confidence, sentence FROM gr JOIN gd USING (pmid) WHERE head_id = {_EID} AND tail_id = {_NID} AND label <> 'None' AND year >= 1996 ORDER BY confidence DESC, pmid, sentence_index, label LIMIT 5",
    ),
    "entity_series": (_about(lambda g, e: g.entity_series(e)), f"SELECT CAST(ny.year AS BIGINT) AS year, ny.n_docs, round(coalesce(1000.0 * ny.n_docs / nullif(yd.n_docs, 0), 0.0), 6) AS rate FROM ny LEFT JOIN yd USING (year) WHERE entity_id = {_EID}"),
    "edge_trends": (
        _graph(lambda g: g.edge_trends(recent_years=3).withColumn("series", F.array_join(F.transform("series", lambda x: F.concat_ws(":", x["year"], x["n_docs"])), " "))),
        "WITH " + _TRENDS.format(recent=3) + """ SELECT head_id, h.name AS head_name, tail_id, t2.name AS tail_name, label, series, early_docs, recent_docs,
            round(coalesce(1000.0 * early_docs / et, 0.0), 6) AS early_rate, round(coalesce(1000.0 * recent_docs / rt, 0.0), 6) AS recent_rate,
            round(CASE WHEN et IS NULL THEN 1.0 ELSE ((recent_docs + 1.0) / (rt + 1)) / ((early_docs + 1.0) / (et + 1)) END, 6) AS rate_ratio,
            round(CASE WHEN isnan(slope) THEN 0.0 ELSE coalesce(slope, 0.0) END, 6) + 0.0 AS slope
            FROM s JOIN k USING (head_id, tail_id, label) JOIN ge h ON h.entity_id = head_id JOIN ge t2 ON t2.entity_id = tail_id WHERE n >= 2""",
    ),
    "edge_trends_top": (
        _about(lambda g, e: g.edge_trends(e, limit=15).select("head_id", "tail_id", "label", "rate_ratio", "recent_docs")),
        "WITH " + _TRENDS.format(recent=5) + f""", r AS (SELECT *, CASE WHEN et IS NULL THEN 1.0 ELSE CAST(recent_docs + 1 AS DOUBLE) / (rt + 1) / (CAST(early_docs + 1 AS DOUBLE) / (et + 1)) END AS ratio FROM s)
            SELECT head_id, tail_id, label, round(ratio, 6) AS rate_ratio, recent_docs FROM r JOIN k USING (head_id, tail_id, label) JOIN ge h ON h.entity_id = head_id JOIN ge t2 ON t2.entity_id = tail_id
            WHERE n >= 2 AND head_id = {_EID} ORDER BY ratio DESC, recent_docs DESC, h.name, t2.name, label LIMIT 15""",
    ),
    "ols_slope": (
        lambda spark, sf_dir: rounded(adapters.graph(spark, sf_dir)["entity_years"].groupBy("entity_id").agg(slope(F.col("n_docs"), F.col("year")).alias("slope"))),
        "SELECT entity_id, round(coalesce(regr_slope(n_docs, year), 0.0), 6) AS slope FROM ny GROUP BY entity_id",
    ),
    "export_edges": (
        _graph(lambda g: g.export_edges(2, 1997).withColumn("years", F.array_join(F.transform("years", lambda x: F.concat_ws(":", x["year"], x["n_docs"])), " ")).withColumns({c: F.round(c, 3) for c in ("mean_confidence", "combined_confidence")})),
        """SELECT head_id, tail_id, label, w.n_docs, round(mean_confidence, 3) AS mean_confidence, round(combined_confidence, 3) AS combined_confidence,
            CAST(w.first_year AS BIGINT) AS first_year, CAST(w.last_year AS BIGINT) AS last_year, years
            FROM (SELECT head_id, tail_id, label, round(mean_confidence, 4) AS mean_confidence, round(combined_confidence, 4) AS combined_confidence FROM ed) JOIN (SELECT head_id, tail_id, label, CAST(sum(n_docs) AS BIGINT) AS n_docs, min(year) AS first_year, max(year) AS last_year,
                  string_agg(year || ':' || n_docs, ' ' ORDER BY year) AS years FROM ey WHERE year >= 1997 GROUP BY ALL) w USING (head_id, tail_id, label) WHERE w.n_docs >= 2""",
    ),
    "export_nodes": (
        _graph(lambda g: g.export_nodes(8)),
        f"SELECT entity_id, name, type, matched AS normalized, n_docs FROM ({_ENTITY}) WHERE entity_id IN (SELECT unnest([head_id, tail_id]) FROM (SELECT head_id, tail_id, label, sum(n_docs) AS n FROM ey GROUP BY ALL) WHERE n >= 8)",
    ),
    "stats_languages": (_graph(lambda g: g.language_counts(3)), "SELECT languages, count(*) AS n_docs FROM gd GROUP BY languages ORDER BY n_docs DESC, languages LIMIT 3"),
    "stats_scope": (_graph(lambda g: g.scope_counts()), "SELECT coalesce(nlp_scope, 'not extracted') AS nlp_scope, count(*) AS n_docs FROM gd GROUP BY 1"),
    "stats_match_rate": (_graph(lambda g: g.match_rate()), "SELECT count(*) AS n_mentions, count(*) FILTER (matched) AS n_matched, round(count(*) FILTER (matched) / count(*), 6) AS match_rate FROM gm JOIN ge USING (entity_id)"),
    "stats_tables": (_graph(lambda g: g.table_counts()), "SELECT 'documents' AS \"table\", count(*) AS n FROM gd UNION ALL SELECT 'entities', count(*) FROM ge UNION ALL SELECT 'relations', count(*) FROM gr UNION ALL SELECT 'edges', count(*) FROM ed"),
    "upsert_documents": (
        _upsert,
        """SELECT pmid, CAST(CASE WHEN coalesce(year >= 1998, true) THEN year + 2 ELSE year END AS BIGINT) AS year,
            CASE WHEN s THEN 'first' ELSE 'second' END AS query_label, CASE WHEN s THEN nlp_scope END AS nlp_scope, s AS extracted
            FROM (SELECT *, coalesce(year <= 1999, false) AS s FROM gd)""",
    ),
    "replace_extraction": (_replace, "SELECT pmid, entity_id, count(*) AS n FROM gm WHERE CAST(pmid AS BIGINT) % 4 <> 0 OR sentence_index = 1 GROUP BY ALL"),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v[0] for k, v in _G.items()}
SQL: dict[str, str] = {k: ("WITH " + adapters.sql_base() + (", " + v[1].removeprefix("WITH ") if v[1].startswith("WITH ") else " " + v[1])) for k, v in _G.items()}
QUERIES |= {"plan_queries": _plan, "first_label_wins": _first_label}
SQL |= {
    "plan_queries": """SELECT r_name AS label, year, kind, CASE kind WHEN 'yearly' THEN 30 ELSE 3 END AS retmax,
            lower(r_name) || ' AND hasabstract AND ' || year || '[dp]' || CASE kind WHEN 'yearly' THEN '' ELSE ' NOT english[Language]' END AS term,
            row_number() OVER (ORDER BY r_regionkey, year, kind DESC) - 1 AS ordinal
        FROM region CROSS JOIN (SELECT unnest(range(2005, 2009)) AS year) CROSS JOIN (SELECT unnest(['yearly', 'non_english']) AS kind)""",
    "first_label_wins": "SELECT CAST(l_partkey AS VARCHAR) AS pmid, 's' || min(l_suppkey) AS query_label FROM lineitem GROUP BY l_partkey",
}
QUERIES |= catalog_text.QUERIES | catalog_files.QUERIES
SQL |= catalog_text.SQL | catalog_files.SQL
