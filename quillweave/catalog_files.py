"""Queries of the catalog that write files first and read them back: a store with deltas, articles, vocabularies and a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.catalog_text import _lexicon, _plain
from quillweave.operators.dictionary import Dictionary
from quillweave.operators.shared import shared_folder
from quillweave.operators.store import Store
from quillweave.plans import extract
from quillweave.sources import adapters, lexicon, pubmed, pubtator

#: Orders from this year on are stored wrongly first, then replaced.
LATE = 1997


def _built(spark: SparkSession, sf_dir: str) -> Store:
    """A store whose graph was made of orders that, from LATE on, had another year and only their first sentences, and was brought up to
    date by deltas when those were replaced."""
    store = Store(spark, shared_folder(spark, "store"), buckets=8)
    docs, rows = adapters.documents(spark, sf_dir), {"mentions": adapters.mentions(spark, sf_dir), "relations": adapters.relations(spark, sf_dir)}
    late = F.coalesce(F.col("year") >= LATE, F.lit(False))
    article = lambda df: df.select("pmid", F.lit("").alias("title"), F.lit("").alias("abstract"), "year", "languages", F.lit("").alias("journal"), F.lit("").alias("vernacular_title"), F.array().cast("array<struct<language:string,text:string>>").alias("other_abstracts"), F.lit("q").alias("query_label"))
    entities = adapters.entities(spark, sf_dir).withColumn("ordinal", F.lit("0"))
    of = lambda name, keep: rows[name].join(docs.select("pmid", "year").hint("merge"), "pmid").where(keep).drop("year")
    store.upsert(article(docs.withColumn("year", F.when(late, F.col("year") - 1).otherwise(F.col("year")))))
    first = ~late | (F.col("sentence_index") == 1)
    store.save_extraction(docs.select("pmid", "nlp_scope"), of("mentions", first), of("relations", first), entities)
    store.build_graph()
    store.upsert(article(docs.where(late)))
    store.save_extraction(docs.where(late).select("pmid", "nlp_scope"), of("mentions", late), of("relations", late), entities.limit(0))
    store.refresh_graph()
    return store


def graph_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived tables of the store as rows (table, key, n_docs, value, first_year, last_year)."""
    snapshot = _built(spark, sf_dir).snapshot()
    none = F.lit(None).cast("int")

    def rows(name: str, keys: list[str], value: Column, first: Column = none, last: Column = none) -> DataFrame:
        return snapshot.table(name).select(F.lit(name).alias("table"), F.concat_ws("|", *keys).alias("key"), "n_docs", value.cast("double").alias("value"), first.alias("first_year"), last.alias("last_year"))

    edge, years = ["head_id", "tail_id", "label"], (F.col("first_year"), F.col("last_year"))
    parts = [rows("edges", edge, F.col("combined_confidence"), *years), rows("edge_years", [*edge, "year"], F.col("mean_confidence")), rows("entity_stats", ["entity_id"], F.col("n_mentions"), *years), rows("entity_years", ["entity_id", "year"], none), rows("year_docs", ["year"], none)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _plain(out)


def graph_refreshed_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a delta can't subtract: each edge's largest confidence, and its sentences, in the store."""
    return _plain(_built(spark, sf_dir).snapshot().table("edges").select("head_id", "tail_id", "label", "n_sentences", "max_confidence", "mean_confidence"))


def neighbors_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours of the first brand by name, from the store's edges by end."""
    first = adapters.table(spark, sf_dir, "part").agg(F.min(F.concat(F.lit("brand:"), "p_brand"))).first()[0]
    return _plain(_built(spark, sf_dir).graph().neighbors(first, since=1995, limit=1000))


def names_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by a part of their names with a wildcard, from the trigram index."""
    store = Store(spark, shared_folder(spark, "names"), buckets=8)
    store.save(entities=adapters.entities(spark, sf_dir))
    store.index_names()
    return store.search_names("RAN%#1")


def dictionary_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names in a sentence of each order's lines, as they are, in capitals and the plural, turned round, or after another word."""
    lines = adapters.table(spark, sf_dir, "lineitem").join(adapters.table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    way, words = F.col("l_linenumber") % 4, F.split("p_name", " ")
    said = F.when(way == 1, F.concat(F.upper("p_name"), F.lit("S"))).when(way == 2, F.array_join(F.reverse(words), " ")).when(way == 3, F.concat(F.lit("no "), "p_name")).otherwise(F.col("p_name"))
    sentence = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", said.alias("said")))).alias("x"))
    sentence = sentence.select(F.col("l_orderkey").cast("string").alias("pmid"), F.lit(0).alias("index"), F.concat(F.lit("Order holds "), F.array_join(F.transform("x", lambda v: v["said"]), ", ")).alias("text"))
    tagged = Dictionary(_lexicon(spark, sf_dir)).tag(sentence)
    return _plain(tagged.select("pmid", F.posexplode("spans").alias("n", "s")).select("pmid", "n", "s.start", "s.end", "s.label", "s.text"))


def articles_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as article records, read back by ranges."""
    folder = shared_folder(spark, "articles")
    o = adapters.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    record = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID>"), key, F.lit("</PMID><Article><Journal><JournalIssue><PubDate><Year>"), F.coalesce(F.year("o_orderdate").cast("string"), F.lit("")),
        F.lit("</Year></PubDate></JournalIssue><Title>"), F.coalesce("o_orderpriority", F.lit("")), F.lit("</Title></Journal>\n<ArticleTitle>Order <i>"), key, F.lit("</i> &amp; "), F.coalesce("o_orderstatus", F.lit("")),
        F.lit("</ArticleTitle><Language>eng</Language></Article></MedlineCitation></PubmedArticle>"),
    )
    o.select(record.alias("value")).write.text(folder)
    return _plain(pubmed.read(spark, folder).select("pmid", "title", "year", "journal", F.array_join("languages", ",").alias("languages")))


def gene_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a gene table and read back as a vocabulary."""
    folder, part, none = shared_folder(spark, "genes"), adapters.table(spark, sf_dir, "part"), F.lit("")
    key = F.col("p_partkey").cast("string")
    table = part.select(
        F.concat(F.lit("HGNC:"), key).alias("hgnc_id"), F.col("p_name").alias("symbol"), F.concat_ws(" ", "p_brand", "p_type").alias("name"), F.concat_ws("|", "p_type", none, "p_brand").alias("alias_symbol"),
        none.alias("alias_name"), F.upper("p_name").alias("prev_symbol"), none.alias("prev_name"), F.when(F.col("p_partkey") % 2 == 0, key).otherwise("").alias("entrez_id"),
    )
    table.write.options(sep="\t", header=True, quote="", emptyValue="").csv(folder)
    return _plain(lexicon.read_genes(spark, folder).select("type", "surface", "entity_id", "name", "priority"))


def disease_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a disease table and read back as a vocabulary."""
    folder, part = shared_folder(spark, "diseases"), adapters.table(spark, sf_dir, "part")
    row = F.concat_ws("\t", "p_name", F.concat(F.lit("MESH:"), "p_brand"), F.lit(""), F.concat_ws("|", "p_type", F.upper("p_name")))
    spark.createDataFrame([("# made of parts",), ("# Fields:",), ("# DiseaseName\tDiseaseID\tAltDiseaseIDs\tSynonyms",), ("#",)], "value string").coalesce(1).write.text(folder)
    part.select(row.alias("value")).write.mode("append").text(folder)
    return _plain(lexicon.read_ctd(spark, folder, S.DISEASE, "DiseaseID", "DiseaseName").select("type", "surface", "entity_id", "name", "priority"))


def _corpus(spark: SparkSession, sf_dir: str) -> pubtator.Corpus:
    """Orders as annotated documents: the word Order, the priority and the status are a gene, a disease and a chemical."""
    o = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"))
    at = F.length("k") + 7
    end, last = at + F.length("p"), at + F.length("p") + 16
    line = lambda *fields: F.concat_ws("\t", "k", *(f if isinstance(f, Column) else F.lit(f) for f in fields))
    gene, disease, chemical = F.concat(F.lit("G"), "s"), F.concat(F.lit("D"), F.substring("p", 1, 1)), F.concat(F.lit("C"), "s")
    n = lambda c: c.cast("string")
    linked = F.when(F.col("s") == "P", line("Negative_Correlation", disease, chemical, "No")).when(F.col("s") == "F", line("Association", gene, disease, "No")).otherwise(line("Bind", chemical, gene, "Novel"))
    block = F.concat_ws(
        "\n", F.concat("k", F.lit("|t|Order "), "k"), F.concat("k", F.lit("|a|"), "p", F.lit(" is linked with "), "s", F.lit(".")), line("0", "5", "Order", "GeneOrGeneProduct", gene),
        line(n(at), n(end), F.col("p"), "DiseaseOrPhenotypicFeature", F.concat(disease, F.lit(",-"))), line(n(last), n(last + F.length("s")), F.col("s"), "ChemicalEntity", chemical), line("0", "5", "Order", "OrganismTaxon", "9"), linked, line("Odd", gene, disease, "No"),
    )
    folder = shared_folder(spark, "corpus")
    o.select(F.concat(block, F.lit("\n")).alias("value")).write.text(folder)
    return pubtator.read(spark, folder)


def corpus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations in scope: entities by their offsets, relations by their ids."""
    c = _corpus(spark, sf_dir)
    entities = c.entities.select("pmid", F.lit("entity").alias("kind"), "start", "end", "text", "label", F.array_join("ids", ",").alias("ids"))
    none = F.lit(None).cast("int")
    return _plain(entities.unionByName(c.relations.select("pmid", F.lit("relation").alias("kind"), none.alias("start"), none.alias("end"), F.lit("").alias("text"), "label", F.concat_ws(",", "id1", "id2").alias("ids"))))


def ner_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _corpus(spark, sf_dir)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("/", s["start"], s["end"], s["label"], s["text"])), " ")
    return _plain(extract.ner_examples(c.documents, c.entities).select("pmid", "index", "text", spans.alias("spans")))


def relation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(extract.annotated_examples(_corpus(spark, sf_dir).blocks))


_KEY = "head_id || '|' || tail_id || '|' || label"
_SPLIT = "CAST(o_orderkey AS VARCHAR) AS pmid, o_orderpriority AS p, o_orderstatus AS s, length(CAST(o_orderkey AS VARCHAR)) + 7 AS pos"

QUERIES = {f.__name__: f for f in (graph_refreshed, graph_refreshed_maxima, neighbors_stored, names_search, dictionary_tags, articles_scan, gene_vocabulary, disease_vocabulary, corpus_rows, ner_sentences, relation_pairs)}
SQL = {
    "graph_refreshed": f"""WITH {adapters.sql_base()}
        SELECT 'edges' AS "table", {_KEY} AS key, n_docs, round(combined_confidence, 6) AS value, CAST(first_year AS BIGINT) AS first_year, CAST(last_year AS BIGINT) AS last_year FROM ed
        UNION ALL SELECT 'edge_years', {_KEY} || '|' || year, n_docs, round(mean_confidence, 6), NULL, NULL FROM ey
        UNION ALL SELECT 'entity_stats', entity_id, n_docs, CAST(n_mentions AS DOUBLE), first_year, last_year FROM es
        UNION ALL SELECT 'entity_years', entity_id || '|' || year, n_docs, NULL, NULL, NULL FROM ny
        UNION ALL SELECT 'year_docs', CAST(year AS VARCHAR), n_docs, NULL, NULL, NULL FROM yd""",
    "graph_refreshed_maxima": f"WITH {adapters.sql_base()} SELECT head_id, tail_id, label, n_sentences, round(max_confidence, 6) AS max_confidence, round(mean_confidence, 6) AS mean_confidence FROM ed",
    "neighbors_stored": f"""WITH {adapters.sql_base()}, me AS (SELECT 'brand:' || min(p_brand) AS id FROM part)
        SELECT id AS entity_id, neighbor_id, name AS neighbor_name, type AS neighbor_type, label, n_docs, round(mean, 6) AS mean_confidence, CAST(first_year AS BIGINT) AS first_year, CAST(last_year AS BIGINT) AS last_year
        FROM (SELECT id, CASE WHEN head_id = id THEN tail_id ELSE head_id END AS neighbor_id, label, CAST(sum(n_docs) AS BIGINT) AS n_docs,
                     sum(n_docs * mean_confidence) / sum(n_docs) AS mean, min(year) AS first_year, max(year) AS last_year
              FROM ey, me WHERE (head_id = id OR tail_id = id) AND year >= 1995 GROUP BY id, head_id, tail_id, label)
        JOIN ge ON entity_id = neighbor_id ORDER BY n_docs DESC, mean DESC, neighbor_id, label LIMIT 1000""",
    "names_search": f"WITH {adapters.sql_base()} SELECT entity_id, type, name, matched FROM ge WHERE lower(name) LIKE '%ran%#1%'",
    "dictionary_tags": """
        WITH one AS (SELECT p_name, bool_or(p_type = 'ECONOMY') AS gene FROM part GROUP BY p_name),
             many AS (SELECT p_name, bool_or(p_type = 'ECONOMY') AS gene FROM part WHERE p_partkey % 2 = 0 GROUP BY p_name),
             said AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber % 4 AS way, p_name,
                             CASE l_linenumber % 4 WHEN 1 THEN upper(p_name) || 'S' WHEN 2 THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ') WHEN 3 THEN 'no ' || p_name ELSE p_name END AS said
                      FROM lineitem JOIN part ON l_partkey = p_partkey),
             placed AS (SELECT *, row_number() OVER w - 1 AS n, 12 + coalesce(sum(length(said) + 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
                        FROM said WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, said))
        SELECT CAST(l_orderkey AS VARCHAR) AS pmid, n, CAST(pos + CASE way WHEN 3 THEN 3 ELSE 0 END AS BIGINT) AS start, CAST(pos + length(said) AS BIGINT) AS "end",
               CASE WHEN coalesce(CASE way WHEN 1 THEN many.gene END, one.gene) THEN 'Gene' ELSE 'Chemical' END AS label, CASE way WHEN 3 THEN p_name ELSE said END AS text
        FROM placed JOIN one USING (p_name) LEFT JOIN many USING (p_name)""",
    "articles_scan": "SELECT CAST(o_orderkey AS VARCHAR) AS pmid, 'Order ' || o_orderkey || ' & ' || o_orderstatus AS title, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS journal, 'eng' AS languages FROM orders",
    "gene_vocabulary": """
        WITH p AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'NCBIGene:' || p_partkey ELSE 'HGNC:' || p_partkey END AS entity_id,
                          unnest([{'s': p_name, 'n': 0}, {'s': p_brand || ' ' || p_type, 'n': 0}, {'s': upper(p_name), 'n': 1}, {'s': p_type, 'n': 2}, {'s': p_brand, 'n': 2}]) AS e FROM part)
        SELECT 'Gene' AS type, e.s AS surface, entity_id, p_name AS name, CAST(e.n AS BIGINT) AS priority FROM p""",
    "disease_vocabulary": """
        SELECT 'Disease' AS type, e.s AS surface, 'MESH:' || p_brand AS entity_id, p_name AS name, CAST(e.n AS BIGINT) AS priority
        FROM (SELECT *, unnest([{'s': p_name, 'n': 0}, {'s': p_type, 'n': 1}, {'s': upper(p_name), 'n': 1}]) AS e FROM part)""",
    "corpus_rows": f"""
        WITH o AS (SELECT {_SPLIT} FROM orders)
        SELECT pmid, 'entity' AS kind, CAST(0 AS BIGINT) AS start, CAST(5 AS BIGINT) AS "end", 'Order' AS text, 'Gene' AS label, 'G' || s AS ids FROM o
        UNION ALL SELECT pmid, 'entity', pos, pos + length(p), p, 'Disease', 'D' || substr(p, 1, 1) FROM o
        UNION ALL SELECT pmid, 'entity', pos + length(p) + 16, pos + length(p) + 16 + length(s), s, 'Chemical', 'C' || s FROM o
        UNION ALL SELECT pmid, 'relation', NULL, NULL, '', CASE s WHEN 'P' THEN 'Negative_Correlation' ELSE 'Association' END,
                         CASE s WHEN 'P' THEN 'D' || substr(p, 1, 1) || ',C' || s WHEN 'F' THEN 'G' || s || ',D' || substr(p, 1, 1) ELSE 'C' || s || ',G' || s END FROM o""",
    "ner_sentences": f"""
        WITH o AS (SELECT {_SPLIT} FROM orders)
        SELECT pmid, CAST(0 AS BIGINT) AS "index", 'Order ' || pmid AS text, '0/5/Gene/Order' AS spans FROM o
        UNION ALL SELECT pmid, 1, p || ' is linked with ' || s || '.', '0/' || length(p) || '/Disease/' || p || ' ' || (length(p) + 16) || '/' || (length(p) + 16 + length(s)) || '/Chemical/' || s FROM o""",
    "relation_pairs": f"""
        WITH o AS (SELECT {_SPLIT} FROM orders)
        SELECT pmid, CAST(1 AS BIGINT) AS sentence_index, '[E2] ' || p || ' [/E2] is linked with [E1] ' || s || ' [/E1].' AS text, 'C' || s AS head_key, 'D' || substr(p, 1, 1) AS tail_key,
               'Chemical' AS head_type, 'Disease' AS tail_type, CASE s WHEN 'P' THEN 'Negative_Correlation' ELSE 'None' END AS label FROM o""",
}
