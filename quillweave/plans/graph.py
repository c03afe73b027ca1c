"""Read queries over the graph. Each returns a lazy DataFrame; arguments are checked before a plan is made."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.stats import ratio, slope
from quillweave.operators.evidence import EDGE


def _first(df: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """Ordered, and limited if asked: the two together are one distributed top-k."""
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


class KnowledgeGraph:
    """Tables by name: documents, relations, entities, and those of operators.evidence.graph_tables."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def _window(self, years: DataFrame, since: int | None, until: int | None) -> DataFrame:
        """Rows whose year is in the window; a null year never is. A side that isn't asked for puts no filter in the scan."""
        years = years.where(F.col("year").isNotNull())
        years = years if since is None else years.where(F.col("year") >= since)
        return years if until is None else years.where(F.col("year") <= until)

    def entities(self) -> DataFrame:
        """Entities with their document and mention counts, 0 where nothing mentions them."""
        stats = self["entity_stats"].select("entity_id", "n_docs", "n_mentions")
        zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        return self["entities"].join(stats, "entity_id", "left").select("entity_id", "type", "name", "matched", zero("n_docs"), zero("n_mentions"))

    def find_entities(self, term: str, limit: int = S.FIND_LIMIT) -> DataFrame:
        """Entities with that id or (in any case) name; if there is none, those whose name is LIKE %term%.

        One plan: both kinds are found in one scan and only the better kind stays. Wildcards in the term work as such.
        """
        term = term.strip()
        if not term:
            raise ValueError("the term is empty")
        name, low = F.lower("name"), F.lower(F.lit(term))
        exact = (F.col("entity_id") == term) | (name == low)
        pattern = F.lower(F.lit("%" + term.replace("\\", "\\\\") + "%"))
        found = self["entities"].where(exact | F.like(name, pattern)).withColumn("_exact", exact.cast("int"))
        best = found.groupBy().agg(F.max("_exact").alias("_best"))  # one row
        found = found.join(F.broadcast(best), F.col("_exact") == F.col("_best")).drop("_exact", "_best")
        counted = KnowledgeGraph({**self.tables, "entities": found}).entities()
        return _first(counted, limit, F.col("n_docs").desc(), F.col("entity_id"))

    def neighbors(self, entity_id: str, since: int | None = None, until: int | None = None, label: str | None = None, min_docs: int = 1, limit: int = S.QUERY_LIMIT) -> DataFrame:
        """Edges of an entity, summed over the years of the window, most documents first."""
        S.check_years(since, until)
        S.check_choice(label, S.RELATION_LABELS, "label")
        touching = self._window(self["edge_years"], since, until).where((F.col("head_id") == entity_id) | (F.col("tail_id") == entity_id))
        touching = touching if label is None else touching.where(F.col("label") == label)
        n = F.sum("n_docs")
        summed = touching.groupBy(*EDGE).agg(n.alias("n_docs"), (F.sum(F.col("n_docs") * F.col("mean_confidence")) / n).alias("mean_confidence"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
        other = F.when(F.col("head_id") == entity_id, F.col("tail_id")).otherwise(F.col("head_id"))
        summed = summed.where(F.col("n_docs") >= min_docs).withColumn("neighbor_id", other)
        named = summed.join(self["entities"].select(F.col("entity_id").alias("neighbor_id"), F.col("name").alias("neighbor_name"), F.col("type").alias("neighbor_type")), "neighbor_id")
        named = named.select(F.lit(entity_id).alias("entity_id"), "neighbor_id", "neighbor_name", "neighbor_type", "label", "n_docs", "mean_confidence", "first_year", "last_year")
        return _first(named, limit, F.col("n_docs").desc(), F.col("mean_confidence").desc(), F.col("neighbor_id"), F.col("label"))

    def evidence_sentences(self, a: str, b: str, since: int | None = None, limit: int = S.EVIDENCE_LIMIT) -> DataFrame:
        """Sentences that relate two entities, in either direction, surest first. No confidence is too low."""
        S.check_years(since)
        pair = ((F.col("head_id") == a) & (F.col("tail_id") == b)) | ((F.col("head_id") == b) & (F.col("tail_id") == a))
        found = self._sentences(self["relations"].where(pair), since)
        return _first(found, limit, F.col("confidence").desc(), F.col("pmid"), F.col("sentence_index"), F.col("label")).select("pmid", "year", "label", "confidence", "sentence")

    def _sentences(self, relations: DataFrame, since: int | None) -> DataFrame:
        dated = relations.where(F.col("label") != S.NO_RELATION).join(self["documents"].select("pmid", "year"), "pmid")
        return dated if since is None else dated.where(F.col("year") >= since)

    def neighbors_with_evidence(self, entity_id: str, n_evidence: int = 3, **window) -> DataFrame:
        """neighbors, each with its surest sentences: one join and one ranked window instead of a query per neighbour."""
        found = self.neighbors(entity_id, **window)
        touching = self["relations"].where((F.col("head_id") == entity_id) | (F.col("tail_id") == entity_id))
        other = F.when(F.col("head_id") == entity_id, F.col("tail_id")).otherwise(F.col("head_id"))
        pairs = found.select("neighbor_id").distinct()
        lines = self._sentences(touching, window.get("since")).withColumn("neighbor_id", other).join(pairs, "neighbor_id", "left_semi")
        rank = F.row_number().over(W.partitionBy("neighbor_id").orderBy(F.col("confidence").desc(), "pmid", "sentence_index", "label"))
        lines = lines.withColumn("rank", rank).where(F.col("rank") <= n_evidence)
        lines = lines.groupBy("neighbor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "pmid", "year", "label", "confidence", "sentence"))).alias("evidence"))
        return found.join(lines, "neighbor_id", "left")

    def top_entities(self, entity_type: str | None = None, since: int | None = None, limit: int = S.QUERY_LIMIT) -> DataFrame:
        """Entities by the documents that mention them, from a year on."""
        S.check_years(since)
        S.check_choice(entity_type, S.ENTITY_TYPES, "type")
        named = self["entities"] if entity_type is None else self["entities"].where(F.col("type") == entity_type)
        summed = self._window(self["entity_years"], since, None).groupBy("entity_id").agg(F.sum("n_docs").alias("n_docs"))
        found = summed.join(named.select("entity_id", "name", "type"), "entity_id").select("entity_id", "name", "type", "n_docs")
        return _first(found, limit, F.col("n_docs").desc(), F.col("name"), F.col("entity_id"))

    def entity_series(self, entity_id: str) -> DataFrame:
        """(year, documents, documents per 1,000 processed ones); a year without processed documents has rate 0."""
        totals = self["year_docs"].select("year", F.col("n_docs").alias("total"))
        own = self["entity_years"].where(F.col("entity_id") == entity_id).join(totals, "year", "left")
        return own.select("year", "n_docs", ratio(F.col("n_docs") * S.RATE_PER, F.col("total")).alias("rate")).orderBy("year")

    def emergence(self, counts: DataFrame, key: list[str], recent_years: int = S.RECENT_YEARS) -> DataFrame:
        """Per key of counts (key, year, n_docs): how often it is reported in the last recent_years processed years and
        before, as documents, as rates per 1,000, as the add-one ratio of rates, and the slope of the yearly rate.

        Years are those with processed documents; where a key has no row there, it counts 0, and its rows of other years
        count for nothing. Instead of a row for each key and year, the sums over all years come from the year table itself
        (one row), and the slope from sums over the key's own years: counts are shuffled once, by key.
        """
        S.check_least(recent_years, 1, "recent_years")
        totals = self["year_docs"].where(F.col("n_docs") > 0).select(F.col("year").alias("y"), F.col("n_docs").alias("total"))
        last = totals.groupBy().agg(F.max("y").alias("last"))
        x = F.col("y").cast("double")
        late = F.col("y") > F.col("last") - recent_years
        whole = totals.join(F.broadcast(last)).groupBy().agg(
            F.sum(F.when(late, F.col("total"))).alias("recent_total"), F.sum(F.when(~late, F.col("total"))).alias("early_total"), F.count("*").alias("years"),
            F.avg(x).alias("mean_x"), F.var_pop(x).alias("var_x"), F.max("last").alias("last"),
        )
        seen = counts.join(F.broadcast(totals), F.col("year") == F.col("y"), "left").join(F.broadcast(whole))
        rate = F.col("n_docs") * S.RATE_PER / F.col("total")
        known = F.col("total").isNotNull()
        sums = seen.groupBy(*key).agg(
            F.sum("n_docs").alias("n_docs"),
            F.coalesce(F.sum(F.when(known & ~late, F.col("n_docs"))), F.lit(0)).alias("early_docs"), F.coalesce(F.sum(F.when(known & late, F.col("n_docs"))), F.lit(0)).alias("recent_docs"),
            F.coalesce(F.sum(F.when(known, (x - F.col("mean_x")) * rate)), F.lit(0.0)).alias("cross"),
            *(F.first(c).alias(c) for c in ("recent_total", "early_total", "years", "var_x")),
        )
        early, recent = F.coalesce("early_total", F.lit(0)), F.coalesce("recent_total", F.lit(0))
        smooth = lambda docs, total: (F.col(docs) + 1).cast("double") / (total + 1)
        return sums.select(
            *key, "n_docs", "early_docs", "recent_docs",
            ratio(F.col("early_docs") * S.RATE_PER, early).alias("early_rate"), ratio(F.col("recent_docs") * S.RATE_PER, recent).alias("recent_rate"),
            F.when(F.col("early_total").isNull(), F.lit(1.0)).otherwise(smooth("recent_docs", recent) / smooth("early_docs", early)).alias("rate_ratio"),
            ratio(F.col("cross"), F.col("var_x") * F.col("years")).alias("slope"),
        )

    def edge_trends(self, entity_id: str | None = None, recent_years: int = S.RECENT_YEARS, min_docs: int = S.TREND_MIN_DOCS, limit: int | None = None) -> DataFrame:
        """Edges with enough documents, those that are reported more lately first, with their yearly series."""
        S.check_least(min_docs, 1, "min_docs")
        years = self["edge_years"].select(*EDGE, "year", "n_docs")
        if entity_id is not None:
            years = years.where((F.col("head_id") == entity_id) | (F.col("tail_id") == entity_id))
        name = lambda side: self["entities"].select(F.col("entity_id").alias(f"{side}_id"), F.col("name").alias(f"{side}_name"))
        series = years.groupBy(*EDGE).agg(F.array_sort(F.collect_list(F.struct("year", "n_docs"))).alias("series"), F.sum("n_docs").alias("n")).where(F.col("n") >= min_docs).drop("n")
        found = self.emergence(years, list(EDGE), recent_years).where(F.col("n_docs") >= min_docs).join(series, list(EDGE)).join(name("head"), "head_id").join(name("tail"), "tail_id")
        found = found.select("head_id", "head_name", "tail_id", "tail_name", "label", "series", "early_docs", "recent_docs", "early_rate", "recent_rate", "rate_ratio", "slope")
        return _first(found, limit, F.col("rate_ratio").desc(), F.col("recent_docs").desc(), F.col("head_name"), F.col("tail_name"), F.col("label"))

    def export_edges(self, min_docs: int = 1, since: int | None = None) -> DataFrame:
        """Edges for a graph file: documents and years of the window, confidences of all time (4 places)."""
        S.check_least(min_docs, 1, "min_docs")
        window = self._window(self["edge_years"], since, None).groupBy(*EDGE).agg(
            F.sum("n_docs").alias("n_docs"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.array_sort(F.collect_list(F.struct("year", "n_docs"))).alias("years"),
        )
        kept = self["edges"].select(*EDGE, F.bround("mean_confidence", 4).alias("mean_confidence"), F.bround("combined_confidence", 4).alias("combined_confidence"))
        return kept.join(window.where(F.col("n_docs") >= min_docs), list(EDGE))

    def export_nodes(self, min_docs: int = 1, since: int | None = None) -> DataFrame:
        """The end points of the exported edges; one that isn't an entity is named by its id, of type Unknown."""
        used = self.export_edges(min_docs, since)
        ids = used.select(F.col("head_id").alias("entity_id")).union(used.select("tail_id")).distinct()
        known = self.entities().select("entity_id", "name", "type", "matched", "n_docs")
        return ids.join(known, "entity_id", "left").select(
            "entity_id", F.coalesce("name", "entity_id").alias("name"), F.coalesce("type", F.lit("Unknown")).alias("type"),
            F.coalesce("matched", F.lit(False)).alias("normalized"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        )

    def language_counts(self, limit: int = S.LANGUAGES_SHOWN) -> DataFrame:
        """Documents by their list of languages, as stored."""
        named = self["documents"].select(F.array_join("languages", ",").alias("languages"))
        return _first(named.groupBy("languages").agg(F.count("*").alias("n_docs")), limit, F.col("n_docs").desc(), F.col("languages"))

    def scope_counts(self) -> DataFrame:
        return self["documents"].groupBy(F.coalesce("nlp_scope", F.lit("not extracted")).alias("nlp_scope")).agg(F.count("*").alias("n_docs"))

    def match_rate(self) -> DataFrame:
        """Mentions of known entities and the share of those with a vocabulary id, 0.0 if there are none. Mentions are
        counted per entity before they meet the entities."""
        per_entity = self["mentions"].groupBy("entity_id").agg(F.count("*").alias("n"))
        joined = per_entity.join(self["entities"].select("entity_id", "matched"), "entity_id")
        return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_mentions"), F.coalesce(F.sum(F.when(F.col("matched"), F.col("n"))), F.lit(0)).alias("n_matched")).withColumn("match_rate", ratio(F.col("n_matched"), F.col("n_mentions")))

    def table_counts(self) -> DataFrame:
        """Rows of documents, entities, relations and edges."""
        names = ("documents", "entities", "relations", "edges")
        parts = [self[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("table"), "n") for n in names]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out


class StoredGraph(KnowledgeGraph):
    """A graph whose edges are stored under each end too (operators.maintenance.adjacency_rows): `adjacent` gives an entity's."""

    def __init__(self, tables: Mapping[str, DataFrame], adjacent: Callable[[str], DataFrame]):
        super().__init__(tables)
        self.adjacent = adjacent

    def neighbors(self, entity_id: str, since: int | None = None, until: int | None = None, label: str | None = None, min_docs: int = 1, limit: int = S.QUERY_LIMIT) -> DataFrame:
        """The same rows as from the year table, without a shuffle: a row holds an edge's years, and its neighbour's name as it was
        when the graph was last built or refreshed."""
        S.check_years(since, until)
        S.check_choice(label, S.RELATION_LABELS, "label")
        low, high = S.FIRST_YEAR - (1 << 20) if since is None else since, S.LAST_YEAR + (1 << 20) if until is None else until
        rows = self.adjacent(entity_id)
        rows = rows if label is None else rows.where(F.col("label") == label)
        rows = rows.withColumn("s", F.filter("series", lambda p: p["year"].between(low, high))).where(F.size("s") > 0)
        docs = F.aggregate("s", F.lit(0).cast("long"), lambda total, p: total + p["n_docs"])
        confidence = F.aggregate("s", F.lit(0.0), lambda total, p: total + p["sum_confidence"].cast("double"))
        summed = rows.select(F.lit(entity_id).alias("entity_id"), "neighbor_id", "neighbor_name", "neighbor_type", "label", docs.alias("n_docs"), confidence.alias("c"), F.get("s", F.lit(0))["year"].alias("first_year"), F.try_element_at("s", F.lit(-1))["year"].alias("last_year"))
        found = summed.where(F.col("n_docs") >= min_docs).select("entity_id", "neighbor_id", "neighbor_name", "neighbor_type", "label", "n_docs", (F.col("c") / F.col("n_docs")).alias("mean_confidence"), "first_year", "last_year")
        return _first(found, limit, F.col("n_docs").desc(), F.col("mean_confidence").desc(), F.col("neighbor_id"), F.col("label"))
