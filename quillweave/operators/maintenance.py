"""The graph's derived tables kept up to date by deltas: what replaced documents gave is taken off, what they give now is added.

Sums that must come out the same in any order and after any number of changes are exact: confidences, and the logarithms of their
complements, are summed as decimals. Numbers of documents go up and down; first and last years come from the years that are left; only the largest
confidence can't be taken back, so it is looked up again, in the touched buckets, for edges that lose theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.stats import in_unit_range
from quillweave.operators import evidence
from quillweave.operators.evidence import EDGE

EXACT = "decimal(38,18)"
PAIR = ("pmid", "head_id", "tail_id")
#: What a table has beside its public columns.
STATE = {"edges": ("sum_confidence", "log_miss", "n_sure"), "edge_years": ("sum_confidence",)}
KEYS = {"evidence": list(EDGE), "edges": list(EDGE), "edge_years": list(EDGE), "entity_stats": ["entity_id"], "entity_years": ["entity_id"], "adjacency": ["entity_id"]}
#: What an edge is called from one of its ends.
END = ("entity_id", "neighbor_id", "is_head", "label")


def signed(minus: DataFrame, plus: DataFrame) -> DataFrame:
    """Rows with `sign` -1 or 1; rows that are on both sides as often as on the other are no change."""
    both = minus.withColumn("sign", F.lit(-1)).unionByName(plus.withColumn("sign", F.lit(1)))
    return both.groupBy(*minus.columns).agg(F.sum("sign").cast("int").alias("sign")).where(F.col("sign") != 0)


def _weighed(rows: DataFrame) -> DataFrame:
    c = in_unit_range(F.col("confidence"))
    miss = F.when(c < 1.0, F.log1p(-c)).otherwise(0.0)
    return rows.withColumns({"_sum": c.cast(EXACT), "_log": miss.cast(EXACT), "_sure": (c >= 1.0).cast("long")})


def _sum(c: str | Column, name: str) -> Column:
    return F.sum(F.col("sign") * c if isinstance(c, Column) else F.col("sign") * F.col(c)).alias(name)


def _exact(c: str, name: str) -> Column:
    return F.sum(F.when(F.col("sign") < 0, -F.col(c)).otherwise(F.col(c))).cast(EXACT).alias(name)


def edge_year_rows(rows: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """edge_years of signed evidence on top of old rows."""
    fresh = _weighed(rows).where(F.col("year").isNotNull()).select(*EDGE, "year", "sign", F.lit(1).alias("n"), F.col("_sum").alias("s"))
    if old is not None:
        fresh = fresh.unionByName(old.select(*EDGE, "year", F.lit(1).alias("sign"), F.col("n_docs").alias("n"), F.col("sum_confidence").alias("s")))
    total = fresh.groupBy(*EDGE, "year").agg(_sum("n", "n_docs"), _exact("s", "sum_confidence")).where(F.col("n_docs") > 0)
    return total.withColumn("mean_confidence", F.col("sum_confidence").cast("double") / F.col("n_docs"))


def edge_rows(rows: DataFrame, years: DataFrame, left: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """edges of signed evidence on top of old rows; years are the edge_years, left the evidence, of all that is touched as it is now."""
    weighed = _weighed(rows)
    up, down = F.when(F.col("sign") > 0, F.col("confidence")), F.when(F.col("sign") < 0, F.col("confidence"))
    fresh = weighed.select(*EDGE, "sign", F.lit(1).alias("n"), F.col("n_sentences").alias("ns"), "_sum", "_log", "_sure", up.alias("up"), down.alias("down"), F.lit(None).cast("double").alias("was"))
    if old is not None:
        none = F.lit(None).cast("double")
        fresh = fresh.unionByName(old.select(*EDGE, F.lit(1).alias("sign"), F.col("n_docs").alias("n"), F.col("n_sentences").alias("ns"), F.col("sum_confidence").alias("_sum"), F.col("log_miss").alias("_log"), F.col("n_sure").alias("_sure"), none.alias("up"), none.alias("down"), F.col("max_confidence").alias("was")))
    total = fresh.groupBy(*EDGE).agg(
        _sum("n", "n_docs"), _sum("ns", "n_sentences"), _exact("_sum", "sum_confidence"), _exact("_log", "log_miss"), _sum("_sure", "n_sure"), F.max("up").alias("up"), F.max("down").alias("down"), F.max("was").alias("was"),
    ).where(F.col("n_docs") > 0)
    span = years.groupBy(*EDGE).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    total = total.join(span, list(EDGE), "left")
    best = F.greatest("was", "up")
    if old is not None:
        lost = F.coalesce(F.col("down") >= F.col("was"), F.lit(False))
        again = left.join(total.where(lost).select(*EDGE), list(EDGE), "left_semi").groupBy(*EDGE).agg(F.max("confidence").alias("again"))
        total, best = total.join(again, list(EDGE), "left"), F.when(lost, F.col("again")).otherwise(best)
    combined = F.when(F.col("n_sure") > 0, 1.0).otherwise(1.0 - F.exp(F.col("log_miss").cast("double")))
    return total.select(
        *EDGE, "n_docs", "n_sentences", (F.col("sum_confidence").cast("double") / F.col("n_docs")).alias("mean_confidence"), best.alias("max_confidence"), combined.alias("combined_confidence"),
        "first_year", "last_year", *STATE["edges"],
    )


def entity_year_rows(rows: DataFrame, old: DataFrame | None = None) -> DataFrame:
    fresh = rows.where(F.col("year").isNotNull()).select("entity_id", "year", "sign", F.lit(1).cast("long").alias("n"))
    if old is not None:
        fresh = fresh.unionByName(old.select("entity_id", "year", F.lit(1).alias("sign"), F.col("n_docs").alias("n")))
    return fresh.groupBy("entity_id", "year").agg(_sum("n", "n_docs")).where(F.col("n_docs") > 0)


def entity_rows(rows: DataFrame, years: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """entity_stats of signed (pmid, entity_id, n, year) on top of old rows; years are the entity_years of all that is touched."""
    fresh = rows.select("entity_id", "sign", F.lit(1).cast("long").alias("d"), F.col("n").alias("m"))
    if old is not None:
        fresh = fresh.unionByName(old.select("entity_id", F.lit(1).alias("sign"), F.col("n_docs").alias("d"), F.col("n_mentions").alias("m")))
    total = fresh.groupBy("entity_id").agg(_sum("d", "n_docs"), _sum("m", "n_mentions")).where(F.col("n_docs") > 0)
    span = years.groupBy("entity_id").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return total.join(span, "entity_id", "left")


def year_rows(rows: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """year_docs of signed (year, n_docs) on top of old rows."""
    fresh = rows if old is None else rows.unionByName(old.withColumn("sign", F.lit(1)))
    return fresh.groupBy("year").agg(_sum("n_docs", "n_docs")).where(F.col("n_docs") > 0)


def adjacency_rows(years: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges under each of their ends: entity_id, neighbor_id, is_head (whether the entity is the head), label, the neighbour's name and
    type, and `series`, the documents and sum of confidences of each year. So a read of one entity's edges needs neither a
    sum over rows nor a join. Neighbours that no entity row names are left out."""
    point = F.struct("year", "n_docs", "sum_confidence")
    edges = years.groupBy(*EDGE).agg(F.array_sort(F.collect_list(point)).alias("series"))
    end = lambda a, b, head: F.struct(F.col(a).alias("entity_id"), F.col(b).alias("neighbor_id"), F.lit(head).alias("is_head"))
    ends = F.when(F.col("head_id") == F.col("tail_id"), F.array(end("head_id", "tail_id", True))).otherwise(F.array(end("head_id", "tail_id", True), end("tail_id", "head_id", False)))
    both = edges.select(F.explode(ends).alias("e"), "label", "series").select("e.*", "label", "series")
    named = entities.select(F.col("entity_id").alias("neighbor_id"), F.col("name").alias("neighbor_name"), F.col("type").alias("neighbor_type"))
    return both.join(named, "neighbor_id").select(*END, "neighbor_name", "neighbor_type", "series")


def _base(table: Callable[[str, str], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table("relations", S.RELATIONS), table("documents", S.DOCUMENTS), table("mentions", S.MENTIONS)


def _plus(df: DataFrame) -> DataFrame:
    return df.withColumn("sign", F.lit(1))


def build(tx, min_confidence: float) -> None:
    """All derived tables from the base tables of a transaction's version."""
    relations, documents, mentions = _base(tx.base.table)
    left = tx.write("evidence", evidence.document_evidence(relations, documents, min_confidence))
    years = tx.write("edge_years", edge_year_rows(_plus(left)))
    tx.write("edges", edge_rows(_plus(left), years, left))
    tx.write("adjacency", adjacency_rows(years, tx.base.table("entities", S.ENTITIES)))
    dated = _plus(tx.stage(evidence.dated_mentions(mentions, documents)))
    tx.write("entity_stats", entity_rows(dated, tx.write("entity_years", entity_year_rows(dated))))
    tx.write("year_docs", evidence.year_docs(documents))


def refresh(tx, old, changed: DataFrame, min_confidence: float) -> dict[str, int]:
    """Bring the derived tables from version `old` to the transaction's: changed (pmid) has every document that may differ. Only
    buckets that a changed row falls into are read and written; how many those were, by table."""
    pmids = tx.stage(changed.select("pmid").distinct())
    some = {n: tx.touched(n, pmids) if tx.base.entry(n) else [] for n in ("relations", "documents", "mentions")}

    def of(version) -> tuple[DataFrame, DataFrame, DataFrame]:
        return _base(lambda n, schema: version.table(n, schema, some[n]).join(pmids.hint("merge"), "pmid", "left_semi"))

    (r0, d0, m0), (r1, d1, m1) = of(old), of(tx.base)
    rows = tx.stage(signed(evidence.document_evidence(r0, d0, min_confidence), evidence.document_evidence(r1, d1, min_confidence)))
    edge = tx.touched("evidence", rows)
    sizes = dict.fromkeys(("evidence", "edges", "edge_years"), len(edge)) | {"adjacency": 0}
    if edge:
        have = tx.read("evidence", buckets=edge)
        kept = have.join(rows.where(F.col("sign") < 0).select(*PAIR).hint("merge"), list(PAIR), "left_anti")
        left = tx.rewrite("evidence", kept.unionByName(rows.where(F.col("sign") > 0).drop("sign")), edge)
        years = tx.rewrite("edge_years", edge_year_rows(rows, tx.read("edge_years", buckets=edge)), edge)
        tx.rewrite("edges", edge_rows(rows, years, left, tx.read("edges", buckets=edge)), edge)
        moved = tx.stage(rows.select(*EDGE).distinct())
        gone = moved.select(F.explode(F.array(F.struct(F.col("head_id").alias("entity_id"), F.col("tail_id").alias("neighbor_id"), F.lit(True).alias("is_head"), "label"), F.struct(F.col("tail_id").alias("entity_id"), F.col("head_id").alias("neighbor_id"), F.lit(False).alias("is_head"), "label"))).alias("e")).select("e.*")
        ends = tx.touched("adjacency", gone)
        sizes["adjacency"] = len(ends)
        fresh = adjacency_rows(years.join(moved, list(EDGE), "left_semi"), tx.base.table("entities", S.ENTITIES))
        tx.rewrite("adjacency", tx.read("adjacency", buckets=ends).join(gone, list(END), "left_anti").unionByName(fresh), ends)
    dated = tx.stage(signed(evidence.dated_mentions(m0, d0), evidence.dated_mentions(m1, d1)))
    entity = tx.touched("entity_stats", dated)
    sizes |= dict.fromkeys(("entity_stats", "entity_years"), len(entity))
    if entity:
        years = tx.rewrite("entity_years", entity_year_rows(dated, tx.read("entity_years", buckets=entity)), entity)
        tx.rewrite("entity_stats", entity_rows(dated, years, tx.read("entity_stats", buckets=entity)), entity)
    count = evidence.year_docs
    tx.write("year_docs", year_rows(count(d0).withColumn("sign", F.lit(-1)).unionByName(_plus(count(d1))), tx.read("year_docs")))
    return sizes
