"""Table updates: upsert, replacement by document, first name wins, and a store of tables that commits or rolls back."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.operators import maintenance, names
from quillweave.operators.snapshots import Conflict, Snapshot, SnapshotLog, Transaction, bucket_of

#: What an upsert leaves as it is in a document that is there already.
STICKY = ("query_label", "nlp_scope", "extracted")


def upsert_documents(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    """The stored documents with the arriving ones: text and metadata of a known pmid are replaced, the label of its first
    search and the state of its extraction stay. A new document is not extracted yet. Of several arriving rows of one pmid the
    largest counts, column by column; rows without pmid are left out. One full outer join on pmid."""
    arriving = arriving.where(F.col("pmid").isNotNull())
    rest = [c for c in arriving.columns if c != "pmid"]
    last = arriving.groupBy("pmid").agg(F.max(F.struct(*rest)).alias("row")).select("pmid", "row.*") if rest else arriving.distinct()
    old, new = stored.alias("old"), last.alias("new")
    known = F.col("old.pmid").isNotNull()

    def column(c: str):
        if c == "pmid":
            return F.coalesce("old.pmid", "new.pmid").alias(c)
        if c not in arriving.columns:
            return F.when(known, F.col(f"old.{c}")).otherwise(F.lit(False) if c == "extracted" else F.lit(None)).alias(c)
        if c in STICKY:
            fresh = F.col(f"new.{c}") if c == "query_label" else F.lit(False) if c == "extracted" else F.lit(None)
            return F.when(known, F.col(f"old.{c}")).otherwise(fresh).alias(c)
        return F.when(F.col("new.pmid").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)

    return old.join(new, F.col("old.pmid") == F.col("new.pmid"), "full_outer").select(*(column(c) for c in stored.columns))


def replace_by_document(stored: DataFrame, fresh: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of `done` documents (pmid) are dropped from the stored table, then the fresh ones are added. Documents are never broadcast: files
    of millions of their ids are small."""
    return stored.join(done.select("pmid").distinct().hint("merge"), "pmid", "left_anti").select(*stored.columns).unionByName(fresh)


def first_entities(stored: DataFrame, fresh: DataFrame, order: list[str]) -> DataFrame:
    """Entities by id: those stored stay as they are, of fresh ones the first by `order` is added. Entities that nothing
    mentions any more stay too."""
    rank = lambda df, n, *keys: df.select("entity_id", F.struct(F.lit(n).alias("n"), *keys, "type", "name", "matched").alias("e"))
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    none = [F.lit(None).cast(fresh.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(order)]
    every = rank(stored, 0, *none).union(rank(fresh, 1, *keys))
    return every.groupBy("entity_id").agg(F.min("e").alias("e")).select("entity_id", "e.type", "e.name", "e.matched")


class Extracted(Protocol):
    """What plans.extract.Extraction holds."""

    scopes: DataFrame
    mentions: DataFrame
    relations: DataFrame
    entities: DataFrame


class Store:
    """Tables under one root, in a log of snapshots (operators.snapshots): every call that changes something commits all of it or
    nothing, whenever it stops, and a reader sees one version. Calls that work from what is stored are worked out again if another writer
    changed that first.

    Tables with keys are dealt into `buckets` when they are first made; choose it so that a bucket has a few hundred MB. An update rewrites the
    buckets that its rows fall into.
    """

    KEYS = {"documents": ["pmid"], "mentions": ["pmid"], "relations": ["pmid"], "entities": ["entity_id"], **maintenance.KEYS, "name_grams": ["gram"]}
    ATTEMPTS = 5

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, step: Callable[[str], None] = lambda name: None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.log = SnapshotLog(spark, root, step)

    def snapshot(self, version: int | None = None) -> Snapshot:
        return self.log.snapshot(version)

    def transact(self, work: Callable[[Transaction], object], attempts: int = ATTEMPTS):
        """Run work on a transaction and commit it; what work returned. After a conflict, it is run again on the newest version. An
        error leaves the store as it was."""
        for attempt in range(attempts):
            tx = Transaction(self.log, self.KEYS, self.buckets)
            try:
                out = work(tx)
                if tx.changes or tx.meta:
                    tx.commit()
            except BaseException as error:
                tx.discard()
                if isinstance(error, Conflict) and attempt + 1 < attempts:
                    continue
                raise
            tx.discard(staged_only=True)
            return out

    def exists(self, name: str) -> bool:
        return self.snapshot().entry(name) is not None

    def table(self, name: str, schema: str | None = None) -> DataFrame:
        return self.snapshot().table(name, schema)

    def save(self, **tables: DataFrame) -> None:
        """Replace tables. If another writer changes one of them meanwhile, that is a Conflict."""

        def work(tx: Transaction) -> None:
            for name, df in tables.items():
                tx.write(name, df)

        self.transact(work, attempts=1)

    def append(self, name: str, df: DataFrame) -> None:
        self.transact(lambda tx: tx.append(name, df))

    def documents(self, only_unextracted: bool = False, limit: int | None = None) -> DataFrame:
        """Documents in the order of pmid as text, without their other abstracts."""
        df = self.table("documents", S.DOCUMENTS).drop("other_abstracts")
        df = df.where(~F.coalesce("extracted", F.lit(False))) if only_unextracted else df
        df = df.orderBy("pmid")
        return df if limit is None else df.limit(limit)

    def count(self, name: str) -> int:
        S.check_choice(name, (*S.BASE_TABLES, *S.GRAPH_TABLES), "table")
        return self.table(name).count()

    def upsert(self, arriving: DataFrame) -> None:
        def work(tx: Transaction) -> None:
            rows = tx.stage(arriving)
            touched = tx.touched("documents", rows)
            tx.rewrite("documents", upsert_documents(tx.read("documents", S.DOCUMENTS, touched), rows), touched)
            tx.append("changes", rows.select("pmid").distinct())

        self.transact(work)

    def save_extraction(self, scopes: DataFrame, mentions: DataFrame, relations: DataFrame, entities: DataFrame) -> None:
        """Replace what was extracted from the documents of scopes (pmid, nlp_scope) and mark them as extracted; entities
        have an `ordinal` for the order in which they were seen. Saving twice gives the same tables. Each input is worked out once."""
        self.transact(lambda tx: self._replace_extraction(tx, scopes, mentions, relations, entities))

    def extract(self, make: Callable[[Callable[[DataFrame], DataFrame]], Extracted]) -> None:
        """Save what `make` extracts; it is given a function that works a table out once, beside the store's tables, for as long as
        the transaction takes (plans.extract.extract's `keep`)."""

        def work(tx: Transaction) -> None:
            found = make(tx.stage)
            self._replace_extraction(tx, found.scopes, found.mentions, found.relations, found.entities)

        self.transact(work)

    def _replace_extraction(self, tx: Transaction, scopes: DataFrame, mentions: DataFrame, relations: DataFrame, entities: DataFrame) -> None:
        done, fresh = tx.stage(scopes.select("pmid", F.col("nlp_scope").alias("_scope"))), {"mentions": tx.stage(mentions), "relations": tx.stage(relations)}
        seen = tx.stage(entities)
        touched = tx.touched("documents", done)
        docs = tx.read("documents", S.DOCUMENTS, touched)
        marked = docs.join(done.hint("merge"), "pmid", "left").withColumns({"nlp_scope": F.coalesce("_scope", "nlp_scope"), "extracted": F.coalesce("extracted", F.lit(False)) | F.col("_scope").isNotNull()})
        tx.rewrite("documents", marked.select(*docs.columns), touched)
        for name, schema in (("mentions", S.MENTIONS), ("relations", S.RELATIONS)):
            touched = tx.touched(name, done, fresh[name])
            tx.rewrite(name, replace_by_document(tx.read(name, schema, touched), fresh[name], done), touched)
        touched = tx.touched("entities", seen)
        tx.rewrite("entities", first_entities(tx.read("entities", S.ENTITIES, touched), seen, ["ordinal"]), touched)
        tx.append("changes", done.select("pmid").distinct())

    def build_graph(self, min_confidence: float = S.MIN_CONFIDENCE) -> dict[str, int]:
        """Make the derived tables from all rows; their sizes."""

        def work(tx: Transaction) -> None:
            maintenance.build(tx, min_confidence)
            tx.forget("changes")
            tx.meta |= {"graph_min_confidence": str(min_confidence), "graph_version": str(tx.base.version)}

        self.transact(work)
        return {n: self.count(n) for n in S.GRAPH_TABLES}

    def refresh_graph(self) -> dict[str, int]:
        """Bring the derived tables up to date with the documents changed since they were made; how many buckets of each were rewritten. Where
        there is no graph yet, or a vacuum took the version it was made of, all is built (and nothing is returned)."""

        def work(tx: Transaction) -> dict[str, int]:
            least = float(tx.base.meta.get("graph_min_confidence", S.MIN_CONFIDENCE))
            since = int(tx.base.meta.get("graph_version", 0))
            sizes: dict[str, int] = {}
            if since not in self.log.versions():
                maintenance.build(tx, least)
            else:
                sizes = maintenance.refresh(tx, self.snapshot(since), tx.base.table("changes", "pmid string"), least)
            tx.forget("changes")
            tx.meta |= {"graph_min_confidence": str(least), "graph_version": str(tx.base.version)}
            return sizes

        return self.transact(work)

    def index_names(self) -> None:
        """Make the trigram index of the entities' names."""

        def work(tx: Transaction) -> None:
            tx.write("name_grams", names.gram_rows(tx.read("entities", S.ENTITIES)))
            tx.meta["names_version"] = str(tx.base.changed("entities"))

        self.transact(work)

    def search_names(self, term: str) -> DataFrame:
        """Entities whose name is LIKE %term% in any case. Read from the buckets of the index that the term's trigrams are in; from all
        entities where the term has no run of three characters between wildcards, or entities have changed since the index was made."""
        if not term.strip():
            raise ValueError("the term is empty")
        snapshot = self.snapshot()
        grams = names.term_grams(self.spark.range(1).select(F.lower(F.lit(term))).first()[0])
        if not grams or snapshot.meta.get("names_version") != str(snapshot.changed("entities")) or snapshot.entry("name_grams") is None:
            return snapshot.table("entities", S.ENTITIES).where(names.like(term)).select(*names.COLUMNS)
        of = self.spark.createDataFrame([(g,) for g in grams], "gram string").select(bucket_of(["gram"], snapshot.entry("name_grams")["buckets"]).alias("b"))
        return names.search(snapshot.table("name_grams", buckets={r["b"] for r in of.collect()}), term, grams)

    def vacuum(self, unused_seconds: float = 86_400) -> int:
        """Remove old versions but the one the graph was made of, and the folders that nothing names any more."""
        return self.log.vacuum([int(self.snapshot().meta.get("graph_version", 0))], unused_seconds)

    def meta(self, key: str) -> str | None:
        return self.snapshot().meta.get(key)

    def graph(self):
        """The read queries over one version; neighbours are read from the adjacency table."""
        from quillweave.plans.graph import StoredGraph

        snapshot = self.snapshot()
        tables = {n: snapshot.table(n) for n in (*S.BASE_TABLES, *S.GRAPH_TABLES)}
        return StoredGraph({n: df.drop(*maintenance.STATE.get(n, ())) for n, df in tables.items()}, lambda entity_id: snapshot.rows_of("adjacency", [entity_id], self.KEYS["adjacency"]))
