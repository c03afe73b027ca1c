"""Commits that fail anywhere, writers that meet, and derived tables kept by deltas."""

import random

import pytest
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.operators import evidence, maintenance
from quillweave.operators.snapshots import Conflict
from quillweave.operators.store import Store

MENTION, RELATION = S.MENTIONS, S.RELATIONS


def articles(spark, *rows):
    return spark.createDataFrame([(p, t, "", y, ["eng"], "", "", [], "q") for p, t, y in rows], S.ARTICLES + ", query_label string")


def extraction(spark, docs):
    """docs: {pmid: [(head, tail, label, confidence), ...]}; every end is a mention."""
    relations = [(p, i, h, t, label, c, "s") for p, rows in docs.items() for i, (h, t, label, c) in enumerate(rows)]
    mentions = [(p, i, 0, 1, e, "Gene", e) for p, rows in docs.items() for i, (h, t, _, _) in enumerate(rows) for e in (h, t)]
    seen = sorted({e for _, i, _, _, e, _, _ in mentions})
    return (
        spark.createDataFrame([(p, "title") for p in docs], "pmid string, nlp_scope string"), spark.createDataFrame(mentions, MENTION), spark.createDataFrame(relations, RELATION),
        spark.createDataFrame([(e, "Gene", e, True, "0") for e in seen], S.ENTITIES + ", ordinal string"),
    )


def state(store):
    """All that a reader sees, whole."""
    snap = store.snapshot()
    return {n: sorted(map(repr, snap.table(n).drop("other_abstracts").collect())) for n in snap.manifest["tables"] if n != "changes"}


class Stop(Exception):
    pass


def stopper(at):
    taken = []

    def step(name):
        taken.append(name)
        if len(taken) == at:
            raise Stop(name)

    step.taken = taken
    return step


def test_a_save_that_stops_at_any_step_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path / "db")
    Store(spark, root, 2).upsert(articles(spark, ("1", "one", 2001), ("2", "two", 2002)))
    Store(spark, root).save_extraction(*extraction(spark, {"1": [("a", "b", "Association", 0.9)]}))
    before = state(Store(spark, root))
    count = stopper(0)
    whole = str(tmp_path / "copy")
    Store(spark, whole, 2).upsert(articles(spark, ("1", "one", 2001), ("2", "two", 2002)))
    Store(spark, whole, 2).save_extraction(*extraction(spark, {"1": [("a", "b", "Association", 0.9)]}))
    fresh = {"1": [("a", "c", "Association", 0.8)], "2": [("a", "b", "Association", 0.7)]}
    Store(spark, whole, 2, count).save_extraction(*extraction(spark, fresh))
    after = state(Store(spark, whole))
    assert len(count.taken) >= 10 and {"draft", "commit"} <= set(count.taken) and after != before
    for at in range(1, len(count.taken) + 1):
        step = stopper(at)
        with pytest.raises(Stop):
            Store(spark, root, 2, step).save_extraction(*extraction(spark, fresh))
        assert len(step.taken) == at and state(Store(spark, root)) == before
    store = Store(spark, root)
    named = {f for t in store.snapshot().manifest["tables"].values() for b in t["parts"].values() for f in b}
    on_disk = {f"data/{n}/{u}" for n in store.log.names("data") for u in store.log.names(f"data/{n}")}
    old = {f for v in store.log.versions() for t in store.snapshot(v).manifest["tables"].values() for b in t["parts"].values() for f in b}
    assert {f.split("/_bucket=")[0] for f in named | old} == on_disk, "stopped saves left folders behind"
    store.save_extraction(*extraction(spark, fresh))
    assert state(store) == after


def test_a_failed_job_and_a_lost_draft_change_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"), 2)
    store.upsert(articles(spark, ("1", "one", 2001)))
    before = state(store)
    with pytest.raises(Exception, match="stop"):
        store.upsert(articles(spark, ("1", "x", 1)).withColumn("title", F.raise_error(F.lit("stop")).cast("string")))
    (tmp_path / "db" / "_log" / "_half").write_text('{"version": 2')
    assert state(store) == before and store.log.versions() == [1]


def test_a_second_writer_meets_the_first(spark, tmp_path):
    root = str(tmp_path / "db")
    store = Store(spark, root, 2)
    store.upsert(articles(spark, ("1", "one", 2001)))
    met = []

    def meanwhile(name):
        if name == "commit" and not met:
            met.append(1)
            Store(spark, root).upsert(articles(spark, ("2", "two", 2002)))

    Store(spark, root, step=meanwhile).upsert(articles(spark, ("1", "ONE", 2001), ("3", "three", 2003)))
    assert {r.pmid: r.title for r in store.documents().collect()} == {"1": "ONE", "2": "two", "3": "three"}  # worked out again
    assert store.log.versions() == [1, 2, 3] and {r.pmid for r in store.snapshot(2).table("documents").collect()} == {"1", "2"}

    met.clear()
    with pytest.raises(Conflict):  # what is given can't be worked out again
        Store(spark, root, step=meanwhile).save(documents=store.documents().limit(1))
    met.clear()
    Store(spark, root, step=meanwhile).append("search_counts", spark.createDataFrame([("l", 1, "k", 1, 1)], S.SEARCH_COUNTS))  # apart from documents
    assert store.table("search_counts").count() == 1 and store.documents().count() == 3


def test_appends_of_two_writers_both_stay(spark, tmp_path):
    root, met = str(tmp_path / "db"), []
    row = lambda n: spark.createDataFrame([(n,)], "n int")
    Store(spark, root).append("t", row(1))

    def meanwhile(name):
        if name == "commit" and not met:
            met.append(1)
            Store(spark, root).append("t", row(2))

    Store(spark, root, step=meanwhile).append("t", row(3))
    assert sorted(r.n for r in Store(spark, root).table("t").collect()) == [1, 2, 3]


def test_readers_keep_their_version_until_it_is_removed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"), 2)
    store.upsert(articles(spark, ("1", "one", 2001)))
    old = store.snapshot()
    store.upsert(articles(spark, ("1", "two", 2001)))
    assert old.table("documents").first().title == "one" and store.vacuum() == 0 and store.log.versions() == [2]
    assert store.vacuum(unused_seconds=-10) > 0 and store.documents().first().title == "two"
    with pytest.raises(KeyError):
        store.snapshot(1)
    with pytest.raises(KeyError):
        store.table("nothing")
    assert store.table("nothing", "a int").count() == 0


def test_the_largest_of_repeated_rows_is_stored(spark, tmp_path):
    for order in (1, -1):
        store = Store(spark, str(tmp_path / f"db{order}"), 2)
        store.upsert(articles(spark, *[("1", "a", 2001), ("1", "b", 2000), ("1", "b", 1999), (None, "n", 1)][::order]))
        assert [(r.pmid, r.title, r.year) for r in store.documents().collect()] == [("1", "b", 2000)]


def rebuilt(store, least=S.MIN_CONFIDENCE):
    snap = store.snapshot()
    return evidence.graph_tables(snap.table("relations", RELATION), snap.table("documents", S.DOCUMENTS), snap.table("mentions", MENTION), least)


def plain(df, columns):
    return sorted(tuple(repr(round(v, 9)) if isinstance(v, float) else repr(v) for v in r) for r in df.select(*columns).collect())


def check(store):
    for name, df in rebuilt(store).items():
        assert plain(store.table(name), df.columns) == plain(df, df.columns), name
    years, entities = store.table("edge_years"), store.table("entities")
    assert sorted(map(repr, store.table("adjacency").collect())) == sorted(map(repr, maintenance.adjacency_rows(years, entities).collect()))


@pytest.mark.parametrize("seed", [2])
def test_deltas_equal_a_rebuild_after_any_replacements(spark, tmp_path, seed):
    draw = random.Random(seed)
    store = Store(spark, str(tmp_path / "db"), 4)
    pair = lambda: (draw.choice("abcd"), draw.choice("xyz"), draw.choice(["Association", "Association", "Positive_Correlation", "None"]), draw.choice([0.2, 0.5, 0.75, 0.9, 1.0, 1 / 3 + 0.4]))
    store.upsert(articles(spark, *[(str(p), "t", draw.choice([None, 2001, 2002, 2003])) for p in range(12)]))
    store.save_extraction(*extraction(spark, {str(p): [pair() for _ in range(draw.randrange(5))] for p in range(10)}))
    assert store.refresh_graph() == {}  # none yet: built
    check(store)
    exact = {n: plain(store.table(n), store.table(n).columns) for n in ("edges", "edge_years")}
    for turn in range(3):
        kind = draw.choice(["years", "rows", "both"]) if turn else "both"
        some = draw.sample(range(12), draw.randrange(1, 6))
        if kind != "rows":
            store.upsert(articles(spark, *[(str(p), "t2", draw.choice([None, 2001, 2002, 2004])) for p in some]))
        if kind != "years":
            store.save_extraction(*extraction(spark, {str(p): [pair() for _ in range(draw.randrange(4))] for p in some}))
        assert store.refresh_graph()
        check(store)
    kept = {n: plain(store.table(n), store.table(n).columns) for n in ("edges", "edge_years")}
    store.build_graph()
    assert kept == {n: plain(store.table(n), store.table(n).columns) for n in kept} and exact  # the exact sums too


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"), 8)
    docs = {str(p): [(f"h{p}", f"t{p}", "Association", 0.9)] for p in range(20)}
    store.upsert(articles(spark, *[(p, "t", 2000 + int(p)) for p in docs]))
    store.save_extraction(*extraction(spark, docs))
    store.build_graph()
    before = store.snapshot().manifest["tables"]
    store.save_extraction(*extraction(spark, {"3": [("h3", "t3", "Association", 0.6)]}))
    sizes = store.refresh_graph()
    after = store.snapshot().manifest["tables"]
    assert sizes.pop("adjacency") in (1, 2)
    assert sizes == {"evidence": 1, "edges": 1, "edge_years": 1, "entity_stats": 0, "entity_years": 0}
    for name in ("edges", "evidence", "relations"):
        assert sum(before[name]["parts"][b] != after[name]["parts"][b] for b in before[name]["parts"]) == 1
    assert before["entity_stats"] == after["entity_stats"]
    check(store)
    assert store.refresh_graph() == dict.fromkeys([*sizes, "adjacency"], 0) and store.table("changes").count() == 0
    store.save_extraction(*extraction(spark, {"3": []}))
    store.refresh_graph()
    check(store)
    assert store.table("edges").where("head_id = 'h3'").count() == 0


def test_a_refresh_that_stops_leaves_the_graph_and_the_list_of_changes(spark, tmp_path):
    root = str(tmp_path / "db")
    store = Store(spark, root, 2)
    store.upsert(articles(spark, ("1", "t", 2001), ("2", "t", 2002)))
    store.save_extraction(*extraction(spark, {"1": [("a", "b", "Association", 0.9)], "2": [("a", "b", "Association", 1.0)]}))
    store.build_graph()
    store.save_extraction(*extraction(spark, {"2": [("a", "c", "Association", 0.8)]}))
    before = state(store)
    steps = -6
    while True:
        steps += 9
        step = stopper(steps)
        try:
            Store(spark, root, 2, step).refresh_graph()
            break
        except Stop:
            assert state(store) == before and store.table("changes").count() == 1
    assert steps > 8
    check(store)


def test_confidence_out_of_range(spark):
    rows = spark.createDataFrame([("1", 2001, "a", "b", "Association", 1.5, 1)], "pmid string, year int, head_id string, tail_id string, label string, confidence double, n_sentences long")
    with pytest.raises(Exception, match="out of range"):
        maintenance.edge_year_rows(rows.withColumn("sign", F.lit(1))).collect()


def test_extraction_tags_each_sentence_once(spark, tmp_path):
    from quillweave.plans import extract

    seen = spark.sparkContext.accumulator(0)
    terms = {"NOD2": "Gene", "CD": "Disease"}

    def tagger(text):
        plain = extract.dictionary_tagger(terms)(text)
        count = F.udf(lambda t: seen.add(1) or t, "string")  # one more for each sentence that is tagged
        return F.when(count(text).isNotNull(), plain)

    lexicon = spark.createDataFrame([("Gene", "NOD2", "G", "NOD2", 0, 0)], S.LEXICON)
    store = Store(spark, str(tmp_path / "db"), 2)
    store.upsert(spark.createDataFrame([(str(i), "NOD2 and CD", "The NOD2 gene is linked with CD in the patients of this study. NOD2 raises CD risk.", 2000, ["eng"], "", "", [], "q") for i in range(6)], S.ARTICLES + ", query_label string"))
    docs = store.documents()
    n = extract.sentences(docs).count()
    seen.value = 0
    store.extract(lambda keep: extract.extract(docs, tagger, extract.constant_classifier("Association", 0.9), lexicon, keep=keep))
    assert seen.value == n == 18 and store.count("relations") == 18 and store.count("mentions") == 36


def test_neighbours_are_read_from_one_bucket_without_a_shuffle(spark, tmp_path, capsys):
    from quillweave.plans.graph import KnowledgeGraph

    draw = random.Random(3)
    store = Store(spark, str(tmp_path / "db"), 8)
    docs = {str(p): [(draw.choice("abcd"), draw.choice("wxyza"), draw.choice(["Association", "Positive_Correlation"]), draw.choice([0.6, 0.9]))] for p in range(60)}
    store.upsert(articles(spark, *[(p, "t", draw.choice([None, 2001, 2002, 2003])) for p in docs]))
    store.save_extraction(*extraction(spark, docs))
    store.build_graph()
    stored = store.graph()
    plain_graph = KnowledgeGraph(stored.tables)
    for entity in "axq":
        for more in ({}, {"since": 2002}, {"until": 2002, "label": "Association"}, {"min_docs": 3, "limit": 2}):
            one, two = ([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in g.neighbors(entity, **more).collect()] for g in (stored, plain_graph))
            assert one == two
    rows = stored.neighbors("a")
    assert rows.collect()
    rows.explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan and "EqualTo(entity_id,a)" in plan
    entry = store.snapshot().entry("adjacency")
    files = {f.rsplit("/", 2)[1] for f in stored.adjacent("a").inputFiles()}
    assert len(files) == 1 < len(entry["parts"])


def test_documents_are_not_broadcast(spark, tmp_path):
    """Tables with a row a document are joined by shuffle, however small their files look."""
    from quillweave.operators.store import replace_by_document

    spark.range(1000).selectExpr("cast(id as string) pmid", "id x").write.parquet(str(tmp_path / "rows"))
    spark.range(100).selectExpr("cast(id * 7 as string) pmid").write.parquet(str(tmp_path / "done"))
    stored, done = spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "done"))
    left = replace_by_document(stored, stored.limit(0), done)
    assert "BroadcastHashJoin" not in left._jdf.queryExecution().executedPlan().toString()
    assert left.count() == 1000 - 100
