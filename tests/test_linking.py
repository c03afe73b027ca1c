import gzip
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.operators import evaluation, linking
from quillweave.operators.store import Store
from quillweave.plans import extract, ingest
from quillweave.sources import entrez, lexicon, pubmed, pubtator
from quillweave.streaming import incremental

XML = """<?xml version="1.0"?><PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID>11</PMID><Article><Journal><JournalIssue><PubDate><MedlineDate>1998 Dec-1999 Jan</MedlineDate></PubDate></JournalIssue><Title>J  One</Title></Journal>
<ArticleTitle>[A <i>bold</i> title].</ArticleTitle><Abstract><AbstractText Label="AIM">Find  it.</AbstractText><AbstractText/><AbstractText>Done.</AbstractText></Abstract><Language>dut</Language><VernacularTitle>Titel</VernacularTitle>
<ArticleDate><Year>2001</Year></ArticleDate></Article><OtherAbstract Language="fre"><AbstractText>Fini.</AbstractText></OtherAbstract></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>x9</PMID><Article/></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>12</PMID><Article><ArticleTitle>Plain</ArticleTitle></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>"""

BLOCK = "7|t|NOD2 and CD\n7|a|NOD2 binds tau.\n7\t0\t4\tNOD2\tGeneOrGeneProduct\t348\n7\t9\t11\tCD\tDiseaseOrPhenotypicFeature\tD000544,-\n7\t12\t16\tNOD2\tSpecies\t9606\n7\tBind\t348\tD000544\tNovel\n7\tOdd\t348\tD000544\tNo\n7\tAssociation\t348\t999\tNo\n"


def lex(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], S.LEXICON)


def test_lexicon_index(spark):
    rows = lex(spark, ("Gene", "NOD2", "G1", "NOD2", 2), ("Gene", "nod2", "G2", "Nod2", 0), ("Gene", "Nod2", "G3", "x", 0), ("Gene", "tangles", "G4", "tangles", 0), ("Gene", "tangle", "G5", "tangle", 2), ("Disease", "nod2", "D1", "d", 0))
    got = {(r.type, r.key): r.entity_id for r in linking.lexicon_index(rows).collect()}
    assert got == {("Gene", "nod2"): "G2", ("Gene", "tangles"): "G4", ("Gene", "tangle"): "G5", ("Disease", "nod2"): "D1"}
    wanted = spark.createDataFrame([("Gene", "nod2"), ("Gene", "zzz")], "type string, key string")
    assert [r.key for r in linking.lexicon_index(rows, wanted).collect()] == ["nod2"]


def test_resolve(spark):
    vocabulary = lex(spark, ("Disease", "Crohn disease", "MESH:D1", "Crohn Disease", 0), ("Gene", "NOD2", "NCBIGene:348", "NOD2", 0))
    men = spark.createDataFrame([("1", "CD", "Disease"), ("1", "NOD2 (receptor)", "Gene"), ("1", "foo 1", "Gene"), ("1", "NOD2", "Disease"), ("2", "CD", "Disease"), ("2", "--", "Gene")], "pmid string, surface string, type string")
    own = spark.createDataFrame([("1", "CD", "Crohn's disease")], "pmid string, short string, long string")
    got = lambda corpus: {(r.pmid, r.surface, r.type): (r.entity_id, r.matched) for r in linking.resolve_mentions(linking.with_long_form(men, own, corpus), vocabulary, ["pmid", "surface", "type"]).collect()}
    one = got(None)
    assert one == {("1", "CD", "Disease"): ("MESH:D1", True), ("1", "NOD2 (receptor)", "Gene"): ("NCBIGene:348", True), ("1", "foo 1", "Gene"): ("gene-text:1 foo", False), ("1", "NOD2", "Disease"): ("disease-text:nod2", False), ("2", "CD", "Disease"): ("disease-text:cd", False), ("2", "--", "Gene"): ("gene-text:--", False)}
    assert got(spark.createDataFrame([("CD", "Crohn disease")], "short string, long string"))[("2", "CD", "Disease")] == ("MESH:D1", True)


def test_frequent_mentions_are_resolved_alike(spark, monkeypatch):
    """A name's mentions give the same rows whether it is frequent or not, and those of a frequent one aren't all in one partition."""
    vocabulary = lex(spark, ("Gene", "NOD2", "G1", "NOD2", 0))
    rows = [(str(i), "NOD2" if i % 10 else f"x {i % 3}", None if i % 7 == 0 else "Gene", "nod two" if i % 4 == 0 else None) for i in range(400)]
    mentions = spark.createDataFrame(rows, "pmid string, surface string, type string, long_form string")
    run = lambda: linking.resolve_mentions(mentions, vocabulary, ["pmid", "surface", "type"])
    want = sorted(map(str, run().collect()))
    assert len(want) == sum(r[2] is not None for r in rows)
    monkeypatch.setattr(linking, "FREQUENT", 50)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = run()
        assert sorted(map(str, got.collect())) == want
        most = got.where("surface = 'NOD2'").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert most < 200


def test_keys_are_made_once_a_name(spark, tmp_path):
    """No filter by the number of keys goes below the aggregation, where it would make the keys of every mention."""
    spark.createDataFrame([(str(i), f"x {i % 3}", "Gene", None) for i in range(9)], "pmid string, surface string, type string, long_form string").write.parquet(str(tmp_path / "mentions"))
    lex(spark, ("Gene", "x 1", "G1", "X 1", 0)).write.parquet(str(tmp_path / "lexicon"))
    found = linking.resolve_mentions(spark.read.parquet(str(tmp_path / "mentions")), spark.read.parquet(str(tmp_path / "lexicon")), ["pmid"])
    assert sorted((r.pmid, r.entity_id) for r in found.collect()) == sorted((str(i), "G1" if i % 3 == 1 else f"gene-text:{i % 3} x") for i in range(9))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert [] == [line for line in plan.splitlines() if "Filter" in line and "size(" in line]


def test_corpus_abbreviations(spark):
    rows = [("1", "CD", "atopic dermatitis"), ("2", "CD", "Crohn disease"), ("3", "CD", "Crohn's disease"), ("2", "PD", "b one"), ("1", "PD", "a one")]
    got = linking.corpus_abbreviations(spark.createDataFrame(rows, "pmid string, short string, long string")).collect()
    assert {r.short: r.long for r in got} == {"CD": "Crohn disease", "PD": "a one"}


def test_articles(spark):
    rows = pubmed.parse(spark.createDataFrame([(XML,), ("<PubmedArticleSet/>",)], "value string")).orderBy("pmid").collect()
    a, b = rows
    assert (a.pmid, a.title, a.abstract, a.year, a.languages, a.journal, a.vernacular_title) == ("11", "A bold title.", "AIM: Find it. Done.", 1998, ["dut"], "J One", "Titel")
    assert [tuple(x) for x in a.other_abstracts] == [("fre", "Fini.")] and (b.pmid, b.year, b.languages) == ("12", None, ["und"])
    for bad in ("<a>", '<!DOCTYPE x [<!ENTITY e "boom">]><a>&e;</a>'):
        with pytest.raises(Exception, match="well-formed|not allowed"):
            pubmed.parse(spark.createDataFrame([(bad,)], "value string")).collect()
    assert [r[0] for r in spark.createDataFrame([("Spring 1899",), ("no",)], "d string").select(pubmed.parse_year(F.col("d"))).collect()] == [1899, None]


def test_corpus(spark):
    corpus = pubtator.parse(spark.createDataFrame([(BLOCK + "\n \n8|t|T\n8|a|\n",)], "value string"))
    assert sorted(r.pmid for r in corpus.documents.collect()) == ["7", "8"]
    assert sorted((r.start, r.text, r.label, tuple(r.ids)) for r in corpus.entities.collect()) == [(0, "NOD2", "Gene", ("348",)), (9, "CD", "Disease", ("D000544",))]
    assert [(r.id1, r.id2, r.label) for r in corpus.relations.collect()] == [("348", "D000544", "Association")]
    assert pubtator.as_documents(corpus).first().year is None
    ner = {(r.pmid, r["index"]): [(s.start, s.label) for s in r.spans] for r in extract.ner_examples(corpus.documents, corpus.entities).collect()}
    assert ner == {("7", 0): [(0, "Gene"), (9, "Disease")], ("7", 1): [], ("8", 0): []}
    rel = extract.relation_examples(corpus.documents, corpus.entities, corpus.relations).collect()
    assert [(r.text, r.head_key, r.tail_key, r.label) for r in rel] == [("[E1] NOD2 [/E1] and [E2] CD [/E2]", "348", "D000544", "Association")]
    for bad in (BLOCK.replace("7\t0\t4", "7\t1\t4"), "7|x|a\n7|a|b\n", BLOCK + "7\tonly\n"):
        with pytest.raises(Exception):  # noqa: B017
            broken = pubtator.parse(spark.createDataFrame([(bad,)], "value string"))
            broken.documents.collect(), broken.entities.collect(), broken.relations.collect()
    with pytest.raises(ValueError):
        pubtator.read_split(spark, "Extra", "/nowhere")


def test_annotated_examples_are_those_of_the_joins(spark):
    """The same rows without a join, from documents of many sentences, entities at the same place, of several ids and over the end of a sentence."""
    names, kinds = ("NOD2", "CD", "tau", "Fe"), ("GeneOrGeneProduct", "DiseaseOrPhenotypicFeature", "ChemicalEntity", "OrganismTaxon")
    blocks = []
    for d in range(40):
        title, abstract = f"{names[d % 4]} in {names[d % 3]}.", " ".join(f"{names[(d + i) % 4]} binds {names[(d * i) % 4]} é\U0001f600 {names[i % 3]}{'.' if i % 3 else ''}" for i in range(d % 7))
        text, rows = f"{title} {abstract}", []
        for m in re.finditer("NOD2|CD|tau|Fe", text):
            ids = (names[len(rows) % 3], "-", m[0], f"{m[0]},{d % 5}")[len(rows) % 4]
            rows.append(f"{d}\t{m.start()}\t{m.end()}\t{m[0]}\t{kinds[(names.index(m[0]) + (d % 11 == len(rows))) % 4]}\t{ids}")
        if len(text) > 20:
            rows.append(f"{d}\t3\t{len(text)}\t{text[3:]}\tChemicalEntity\tlong")
        rows += [f"{d}\t{('Bind', 'Association', 'Odd', 'Negative_Correlation')[(d + i) % 4]}\t{names[i % 4]}\t{names[(i + d) % 4]}\tNo" for i in range(6)]
        blocks.append("\n".join([f"{d}|t|{title}", f"{d}|a|{abstract}", *rows]))
    c = pubtator.parse(spark.createDataFrame([("\n\n".join(blocks),)], "value string"))
    want, got = extract.relation_examples(c.documents, c.entities, c.relations), extract.annotated_examples(c.blocks)
    assert want.dtypes == got.dtypes
    rows = sorted(map(str, want.collect()))
    assert sorted(map(str, got.collect())) == rows and len(rows) > 100 and {r.label for r in got.collect()} >= {"None", "Association"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    twice = pubtator.parse(spark.createDataFrame([(f"{BLOCK}\n\n{BLOCK}",)], "value string")).blocks
    assert extract.annotated_examples(twice).count() == 2
    with pytest.raises(Exception, match="not at its offsets"):
        extract.annotated_examples(pubtator.parse(spark.createDataFrame([(BLOCK.replace("7\t0\t4", "7\t1\t4"),)], "value string")).blocks).collect()


def test_corpus_files_are_read_by_ranges(spark, tmp_path):
    """A file that is cut at any place gives the blocks of the whole file; no task makes one row of it."""
    gaps = ["\n\n", "\n \n", "\n\n\n", "\n\t\n\n \n", "\n\u2003\n"]
    text = "\n\n" + "".join(BLOCK.replace("7", str(700 + i)).rstrip("\n") + gaps[i % 5] for i in range(12))
    (tmp_path / "a.PubTator").write_text(text, encoding="utf-8")
    (tmp_path / "b.PubTator").write_text(BLOCK.rstrip("\n").replace("\n", "\r\n"), newline="")
    want = sorted([str(700 + i) for i in range(12)] + ["7"])
    shown = lambda c: [sorted(map(str, df.collect())) for df in (c.documents, c.entities, c.relations)]
    whole = shown(pubtator.parse(spark.createDataFrame([(text,), (BLOCK,)], "value string")))
    for size in ("211", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            corpus = pubtator.read(spark, str(tmp_path))
            assert sorted(r.pmid for r in corpus.documents.collect()) == want and shown(corpus) == whole
            most = pubtator.pieces(spark, str(tmp_path)).agg(F.max(F.length("value"))).first()[0]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert most < len(text) / 5


def test_extraction_deals_mentions_by_input(spark, tmp_path, monkeypatch):
    """Mentions of large files are grouped in partitions whose number grows with them; relations are the same."""
    from quillweave.operators import shared

    rows = [(str(i), "The title", f"We saw that the man of the town and the girl of row {i} and her cat were with us in the end (WM).") for i in range(60)]
    spark.createDataFrame(rows, "pmid string, title string, abstract string").write.parquet(str(tmp_path / "d"))
    documents = spark.read.parquet(str(tmp_path / "d"))
    vocabulary = lex(spark, ("Gene", "the", "NCBIGene:1", "THE", 0))
    run = lambda: extract.extract(documents, extract.dictionary_tagger({"the": S.GENE, "of": S.DISEASE}), extract.constant_classifier("Association", 0.9), vocabulary, keep=shared.kept(spark, "test")).relations
    few = sorted(map(str, run().collect()))
    monkeypatch.setattr(shared, "SHARE", max(1, shared.input_bytes(documents) // 20))
    many = run()
    assert sorted(map(str, many.collect())) == few and len(few) == 60
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()


def test_containment_is_that_of_all_pairs(spark):
    import random

    draw = random.Random(1)
    span = lambda most: (lambda a, n: (a, a + n))(draw.randrange(-50, 3000), draw.randrange(-2, most))
    sentences = [(draw.choice("ab"), i, *span(900)) for i in range(80)] + [("a", 99, 0, 3000), ("b", 98, 256, 512)]
    spans = [(draw.choice("abc"), *span(300), f"l{i}") for i in range(400)] + [("b", 256, 512, "edge"), ("b", 512, 512, "end"), ("a", 5, 3000, "x")]
    got = linking.contained(spark.createDataFrame(sentences, "pmid string, index int, start int, end int"), spark.createDataFrame(spans, "pmid string, start int, end int, label string"))
    want = sorted((p, i, s - a, e - a, x) for p, i, a, b in sentences for q, s, e, x in spans if p == q and a <= b and s >= a and e <= b)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 1000


def test_containment_in_a_long_document(spark):
    """Work in proportion to the spans: each is compared with the sentences of its bin, not of its document."""
    n = 100_000
    sentences = spark.range(n // 2).select(F.lit("1").alias("pmid"), F.col("id").cast("int").alias("index"), (F.col("id") * 100).cast("int").alias("start"), (F.col("id") * 100 + 99).cast("int").alias("end"))
    spans = spark.range(n).select(F.lit("1").alias("pmid"), (F.col("id") * 50).cast("int").alias("start"), (F.col("id") * 50 + 9).cast("int").alias("end"))
    got = linking.contained(sentences, spans)
    assert got.count() == n and got.where("start NOT IN (0, 50) OR end NOT IN (9, 59)").count() == 0


def test_vocabularies(spark, tmp_path):
    (tmp_path / lexicon.GENE_FILE).write_text("hgnc_id\tsymbol\tname\talias_symbol\talias_name\tprev_symbol\tprev_name\tentrez_id\nHGNC:1\tNOD2\treceptor two\t\"CARD15|IBD1\"\t\tOLD\t\t348\nHGNC:2\tX1\tx one\n")
    with gzip.open(tmp_path / lexicon.DISEASE_FILE, "wt") as f:
        f.write("# hi\n# Fields:\n# DiseaseName\tDiseaseID\tAltDiseaseIDs\tSynonyms\n#\nCrohn Disease\tMESH:D000544\t\tCD|Crohn's\n")
    with gzip.open(tmp_path / lexicon.CHEMICAL_FILE, "wt") as f:
        f.write("# Fields:\n# ChemicalName\tChemicalID\tMESHSynonyms\tCTDCuratedSynonyms\nBiotin\tMESH:C1\tE2020\tVitamin H\n")
    rows = lexicon.read_all(spark, str(tmp_path)).orderBy("type", "ordinal").collect()
    assert [(r.surface, r.entity_id, r.priority) for r in rows if r.type == "Gene"] == [("NOD2", "NCBIGene:348", 0), ("receptor two", "NCBIGene:348", 0), ("OLD", "NCBIGene:348", 1), ("CARD15", "NCBIGene:348", 2), ("IBD1", "NCBIGene:348", 2), ("X1", "HGNC:2", 0), ("x one", "HGNC:2", 0)]
    assert [r.surface for r in rows if r.type == "Chemical"] == ["Biotin", "E2020", "Vitamin H"] and [r.surface for r in rows if r.type == "Disease"] == ["Crohn Disease", "CD", "Crohn's"]
    (tmp_path / "bad.txt").write_text("a\tb\n")
    with pytest.raises(lexicon.LexiconError):
        lexicon.read_genes(spark, str(tmp_path / "bad.txt"))
    with pytest.raises(lexicon.LexiconError):
        lexicon.read_ctd(spark, str(tmp_path / "bad.txt"), "Disease", "a", "b")


def test_plan_and_ingest(spark, tmp_path):
    plan = ingest.plan_queries(ingest.topics(spark, {"pd": "Parkinson", "ad": "Asthma"}), 2010, 2011, 5, 2).orderBy("ordinal").collect()
    assert [(r.label, r.year, r.kind, r.retmax) for r in plan[:3]] == [("pd", 2010, "yearly", 5), ("pd", 2010, "non_english", 2), ("pd", 2011, "yearly", 5)] and len(plan) == 8
    assert plan[1].term == "Parkinson AND hasabstract AND 2010[dp] NOT english[Language]"
    for bad in ({"start": 2012, "stop": 2010}, {"per_year": 0}, {"non_english": -1}):
        with pytest.raises(ValueError):
            ingest.plan_queries(ingest.topics(spark), **bad)
    with pytest.raises(ValueError):
        ingest.topics(spark, {})
    calls, slept = [], []

    def send(url, form):
        calls.append((url.rsplit("/", 1)[1], form))
        if len(calls) == 1:
            return 503, ""
        if "esearch" in url:
            return 200, json.dumps({"esearchresult": {"idlist": ["11", "12"] if form["term"].startswith("P") else ["12"], "count": "9"}})
        return 200, XML

    client = entrez.Service(entrez.Answers(tmp_path / "c"), send, {"api_key": "secret", "tool": "x"}, lambda: 0.0, slept.append)
    small = ingest.plan_queries(ingest.topics(spark, {"pd": "Parkinson", "ad": "Asthma"}), 2010, 2010, 5, 0)
    docs, counts = ingest.run_ingest(spark, client, small)
    assert {r.pmid: r.query_label for r in docs.collect()} == {"11": "pd", "12": "pd"}
    assert sorted(tuple(r) for r in counts.collect()) == [("ad", 2010, "yearly", 9, 1), ("pd", 2010, "yearly", 9, 2)]
    assert slept and 1.0 in slept and calls[0][1]["api_key"] == "secret"
    n = len(calls)
    client.search("Parkinson AND hasabstract AND 2010[dp]", 5)
    assert len(calls) == n == len(client.asked) and client.asked[0] == ("esearch", 503)
    other = entrez.Service(entrez.Answers(tmp_path / "c"), lambda *_: pytest.fail("asked again"), {"email": "e"})
    assert other.search("Parkinson AND hasabstract AND 2010[dp]", 5) == (["11", "12"], 9)
    for bad in (lambda: client.search(" ", 5), lambda: client.search("x", 0), lambda: client.articles(spark, ["a"])):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(entrez.ServiceError):
        entrez.Service(entrez.Answers(tmp_path / "d"), lambda *_: (404, ""), sleep=slept.append).search("x", 1)


def test_store_and_stream(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    text = "Crohn's disease (CD) is linked with NOD2 in many patients and in the controls of this study. NOD2 raises CD risk."
    article = lambda p, t: (p, "NOD2 and CD", t, 2010 + int(p), ["eng"], "J", "", [], "first")
    rows = spark.createDataFrame([article("1", text), article("2", text)], S.ARTICLES + ", query_label string")
    store.upsert(rows)
    store.upsert(rows.withColumns({"title": F.lit("New"), "query_label": F.lit("second")}).where("pmid = '2'"))
    got = {r.pmid: (r.title, r.query_label, r.extracted) for r in store.documents().collect()}
    assert got == {"1": ("NOD2 and CD", "first", False), "2": ("New", "first", False)}
    assert [r.pmid for r in store.documents(True, 1).collect()] == ["1"]
    vocabulary = lex(spark, ("Disease", "Crohn disease", "MESH:D1", "Crohn Disease", 0), ("Gene", "NOD2", "NCBIGene:348", "NOD2", 0))
    tagger, classifier = extract.dictionary_tagger({"NOD2": "Gene", "CD": "Disease"}), extract.constant_classifier("Association", 0.9)
    source = tmp_path / "in"
    rows.coalesce(1).write.json(str(source))
    for _ in range(2):
        incremental.stream(spark, str(source), store, str(tmp_path / "chk"), tagger, classifier, vocabulary).awaitTermination()
    men = store.table("mentions").where("pmid = '1'").collect()
    full = "NOD2 and CD " + text
    assert men and all(full[m.start_char : m.end_char] == m.surface for m in men) and {m.entity_id for m in men} == {"MESH:D1", "NCBIGene:348"}
    rel = store.table("relations").where("pmid = '1'").collect()
    assert {(r.head_id, r.tail_id, r.label, r.confidence) for r in rel} == {("NCBIGene:348", "MESH:D1", "Association", 0.9)} and "[E1] NOD2 [/E1]" in rel[-1].sentence
    n = store.count("mentions")
    batch = incremental.into_store(store, tagger, classifier, vocabulary)
    batch(rows.select("pmid", "title", "abstract", "year", "languages", "journal", "vernacular_title", "other_abstracts", "query_label"), 1)
    assert store.count("mentions") == n and store.count("entities") == 2 and store.documents(True).count() == 0
    sizes = store.build_graph()
    assert sizes == store.build_graph() == {"edges": 1, "edge_years": 2, "entity_stats": 2, "entity_years": 4, "year_docs": 2} and store.meta("graph_min_confidence") == "0.5"
    assert store.graph().neighbors("MESH:D1").first().n_docs == 2
    with pytest.raises(ValueError):
        store.count("secrets")
    with pytest.raises(Exception):  # noqa: B017
        store.save(documents=store.documents().select(F.raise_error(F.lit("stop"))))
    assert store.documents().count() == 2


def test_pipeline_and_command_line(spark, tmp_path):
    from quillweave import cli
    from quillweave.plans import pipeline

    corpus = pubtator.parse(spark.createDataFrame([(BLOCK,)], "value string"))
    vocabulary = lex(spark, ("Gene", "NOD2", "NCBIGene:348", "NOD2", 0), ("Disease", "CD", "MESH:D000544", "CD", 0))
    tagger, classifier = extract.dictionary_tagger({"NOD2": "Gene", "CD": "Disease"}), extract.constant_classifier("Association", 0.9)
    got = pipeline.scores(pipeline.evaluate_pipeline(corpus, tagger, classifier, vocabulary))
    assert {r["type"]: r["accuracy"] for r in got["normalization"]} == {None: 1.0, "Gene": 1.0, "Disease": 1.0}
    assert {r["measure"]: (r["tp"], r["fp"], r["fn"]) for r in got["relations"]} == {"model": (1, 0, 0), "cooccurrence": (1, 0, 0)}
    store = Store(spark, str(tmp_path / "db"))
    store.upsert(spark.createDataFrame([("1", "NOD2 and CD", "", 2012, ["eng"], "", "", [], "x")], S.ARTICLES + ", query_label string"))
    assert pipeline.extract_pending(store, tagger, classifier, vocabulary) == 1 and pipeline.extract_pending(store, tagger, classifier, vocabulary) == 0
    run = lambda *a: cli.run(spark, cli.parser().parse_args(["--db", str(tmp_path / "db"), *a]))
    assert "edges: 1" in run("build-graph")
    assert run("query", "--entity", "nod2", "--evidence", "1")[1].startswith("CD") and len(run("top")) == 2 and len(run("trends", "--entity", "cd", "--min-docs", "1")) == 2
    assert run("export", "--format", "json", "--out", str(tmp_path / "g.json")) == [f"wrote 2 nodes / 1 edges to {tmp_path}/g.json"] and "documents: 1" in run("stats")
    with pytest.raises(SystemExit):
        run("query", "--entity", "nothing")


def test_scores(spark):
    score = lambda a, b, c: spark.range(1).select(*evaluation.prf(F.lit(a), F.lit(b), F.lit(c))).first()
    assert score(8, 2, 8)[3:] == (0.8, 0.5, pytest.approx(2 * 0.8 * 0.5 / 1.3)) and score(0, 0, 0)[3:] == (0.0, 0.0, 0.0)
    with pytest.raises(Exception, match="negative"):
        score(-1, 0, 0)
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "x int")
    assert evaluation.set_prf(ids(1, 2, 3), ids(2, 3, 4, 5, 5), ["x"]).first()[:3] == (2, 2, 1)
    pairs = spark.createDataFrame([("Association", "Association"), ("None", "Positive_Correlation"), ("Association", "Negative_Correlation"), ("Association", "None")], "gold string, predicted string")
    got = {r.measure: r for r in evaluation.sentence_level(pairs).collect()}
    assert got["binary"][1:4] == (2, 1, 1) and got["typed"][1:4] == (1, 2, 2) and got["macro"].f1 == pytest.approx(0.5 / 3)
    cand = spark.createDataFrame([("1", "a", "b", "Association", 0.6, 0), ("1", "b", "a", "Positive_Correlation", 0.9, 1), ("1", "c", "d", "Association", 0.5, 2)], "pmid string, head_key string, tail_key string, label string, confidence double, ordinal int")
    gold = spark.createDataFrame([("1", "b", "a", "Association"), ("1", "a", "z", "Association")], "pmid string, id1 string, id2 string, label string")
    got = {r.measure: r for r in evaluation.document_level(cand, gold).collect()}
    assert got["binary"][1:4] == (1, 1, 1) and got["typed"].tp == 0 and got["ceiling"].recall == 0.5
    rel = spark.createDataFrame([("1", "NCBIGene:a", "MESH:b", "Association", 0.9), ("1", "MESH:z", "a", "Association", 0.2)], "pmid string, head_id string, tail_id string, label string, confidence double")
    got = {r.measure: r for r in evaluation.pipeline_relations(gold, rel).collect()}
    assert got["model"][1:4] == (1, 0, 1) and got["cooccurrence"][1:4] == (2, 0, 0)
    acc = spark.createDataFrame([("Gene", "NCBIGene:1", True, ["1"]), ("Gene", "gene-text:x", False, ["2"]), ("Disease", "MESH:3", True, [])], "type string, entity_id string, matched boolean, ids array<string>")
    assert {r.type: (r.n, r.accuracy) for r in evaluation.normalization_accuracy(acc).collect()} == {None: (2, 0.5), "Gene": (2, 0.5)}
    span = "sentence int, start int, end int, label string"
    m = evaluation.span_metrics(spark.createDataFrame([(0, 0, 4, "Gene"), (0, 5, 7, "Disease"), (1, 0, 2, "Gene")], span), spark.createDataFrame([(0, 0, 4, "Gene"), (0, 5, 8, "Disease"), (1, 0, 2, "Gene"), (1, 3, 4, "Gene")], span))
    assert {r.label: r[1:4] for r in m.collect()}[None] == (2, 2, 1)
    assert evaluation.cooccurrence_baseline(cand).select("label").distinct().first()[0] == "Association"


def test_document_scores_read_each_side_once(spark, tmp_path):
    """One pass over both sides gives what sets of keys give, with repeated, reversed and null values."""
    pick = random.Random(5)
    label, key = (lambda: pick.choice(["Association", "Positive_Correlation", S.NO_RELATION, None])), (lambda: pick.choice("abc"))
    cand = [(str(i % 20), key(), key(), label(), pick.choice([0.2, 0.6, 0.9, None]), i) for i in range(150)]
    gold = [(str(i % 23), key(), key(), label()) for i in range(70)]
    spark.createDataFrame(cand, "pmid string, head_key string, tail_key string, label string, confidence double, ordinal int").write.parquet(str(tmp_path / "cand"))
    spark.createDataFrame(gold, "pmid string, id1 string, id2 string, label string").write.parquet(str(tmp_path / "gold"))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("FileScan")
    pair = lambda r: (r[0], *sorted(r[1:3]))
    compared = lambda g, p: (len(g & p), len(p - g), len(g - p))

    best: dict = {}
    for r in (r for r in cand if r[3] not in (S.NO_RELATION, None)):
        mine = (r[4] is not None, -(r[4] or 0), r[5], r[3])
        best[pair(r)] = min(best.get(pair(r), mine), mine)
    truth, every = {pair(r) for r in gold}, {pair(r) for r in cand}
    want = {"binary": compared(truth, set(best)), "typed": compared({(*pair(r), r[3]) for r in gold}, {(*k, b[3]) for k, b in best.items()}), "ceiling": compared(truth, every)}
    found = evaluation.document_level(read("cand"), read("gold"))
    assert {r.measure: tuple(r[1:4]) for r in found.collect()} == want and scans(found) == 2

    rel = read("cand").select("pmid", F.concat(F.lit("MESH:"), "head_key").alias("head_id"), F.col("tail_key").alias("tail_id"), "label", "confidence")
    sure = {pair(r) for r in cand if r[3] not in (S.NO_RELATION, None) and (r[4] or 0) >= 0.5}
    found = evaluation.pipeline_relations(read("gold"), rel, 0.5)
    assert {r.measure: tuple(r[1:4]) for r in found.collect()} == {"model": compared(truth, sure), "cooccurrence": compared(truth, every)} and scans(found) == 2
