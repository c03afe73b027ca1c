"""Models that are trained: on an annotated corpus whose held-out names are new."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions import spans as SP
from quillweave.models import classifier as C
from quillweave.models import mixing
from quillweave.models import tagger as T
from quillweave.operators import evaluation
from quillweave.plans import extract, pipeline
from quillweave.sources import lexicon, pubtator

PHRASES = {
    "Positive_Correlation": ["{a} raises the risk of {b}", "higher {a} made {b} worse", "{b} grew under {a}"],
    "Negative_Correlation": ["{a} protects against {b}", "less {b} was seen with {a}", "{a} lowers {b}"],
    "Association": ["{a} is linked with {b}", "{b} and {a} are related"],
    None: ["{a} was measured apart from {b}", "neither {a} nor {b} changed", "{b} was unlike {a}"],
}
KINDS = {"Gene": "GeneOrGeneProduct", "Disease": "DiseaseOrPhenotypicFeature", "Chemical": "ChemicalEntity"}


def names(draw, new):
    syllable = lambda: draw.choice("bdfgklmnprst") + draw.choice("aeiou")
    stem = lambda: "".join(syllable() for _ in range(draw.randrange(2, 4))) + ("x" if new else "")
    return {"Gene": ["".join(c.upper() for c in stem()[:3]) + str(draw.randrange(1, 99)) for _ in range(25)], "Disease": [stem() + "itis" for _ in range(15)] + [f"{stem()} syndrome" for _ in range(10)], "Chemical": [stem() + "amine" for _ in range(25)]}


def corpus_text(seed, n, first=0):
    draw = random.Random(seed)
    known = names(draw, first > 0)
    blocks = []
    for i in range(first, first + n):
        title, parts, entities, relations = "A study of patients", [], [], []
        at = len(title) + 1
        for _ in range(3):
            a, b = draw.sample(sorted(KINDS), 2)
            if S.HEAD_ORDER[a] > S.HEAD_ORDER[b]:
                a, b = b, a
            one, two, label = draw.choice(known[a]), draw.choice(known[b]), draw.choice(list(PHRASES))
            s = draw.choice(["In this group ", "We found that ", "Here "]) + draw.choice(PHRASES[label]).format(a=one, b=two) + "."
            for kind, name in ((a, one), (b, two)):
                entities.append((at + s.index(name), at + s.index(name) + len(name), name, KINDS[kind], f"{kind}:{name}"))
            if label:
                relations.append((label, f"{a}:{one}", f"{b}:{two}"))
            parts.append(s)
            at += len(s) + 1
        rows = [f"{i}\t{s}\t{e}\t{t}\t{k}\t{x}" for s, e, t, k, x in entities] + [f"{i}\t{k}\t{x}\t{y}\tNovel" for k, x, y in relations]
        blocks.append(f"{i}|t|{title}\n{i}|a|{' '.join(parts)}\n" + "\n".join(rows) + "\n")
    return "\n".join(blocks)


@pytest.fixture(scope="module")
def splits(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus") / "BioRED"
    folder.mkdir()
    for split, args in {"Train": (1, 150), "Dev": (2, 30, 1000), "Test": (3, 40, 2000)}.items():
        (folder / f"{split}.PubTator").write_text(corpus_text(*args))
    return folder.parent, {s: pubtator.read_split(spark, s, str(folder.parent)) for s in S.CORPUS_SPLITS}


@pytest.fixture(scope="module")
def trained(spark, splits):
    folder, corpora = splits
    train = extract.ner_examples(corpora["Train"].documents, corpora["Train"].entities)
    return T.PerceptronTagger(spark, T.train(train, rounds=3, shards=4)), train


def micro(scores):
    return next(r.f1 for r in scores.collect() if r.label is None)


def test_the_tagger_finds_new_names(spark, splits, trained):
    tagger, train = trained
    corpora = splits[1]
    held = extract.ner_examples(corpora["Test"].documents, corpora["Test"].entities).persist()
    words = {r.text: r.label for r in train.select(F.explode("spans").alias("s")).select("s.text", "s.label").distinct().collect()}
    f1, baseline = micro(pipeline.span_scores(tagger, held)), micro(pipeline.span_scores(extract.dictionary_tagger(words), held))
    assert f1 > 0.7 and f1 > baseline + 0.2
    for r in held.select("text", tagger(F.col("text")).alias("s")).collect():
        assert all(r.text[s.start : s.end] == s.text and s.label in S.ENTITY_TYPES for s in r.s)
        assert all(a.end <= b.start for a, b in itertools.pairwise(r.s))


def test_training_is_the_same_each_time_and_survives_saving(spark, trained, tmp_path):
    tagger, train = trained
    again = T.train(train.repartition(7), rounds=3, shards=4)
    assert np.array_equal(again, tagger.weights)
    tagger.save(str(tmp_path / "m"))
    assert np.allclose(T.PerceptronTagger.load(spark, str(tmp_path / "m")).weights, tagger.weights)
    with pytest.raises(FileNotFoundError):
        T.PerceptronTagger.load(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        C.LogisticClassifier.load(spark, str(tmp_path / "m"))


def test_viterbi_is_the_best_legal_way():
    draw = np.random.default_rng(0)
    legal = lambda way: all(S.TAGS[t][0] != "I" or (i and S.TAGS[way[i - 1]][2:] == S.TAGS[t][2:]) for i, t in enumerate(way))
    for n in (1, 2, 3, 4):
        scores, moves = draw.standard_normal((n, T.TAGS)).astype("f4"), draw.standard_normal((T.TAGS + 1, T.TAGS)).astype("f4")
        scores[:, 2::2] += 2  # inside tags look good
        value = lambda way: moves[T.TAGS, way[0]] + sum(moves[a, b] for a, b in itertools.pairwise(way)) + sum(scores[i, t] for i, t in enumerate(way))  # noqa: E731, B023
        best = max((w for w in itertools.product(range(T.TAGS), repeat=n) if legal(w)), key=value)
        assert tuple(T.viterbi(scores, moves).tolist()) == best
    assert T.viterbi(np.zeros((0, T.TAGS), "f4"), moves).tolist() == []


def test_odd_texts(spark, trained):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("é" * 5000,), ("ABC12 and " * 2000,)], "text string")
    got = [r.s for r in df.select(trained[0](F.col("text")).alias("s")).collect()]
    assert got[:3] == [[], [], []] and len(got) == 5
    w = T.train(spark.createDataFrame([], f"pmid string, index int, text string, spans {S.SPANS}"), rounds=1)
    assert not w.any() and T.tagged("ABC12 x", w) == []
    spans = [{"start": 0, "end": 4, "label": "Gene", "text": "APOE"}, {"start": 5, "end": 8, "label": "Disease", "text": "a b"}]
    text = "APOE a b c"
    tokens = [(m.start(), m.end()) for m in T.TOKEN.finditer(text)]
    row = spark.createDataFrame([(tokens, spans)], f"offsets array<struct<start:int,end:int>>, spans {S.SPANS}")
    assert row.select(SP.token_tags(F.col("offsets"), F.col("spans"))).first()[0] == T.gold_tags(tokens, spans)


def test_the_classifier_beats_cooccurrence(spark, splits):
    examples = {n: extract.relation_examples(c.documents, c.entities, c.relations).persist() for n, c in splits[1].items()}
    weights, rounds = C.train(examples["Train"], examples["Dev"], rounds=4, shards=4)
    made = C.LogisticClassifier(spark, weights)
    assert len(rounds) == 4 and max(rounds) > 0.8
    typed = lambda predicted: evaluation.sentence_level(examples["Test"].select(F.col("label").alias("gold"), predicted.alias("predicted"))).where("measure = 'typed'").first().f1
    model, baseline = typed(made(F.col("text"))["label"]), typed(F.lit("Association"))
    assert model > 0.8 and model > baseline + 0.3
    for r in examples["Test"].limit(20).select(made(F.col("text")).alias("c")).collect() + spark.createDataFrame([("no marks",), (None,), ("",)], "text string").select(made(F.col("text")).alias("c")).collect():
        assert set(r.c.probabilities) == set(S.RELATION_LABELS) and sum(r.c.probabilities.values()) == pytest.approx(1, abs=1e-5)
        assert r.c.probabilities[r.c.label] == max(r.c.probabilities.values())
    again, same = C.train(examples["Train"].repartition(5), examples["Dev"], rounds=4, shards=4)
    assert np.array_equal(again, weights) and same == rounds


def test_label_weights(spark):
    df = spark.createDataFrame([("a", "None")] * 6 + [("b", "Association")] * 2 + [("c", "Odd")], "text string, label string")
    assert {r.label: r.n for r in C.label_distribution(df).collect()} == {"None": 6, "Association": 2, "Odd": 1}
    assert C.class_weights(df).tolist() == pytest.approx([8 / 12, 2.0, 1.0, 1.0])
    w, scores = C.train(df.where("false"), rounds=1)
    assert not w.any() and scores == []


def test_shards_are_averaged(spark):
    rows = spark.createDataFrame([(i,) for i in range(40)], "i int").repartition(4, "i")
    counts = [n for n in (sum(1 for _ in p) for p in rows.rdd.glom().collect()) if n]
    learn = lambda batches, w: np.concatenate([w + sum(b.num_rows for b in batches), np.ones(2, "f4")])
    got = mixing.mix(rows, learn, np.arange(3, dtype="f4"))
    assert got.tolist() == pytest.approx([x + sum(counts) / len(counts) for x in range(3)] + [1, 1])
    assert mixing.mix(rows.where("false"), learn, np.ones(3, "f4")).tolist() == [1, 1, 1]


def test_commands(spark, tmp_path, monkeypatch):
    from quillweave import cli
    from quillweave.operators.store import Store

    monkeypatch.setattr(T.train, "__defaults__", (2, 2))
    monkeypatch.setattr(C.train, "__defaults__", (None, 2, 2))
    (tmp_path / "BioRED").mkdir()
    for split, args in {"Train": (1, 20), "Dev": (2, 5, 1000)}.items():
        (tmp_path / "BioRED" / f"{split}.PubTator").write_text(corpus_text(*args))
    folder, models, lexicons = str(tmp_path), str(tmp_path / "models"), tmp_path / "lex"
    lexicons.mkdir()
    (lexicons / lexicon.GENE_FILE).write_text("hgnc_id\tsymbol\tname\talias_symbol\talias_name\tprev_symbol\tprev_name\tentrez_id\nHGNC:1\tNOD2\treceptor two\t\t\t\t\t348\n")
    import gzip

    for name, body in ((lexicon.DISEASE_FILE, "# DiseaseName\tDiseaseID\tAltDiseaseIDs\tSynonyms\n#\nCrohn Disease\tMESH:D1\t\tCD\n"), (lexicon.CHEMICAL_FILE, "# ChemicalName\tChemicalID\tMESHSynonyms\tCTDCuratedSynonyms\nBiotin\tMESH:C1\t\t\n")):
        with gzip.open(lexicons / name, "wt") as f:
            f.write("# Fields:\n" + body)
    run = lambda *a: cli.run(spark, cli.parser().parse_args([*a]))
    lex = ("--lexicons", str(lexicons))
    for bad in (("evaluate-pipeline", "--corpus", folder, "--models", models, *lex), ("train-ner", "--corpus", str(tmp_path / "db"), "--models", models), ("stats",), ("evaluate-pipeline", "--corpus", folder, *lex)):
        with pytest.raises(SystemExit):
            run(*bad)
    assert any("label_distribution" in line for line in run("train-re", "--corpus", folder, "--models", models, "--out", str(tmp_path / "re.json")))
    assert (tmp_path / "re.json").exists() and run("train-ner", "--corpus", folder, "--models", models)
    assert any('"relations"' in line for line in run("evaluate-pipeline", "--corpus", folder, "--models", models, "--split", "Dev", *lex))
    store = Store(spark, str(tmp_path / "db"), 2)
    text = "Crohn's disease (CD) is linked with NOD2 in many patients and in the controls of this study."
    store.upsert(spark.createDataFrame([(str(i), "NOD2 and CD", text, 2010 + i, ["eng"], "", "", [], "x") for i in range(5)], S.ARTICLES + ", query_label string"))
    db = ("--db", str(tmp_path / "db"))
    versions = len(store.log.versions())
    assert run(*db, "extract", "--dictionary", "--batch-docs", "3", *lex) == ["5 documents extracted"]
    assert len(store.log.versions()) == versions + 2 and store.documents(True).count() == 0
    assert run(*db, "refresh-graph") == ["built"]
    assert "█" in run(*db, "trends", "--min-docs", "1")[0] and run(*db, "vacuum") == ["0 folders removed"]
    assert cli.sparkline([0, 1, 7]) == "▁▂█" and cli.sparkline([0]) == "▁" and cli.sparkline([]) == ""
