"""Models and vocabularies put together, extraction into a store, and its evaluation on an annotated corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.models import classifier as classifiers
from quillweave.models import tagger as taggers
from quillweave.operators import evaluation, linking
from quillweave.operators.dictionary import Dictionary
from quillweave.operators.store import Store
from quillweave.plans.extract import Classifier, Tagger, extract, ner_examples, relation_examples, tag
from quillweave.sources import lexicon as vocabularies
from quillweave.sources import pubtator

#: Where a folder of models has each.
TAGGER, CLASSIFIER = "tagger", "classifier"


@dataclass
class Pipeline:
    """What an extraction needs."""

    tagger: Tagger
    classifier: Classifier
    lexicon: DataFrame


def load_pipeline(spark: SparkSession, models: str, lexicons: str, dictionary: bool = False) -> Pipeline:
    """The trained models of a folder and the vocabularies of another; with `dictionary` names are found by the vocabularies instead of a
    tagger. A model that isn't there is a FileNotFoundError."""
    lexicon = vocabularies.read_all(spark, lexicons)
    tagger = Dictionary(lexicon) if dictionary else taggers.PerceptronTagger.load(spark, f"{models}/{TAGGER}")
    return Pipeline(tagger, classifiers.LogisticClassifier.load(spark, f"{models}/{CLASSIFIER}"), lexicon)


def span_scores(tagger: Tagger, sentences: DataFrame) -> DataFrame:
    """Span precision, recall and F1, by type and over all, on sentences (pmid, index, text, spans)."""
    key = F.concat_ws("/", "pmid", "index").alias("sentence")
    spans = lambda df: df.select(key, F.explode("spans").alias("s")).select("sentence", "s.start", "s.end", "s.label")
    return evaluation.span_metrics(spans(sentences), spans(tag(sentences.select("pmid", "index", "text"), tagger)))


def train_tagger(spark: SparkSession, splits: dict[str, pubtator.Corpus], models: str) -> dict:
    """Train on the Train split, save, and score on the others that there are."""
    examples = {n: ner_examples(c.documents, c.entities) for n, c in splits.items()}
    made = taggers.PerceptronTagger(spark, taggers.train(examples["Train"]))
    made.save(f"{models}/{TAGGER}")
    return {"sentences": {n: e.count() for n, e in examples.items()}} | {n: [r.asDict() for r in span_scores(made, e).collect()] for n, e in examples.items() if n != "Train"}


def train_classifier(spark: SparkSession, splits: dict[str, pubtator.Corpus], models: str) -> dict:
    """Train on the Train split, choose the round by the Dev split if there is one, save, and score on the splits besides Train, with the
    co-occurrence baseline beside it."""
    examples = {n: relation_examples(c.documents, c.entities, c.relations) for n, c in splits.items()}
    weights, rounds = classifiers.train(examples["Train"], examples.get("Dev"))
    made = classifiers.LogisticClassifier(spark, weights)
    made.save(f"{models}/{CLASSIFIER}")
    out: dict = {"label_distribution": {n: {r["label"]: r["n"] for r in classifiers.label_distribution(e).collect()} for n, e in examples.items()}, "development_f1": rounds}
    for n, e in examples.items():
        if n != "Train":
            model = e.select(F.col("label").alias("gold"), made(F.col("text"))["label"].alias("predicted"))
            baseline = e.select(F.col("label").alias("gold"), F.lit("Association").alias("predicted"))
            out[n] = {k: [r.asDict() for r in evaluation.sentence_level(p).collect()] for k, p in (("model", model), ("cooccurrence", baseline))}
    return out


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select("pmid", F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))).alias("text"))


def extract_pending(store: Store, tagger: Tagger, classifier: Classifier, lexicon: DataFrame, limit: int | None = None, redo: bool = False, batch: int | None = None) -> int:
    """Extract the store's documents that aren't extracted yet (all with `redo`), the first `limit` by pmid, with the
    abbreviations of the whole corpus; how many there were. They are replaced as a whole, so a repeated run is harmless. With `batch` so
    many documents are committed at a time, in the order of pmid, so that what is done by then outlives a failure."""
    pending = store.documents(only_unextracted=not redo, limit=limit).persist()
    try:
        n = pending.count()
        corpus = linking.corpus_abbreviations(linking.document_abbreviations(_texts(store.documents()))).persist()
        for part in _parts(pending, n, batch):
            store.extract(lambda keep, part=part: extract(part, tagger, classifier, lexicon, corpus, keep))
        corpus.unpersist()
        return n
    finally:
        pending.unpersist()


def _parts(pending: DataFrame, n: int, batch: int | None) -> Iterator[DataFrame]:
    """Runs of `batch` documents in the order of pmid, each begun after the last pmid of the one before."""
    if batch is None or n <= batch:
        yield from [pending] if n else []
        return
    last = None
    while True:
        part = (pending if last is None else pending.where(F.col("pmid") > last)).orderBy("pmid").limit(batch).persist()
        last = part.agg(F.max("pmid")).first()[0]
        if last is None:
            return
        yield part
        part.unpersist()


def gold_resolution(corpus: pubtator.Corpus, lexicon: DataFrame) -> DataFrame:
    """(type, entity_id, matched, ids) of gold spans with ids, linked with the abbreviations of their own documents."""
    spans = corpus.entities.where(F.size("ids") > 0).select("pmid", "ordinal", F.col("text").alias("surface"), F.col("label").alias("type"), "ids")
    own = linking.document_abbreviations(_texts(corpus.documents))
    return linking.resolve_mentions(linking.with_long_form(spans, own), lexicon, ["type", "ids"]).select("type", "entity_id", "matched", "ids")


def evaluate_pipeline(corpus: pubtator.Corpus, tagger: Tagger, classifier: Classifier, lexicon: DataFrame, min_confidence: float = S.MIN_CONFIDENCE) -> dict[str, DataFrame]:
    """`normalization` (per type and over all) and `relations` (model and co-occurrence) scores on an annotated corpus."""
    found = extract(pubtator.as_documents(corpus), tagger, classifier, lexicon)
    return {"normalization": evaluation.normalization_accuracy(gold_resolution(corpus, lexicon)), "relations": evaluation.pipeline_relations(corpus.relations, found.relations, min_confidence)}


def scores(frames: dict[str, DataFrame]) -> dict:
    """The few rows of evaluate_pipeline as plain values, for sinks.graph_files.write_json."""
    return {name: [r.asDict() for r in df.collect()] for name, df in frames.items()}
