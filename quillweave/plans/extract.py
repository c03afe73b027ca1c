"""Extraction end to end: articles -> sentences -> spans -> entities -> classified pairs, as one lazy plan."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions import spans as SP
from quillweave.functions.language import nlp_scope
from quillweave.functions.sentences import document_sentences
from quillweave.operators import linking
from quillweave.operators.shared import dealt
from quillweave.sources.pubtator import annotations


class Tagger(Protocol):
    """A Column function from a sentence to its spans (start, end, label, text); a model is an iterator pandas_udf. One that needs a join
    has a method `tag` instead, from sentences (pmid, index, text, ...) to those with `spans`."""

    def __call__(self, text: Column) -> Column: ...


class Classifier(Protocol):
    """A Column function from a marked sentence to struct<label:string,probabilities:map<string,double>>."""

    def __call__(self, marked: Column) -> Column: ...


def dictionary_tagger(terms: dict[str, str]) -> Tagger:
    """Tags whole words of a small dictionary {term: type}, as they are spelled; overlaps go to the longer term."""
    pattern = re.compile("|".join(rf"(?<!\w){re.escape(t)}(?!\w)" for t in sorted(terms, key=lambda t: (-len(t), t)))) if terms else None

    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [{"start": m.start(), "end": m.end(), "label": terms[m[0]], "text": m[0]} for m in pattern.finditer(t or "")] if pattern else [])

    return F.pandas_udf(run, S.SPANS)


def constant_classifier(label: str, confidence: float) -> Classifier:
    """Gives every pair the same label; what is left is the probability of no relation."""
    return lambda marked: F.struct(F.lit(label).alias("label"), F.create_map(F.lit(label), F.lit(confidence), F.lit(S.NO_RELATION), F.lit(1.0 - confidence)).alias("probabilities"))


def relation_confidence(probabilities: Column) -> Column:
    """The probability of any relation, between 0 and 1; 1 if that of none is missing."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - F.coalesce(F.try_element_at(probabilities, F.lit(S.NO_RELATION)), F.lit(0.0))))


def tag(sentences: DataFrame, tagger: Tagger) -> DataFrame:
    """Sentences (pmid, index, text, ...) with `spans`."""
    return tagger.tag(sentences) if hasattr(tagger, "tag") else sentences.withColumn("spans", tagger(F.col("text")))


@dataclass
class Extraction:
    """Tables of one run: scopes (pmid, nlp_scope), mentions, relations, and entities with the order they were seen in."""

    scopes: DataFrame
    mentions: DataFrame
    relations: DataFrame
    entities: DataFrame


def sentences(documents: DataFrame) -> DataFrame:
    """(pmid, index, start, end, text) of what can be read as English; offsets are those in title + blank + abstract."""
    scoped = documents.select("pmid", "title", "abstract", nlp_scope(F.col("title"), F.col("abstract")).alias("scope")).where(F.col("scope") != S.SCOPE_NONE)
    abstract = F.when(F.col("scope") == S.SCOPE_FULL, F.coalesce("abstract", F.lit(""))).otherwise("")
    return scoped.select("pmid", F.explode(document_sentences(F.col("title"), abstract)).alias("s")).select("pmid", "s.*")


def extract(documents: DataFrame, tagger: Tagger, classifier: Classifier, lexicon: DataFrame, corpus: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Extraction:
    """documents (pmid, title, abstract), a vocabulary (schemas.LEXICON) and optionally corpus abbreviations (short, long).

    `keep` works a table out once and gives it back to be read again, as a store's transaction does: with it spans are tagged, mentions
    linked and pairs classified once for all tables; without it each table works them out anew. Linking shuffles distinct surfaces,
    not mentions. Mentions of a large input are dealt by document into partitions of bounded input. Pairs are formed inside a sentence's array, so no self-join of mentions.
    """
    scopes = documents.select("pmid", nlp_scope(F.col("title"), F.col("abstract")).alias("nlp_scope"))
    tagged = keep(tag(sentences(documents), tagger))
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    defined = linking.document_abbreviations(documents.select("pmid", text.alias("text")))
    flat = tagged.select("pmid", "index", F.col("start").alias("at"), "text", F.posexplode("spans").alias("k", "span"))
    flat = flat.select("pmid", "index", "at", "text", "k", F.col("span.start").alias("start"), F.col("span.end").alias("end"), F.col("span.label").alias("type"), F.col("span.text").alias("surface"))
    carry = ["pmid", "index", "at", "text", "k", "start", "end", "type", "surface"]
    linked = keep(linking.resolve_mentions(linking.with_long_form(flat, defined, corpus), lexicon, carry))
    mentions = linked.select("pmid", F.col("index").alias("sentence_index"), (F.col("start") + F.col("at")).alias("start_char"), (F.col("end") + F.col("at")).alias("end_char"), "surface", "type", "entity_id")
    keyed = F.struct("start", "k", "end", F.col("type").alias("label"), F.col("entity_id").alias("key"))
    per_sentence = dealt(linked, "pmid").groupBy("pmid", "index").agg(F.first("text").alias("text"), F.array_sort(F.collect_list(keyed)).alias("mentions"))
    pairs = per_sentence.select("pmid", "index", "text", F.explode(SP.candidate_pairs(F.col("mentions"))).alias("p")).where(SP.apart(F.col("p.head"), F.col("p.tail")))
    marked = pairs.select("pmid", "index", "p", SP.mark_entities(F.col("text"), F.col("p.head"), F.col("p.tail")).alias("sentence"))
    classified = marked.withColumn("c", classifier(F.col("sentence")))
    relations = classified.select("pmid", F.col("index").alias("sentence_index"), F.col("p.head.key").alias("head_id"), F.col("p.tail.key").alias("tail_id"), "c.label", relation_confidence(F.col("c.probabilities")).alias("confidence"), "sentence")
    entities = linked.groupBy("entity_id").agg(F.min(F.struct("pmid", "index", "k", "type", "name", "matched")).alias("f"))
    entities = entities.select("entity_id", "f.type", "f.name", "f.matched", F.concat_ws("/", "f.pmid", F.lpad(F.col("f.index").cast("string"), 8, "0"), F.lpad(F.col("f.k").cast("string"), 8, "0")).alias("ordinal"))
    return Extraction(scopes, mentions, relations, entities)


def ner_examples(documents: DataFrame, gold: DataFrame) -> DataFrame:
    """(pmid, index, text, spans) of annotated documents (pmid, title, abstract) and gold entities (pmid, start, end, label,
    text): every sentence with the spans that lie within it, without overlaps."""
    every = documents.select("pmid", F.explode(document_sentences(F.col("title"), F.col("abstract"))).alias("s")).select("pmid", "s.*")
    inside = linking.contained(every, gold.select("pmid", "start", "end", "label", "text"))
    spans = inside.groupBy("pmid", "index").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label", "text"))).alias("spans"))
    joined = every.select("pmid", "index", "text").join(spans, ["pmid", "index"], "left")
    return joined.select("pmid", "index", "text", SP.remove_overlaps(F.coalesce("spans", F.array().cast(S.SPANS))).alias("spans"))


def relation_examples(documents: DataFrame, gold_entities: DataFrame, gold_relations: DataFrame) -> DataFrame:
    """(pmid, sentence_index, text, head_key, tail_key, head_type, tail_type, label): candidate pairs of gold entities
    (…, ids, ordinal), labelled by the first gold relation (pmid, id1, id2, label, ordinal) of the unordered pair, or None."""
    every = documents.select("pmid", F.explode(document_sentences(F.col("title"), F.col("abstract"))).alias("s")).select("pmid", "s.*")
    keyed = gold_entities.select("pmid", "start", "end", "label", "ordinal", F.posexplode("ids").alias("n", "key"))
    inside = linking.contained(every, keyed)
    mentions = inside.groupBy("pmid", "index").agg(F.array_sort(F.collect_list(F.struct("start", "ordinal", "n", "end", "label", "key"))).alias("m"))
    pairs = mentions.join(every.select("pmid", "index", "text"), ["pmid", "index"]).select("pmid", "index", "text", F.explode(SP.candidate_pairs(F.col("m"))).alias("p")).where(SP.apart(F.col("p.head"), F.col("p.tail")))
    x, y = F.least("p.head.key", "p.tail.key"), F.greatest("p.head.key", "p.tail.key")
    truth = gold_relations.groupBy("pmid", F.least("id1", "id2").alias("x"), F.greatest("id1", "id2").alias("y")).agg(F.min(F.struct("ordinal", "label")).alias("f"))
    labelled = pairs.withColumns({"x": x, "y": y}).join(truth, ["pmid", "x", "y"], "left")
    return labelled.select(
        "pmid", F.col("index").alias("sentence_index"), SP.mark_entities(F.col("text"), F.col("p.head"), F.col("p.tail")).alias("text"), F.col("p.head.key").alias("head_key"), F.col("p.tail.key").alias("tail_key"),
        F.col("p.head.label").alias("head_type"), F.col("p.tail.label").alias("tail_type"), F.coalesce("f.label", F.lit(S.NO_RELATION)).alias("label"),
    )


_EXAMPLE = {"pmid": pa.string(), "sentence_index": pa.int32(), "text": pa.string(), "head_key": pa.string(), "tail_key": pa.string(), "head_type": pa.string(), "tail_type": pa.string(), "label": pa.string()}
_EXAMPLES = "pmid string, sentence_index int, text string, head_key string, tail_key string, head_type string, tail_type string, label string"
#: Examples of a batch.
ROWS = 2000


def annotated_examples(blocks: DataFrame) -> DataFrame:
    """The rows of `relation_examples` for an annotated corpus (pubtator.Corpus.blocks): as all that a pair needs stands in its document's
    block, documents are read once and nothing is joined. Blocks with the same number are documents of their own."""
    read = blocks.select("pmid", F.concat("title", F.lit(" "), "abstract").alias("text"), "rows", document_sentences(F.col("title"), F.col("abstract")).alias("s"))
    return read.select("pmid", "text", "rows", F.transform("s", lambda s: s["start"]).alias("starts"), F.transform("s", lambda s: s["end"]).alias("ends")).mapInArrow(_examples, _EXAMPLES)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _EXAMPLE.values(), strict=True)], list(_EXAMPLE))
    found: list[tuple] = []
    for given in batches:
        for document in zip(*(c.to_pylist() for c in given.columns), strict=True):
            for row in _pairs(*document):
                found.append(row)
                if len(found) >= ROWS:
                    yield batch(found)
                    found = []
    if found:
        yield batch(found)


def _pairs(pmid: str, text: str, rows: list[str], starts: list[int], ends: list[int]) -> Iterator[tuple]:
    """The examples of one document, whose sentences are in order and don't overlap."""
    known = annotations(text, rows)
    inside: dict[int, list[tuple]] = {}
    for entity in known.entities:
        k = bisect_right(starts, entity[0]) - 1
        while k >= 0 and ends[k] >= entity[1]:
            inside.setdefault(k, []).append(entity)
            k -= 1
    for k in sorted(inside):
        first: dict[str, tuple] = {}
        for entity in sorted(inside[k], key=lambda e: e[0]):
            first.setdefault(entity[3], entity)
        ordered = sorted(first.values(), key=lambda e: (S.HEAD_ORDER[e[2]], e[0]))
        for i, head in enumerate(ordered):
            for tail in ordered[i + 1 :]:
                if head[2] != tail[2] and (head[1] <= tail[0] or tail[1] <= head[0]):
                    yield pmid, k, _marked(text, starts[k], ends[k], head, tail), head[3], tail[3], head[2], tail[2], known.relations.get(frozenset((head[3], tail[3])), S.NO_RELATION)


def _marked(text: str, start: int, end: int, head: tuple, tail: tuple) -> str:
    """A sentence with both spans in their marks, as spans.mark_entities gives it."""
    (a, am), (b, bm) = ((head, S.HEAD_MARKS), (tail, S.TAIL_MARKS)) if head[0] < tail[0] else ((tail, S.TAIL_MARKS), (head, S.HEAD_MARKS))
    return f"{text[start : a[0]]}{am[0]} {text[a[0] : a[1]]} {am[1]}{text[a[1] : b[0]]}{bm[0]} {text[b[0] : b[1]]} {bm[1]}{text[b[1] : end]}"
