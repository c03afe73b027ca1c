"""Spans and tags: conversions within one row, in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.arrays import let

TAG = "struct<start:int,end:int,tag:int>"


def remove_overlaps(spans: Column) -> Column:
    """A set of spans that don't overlap, longer ones first, then earlier ones; ordered by start."""
    keyed = F.transform(spans, lambda s, i: F.struct((s["start"] - s["end"]).alias("size"), s["start"].alias("start"), i.alias("i"), s["end"].alias("end"), s["label"].alias("label"), s["text"].alias("text")))
    kind = "array<struct<size:int,start:int,i:int,end:int,label:string,text:string>>"
    clear = lambda s, kept: F.forall(kept, lambda k: (s["end"] <= k["start"]) | (s["start"] >= k["end"]))
    kept = F.aggregate(F.array_sort(keyed.cast(kind)), F.array().cast(kind), lambda acc, s: F.when(clear(s, acc), F.concat(acc, F.array(s))).otherwise(acc))
    plain = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"), s["text"].alias("text")))
    return F.array_sort(plain)


def token_tags(offsets: Column, spans: Column) -> Column:
    """array<int>: for each token (struct<start,end>) the index of its tag: begin or inside of the first span that it
    overlaps, outside, or IGNORED_TAG for empty tokens."""
    hit = lambda ss, o: F.coalesce(F.array_min(F.transform(ss, lambda s, i: F.when((o["start"] < s["end"]) & (o["end"] > s["start"]), i))), F.lit(-1))
    which = lambda ss: F.transform(offsets, lambda o: F.when(o["start"] == o["end"], F.lit(-2)).otherwise(hit(ss, o)))
    begin = lambda ss, k: F.element_at(F.create_map(*(x for t in S.ENTITY_TYPES for x in (F.lit(t), F.lit(S.TAGS.index(f"B-{t}"))))), F.element_at(ss, k + 1)["label"])
    tag = lambda ss, w, k, i: F.when(k == -2, S.IGNORED_TAG).when(k == -1, 0).otherwise(begin(ss, F.greatest(k, F.lit(0))) + F.when((i > 0) & (F.get(w, i - 1) == k), 1).otherwise(0))
    return let(spans, lambda ss: let(which(ss), lambda w: F.transform(w, lambda k, i: tag(ss, w, k, i))))


def decode_tags(offsets: Column, tags: Column, text: Column) -> Column:
    """Spans (start, end, label, text) of runs of tags. A run begins at a B tag, at an I tag without a run of its type
    before it, and ends at the next begin or O. Empty and ignored tokens break no run. Unequal lengths are an error."""
    kind = "array<struct<start:int,end:int,label:string>>"
    used = F.filter(F.arrays_zip(offsets.alias("o"), tags.alias("t")), lambda x: (x["o"]["start"] != x["o"]["end"]) & (x["t"] != S.IGNORED_TAG))
    names = F.array(*(F.lit(t) for t in S.TAGS))
    part = lambda x, i: F.element_at(F.split(F.element_at(names, x["t"] + 1), "-"), i)

    def step(acc: Column, x: Column) -> Column:
        outside = x["t"] == 0
        last = F.try_element_at(acc["runs"], F.lit(-1))
        label = F.when(~outside, F.try_element_at(F.split(F.element_at(names, x["t"] + 1), "-"), F.lit(2)))
        goes_on = ~outside & acc["open"] & (part(x, 1) == "I") & (label == last["label"])
        new = F.array(F.struct(x["o"]["start"].cast("int").alias("start"), x["o"]["end"].cast("int").alias("end"), label.alias("label")))
        longer = F.array(F.struct(last["start"].alias("start"), x["o"]["end"].cast("int").alias("end"), last["label"].alias("label")))
        runs = F.when(outside, acc["runs"]).when(goes_on, F.concat(F.slice(acc["runs"], F.lit(1), F.size(acc["runs"]) - 1), longer)).otherwise(F.concat(acc["runs"], new))
        return F.struct(runs.cast(kind).alias("runs"), (~outside).alias("open"))

    start = F.struct(F.array().cast(kind).alias("runs"), F.lit(False).alias("open"))
    runs = F.aggregate(used, start, step, lambda acc: acc["runs"])
    spans = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["label"].alias("label"), F.substring(text, r["start"] + 1, r["end"] - r["start"]).alias("text")))
    return F.when(F.size(offsets) == F.size(tags), spans).otherwise(F.raise_error(F.lit("as many tags as tokens are needed")).cast(S.SPANS))


def in_scope(a: Column, b: Column) -> Column:
    """Whether two entity types may be related: any two different ones of the three."""
    known = lambda c: c.isin(*S.ENTITY_TYPES)
    return known(a) & known(b) & (a != b)


def candidate_pairs(mentions: Column) -> Column:
    """array<struct<head,tail>> of a sentence's mentions (start, end, label, key, ...): the first of each key, in pairs of
    types in scope, the head's type first in the order gene, chemical, disease, then by start."""
    ordered = F.array_sort(F.transform(mentions, lambda m, i: F.struct(m["start"].alias("start"), i.alias("i"), m.alias("m"))))
    first = let(ordered, lambda ms: F.filter(ms, lambda m, i: F.size(F.filter(F.slice(ms, F.lit(1), i), lambda x: x["m"]["key"] == m["m"]["key"])) == 0))
    rank = lambda m: F.when(m["m"]["label"] == S.GENE, S.HEAD_ORDER[S.GENE]).when(m["m"]["label"] == S.CHEMICAL, S.HEAD_ORDER[S.CHEMICAL]).otherwise(S.HEAD_ORDER[S.DISEASE])
    ranked = F.array_sort(F.transform(first, lambda m: F.struct(rank(m).alias("rank"), m["start"].alias("start"), m["i"].alias("i"), m["m"].alias("m"))))
    tails = lambda ms, h, i: F.filter(ms, lambda t, j: (j > i) & in_scope(h["m"]["label"], t["m"]["label"]))
    return let(ranked, lambda ms: F.flatten(F.transform(ms, lambda h, i: F.transform(tails(ms, h, i), lambda t: F.struct(h["m"].alias("head"), t["m"].alias("tail"))))))


def apart(a: Column, b: Column) -> Column:
    return (a["end"] <= b["start"]) | (b["end"] <= a["start"])


def mark_entities(text: Column, head: Column, tail: Column) -> Column:
    """The text with both spans in their marks; overlapping spans are an error. Where one span ends as the other begins,
    the marks nest properly."""
    cut = lambda a, b: F.substring(text, a + 1, b - a)
    wrap = lambda s, marks: F.concat(F.lit(marks[0] + " "), cut(s["start"], s["end"]), F.lit(" " + marks[1]))
    order = lambda a, am, b, bm: F.concat(cut(F.lit(0), a["start"]), wrap(a, am), cut(a["end"], b["start"]), wrap(b, bm), cut(b["end"], F.length(text)))
    marked = F.when(head["start"] < tail["start"], order(head, S.HEAD_MARKS, tail, S.TAIL_MARKS)).otherwise(order(tail, S.TAIL_MARKS, head, S.HEAD_MARKS))
    return F.when(apart(head, tail), marked).otherwise(F.raise_error(F.lit("the spans overlap")).cast("string"))
