"""Precision, recall and F1 of predictions against a gold standard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.stats import ratio
from quillweave.operators.shared import dealt

POSITIVE = tuple(label for label in S.RELATION_LABELS if label != S.NO_RELATION)


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """tp, fp, fn as long with precision, recall and f1; a zero denominator gives 0.0, a negative count is an error."""
    least = F.least(tp, fp, fn)
    tp = F.when(least < 0, F.raise_error(F.lit("counts must not be negative")).cast("long")).otherwise(tp.cast("long"))
    return [tp.alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def set_prf(gold: DataFrame, predicted: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Compare two sets of rows; with `by` (part of the keys) once for each of its values and once for all (null).

    Both sides are tagged and put together; one aggregation by key makes them distinct and compares them. Where the input is large its rows
    are dealt by key before, into partitions of bounded input.
    """
    tag = lambda df, g: df.select(*keys, F.lit(g).alias("g"), F.lit(1 - g).alias("p"))
    each = dealt(tag(gold, 1).union(tag(predicted, 0)), *keys).groupBy(*keys).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    counts = (_count((F.col("g") == 1) & (F.col("p") == 1)).alias("a"), _count((F.col("g") == 0) & (F.col("p") == 1)).alias("b"), _count((F.col("g") == 1) & (F.col("p") == 0)).alias("c"))
    summed = (each.rollup(*by) if by else each.groupBy()).agg(*counts)
    return summed.select(*(by or []), *prf(F.col("a"), F.col("b"), F.col("c")))


def span_metrics(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Exact spans (sentence, start, end, label), per label and over all (label null)."""
    return set_prf(gold, predicted, ["sentence", "start", "end", "label"], by=["label"])


def sentence_level(pairs: DataFrame) -> DataFrame:
    """Rows (measure, tp, fp, fn, precision, recall, f1) for pairs (gold, predicted) of labels: `binary` (any relation),
    `typed`, each positive label, and `macro`, whose f1 is the mean of theirs. One pass over the pairs."""
    g, p, none = F.col("gold"), F.col("predicted"), S.NO_RELATION
    cases = {"binary": ((g != none) & (p != none), (g == none) & (p != none), (g != none) & (p == none)), "typed": ((g == p) & (p != none), (p != none) & (p != g), (g != none) & (p != g))}
    cases |= {x: ((g == x) & (p == x), (p == x) & (g != x), (g == x) & (p != x)) for x in POSITIVE}
    sums = pairs.agg(*(F.struct(*(_count(c).alias(k) for k, c in zip("abc", three, strict=True))).alias(name) for name, three in cases.items()))
    rows = sums.select(F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(f"{n}.a").alias("a"), F.col(f"{n}.b").alias("b"), F.col(f"{n}.c").alias("c")) for n in cases))).alias("r")).select("r.*")
    scored = rows.select("measure", *prf(F.col("a"), F.col("b"), F.col("c")))
    null = lambda t: F.lit(None).cast(t)
    macro = scored.where(F.col("measure").isin(*POSITIVE)).agg(F.avg("f1").alias("f1")).select(F.lit("macro"), null("long"), null("long"), null("long"), null("double"), null("double"), "f1")
    return scored.union(macro)


def cooccurrence_baseline(candidates: DataFrame) -> DataFrame:
    """Every candidate is an association, surely."""
    return candidates.withColumns({"label": F.lit("Association"), "confidence": F.lit(1.0)})


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("x"), F.greatest(a, b).alias("y")]


def _scored(each: DataFrame, cases: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Rows (measure, tp, fp, fn, precision, recall, f1): for each case the sums of three numbers over the rows, all in one pass."""
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    sums = each.agg(*(F.struct(*(total(c).alias(k) for k, c in zip("abc", three, strict=True))).alias(name) for name, three in cases.items()))
    rows = sums.select(F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), f"{n}.a", f"{n}.b", f"{n}.c") for n in cases))).alias("r")).select("r.*")
    return rows.select("measure", *prf(F.col("a"), F.col("b"), F.col("c")))


def _against(gold: Column, predicted: Column) -> tuple[Column, Column, Column]:
    return gold & predicted, ~gold & predicted, gold & ~predicted


def document_level(candidates: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows (measure, counts and scores) of classified candidates (pmid, head_key, tail_key, label, confidence, ordinal)
    against all gold relations (pmid, id1, id2, label): `binary`, `typed`, and `ceiling`, whose recall is the share of gold
    pairs that are candidates at all. Of a pair's positive predictions the surest counts, then the first.

    Both sides are put together and dealt by document once; what a label has in a pair, and then what a pair has, comes of the rows as
    they lie, and all three measures of that.
    """
    order = F.struct((-F.col("confidence")).alias("c"), "ordinal")
    truth = gold.select("pmid", *_pair("id1", "id2"), "label", F.lit(1).alias("g"), F.lit(0).alias("p"))
    pairs = candidates.select("pmid", *_pair("head_key", "tail_key"), "label", F.lit(0).alias("g"), F.lit(1).alias("p"), F.when(F.col("label") != S.NO_RELATION, order).alias("o"))
    rows = dealt(truth.unionByName(pairs, allowMissingColumns=True), "pmid")
    labels = rows.groupBy("pmid", "x", "y", "label").agg(F.max("g").alias("g"), F.max("p").alias("p"), F.min("o").alias("o"))
    best = F.min(F.when(F.col("o").isNotNull(), F.struct("o", "label", "g"))).alias("best")
    each = labels.groupBy("pmid", "x", "y").agg(F.sum("g").alias("n"), F.max("p").alias("p"), best)
    is_gold, found, right = F.col("n") > 0, F.col("best").isNotNull(), F.coalesce("best.g", F.lit(0))
    typed = (right, found.cast("int") - right, F.col("n") - right)
    return _scored(each, {"binary": _against(is_gold, found), "typed": typed, "ceiling": _against(is_gold, F.col("p") > 0)})


def strip_prefix(entity_id: Column) -> Column:
    return F.regexp_replace(entity_id, "^(NCBIGene:|MESH:)", "")


def normalization_accuracy(resolved: DataFrame) -> DataFrame:
    """Per type and over all (type null): n, accuracy and vocabulary_hit_rate of rows (type, entity_id, matched, ids). Rows
    without gold ids don't count; no rows give 0.0."""
    rows = resolved.where(F.size(F.coalesce("ids", F.array().cast("array<string>"))) > 0)
    right = F.array_contains("ids", strip_prefix(F.col("entity_id")))
    summed = rows.rollup("type").agg(F.count("*").alias("n"), _count(right).alias("right"), _count(F.col("matched")).alias("hits"))
    return summed.select("type", "n", ratio(F.col("right"), F.col("n")).alias("accuracy"), ratio(F.col("hits"), F.col("n")).alias("vocabulary_hit_rate"))


def pipeline_relations(gold: DataFrame, relations: DataFrame, min_confidence: float = S.MIN_CONFIDENCE) -> DataFrame:
    """`model` and `cooccurrence` scores of extracted relations (pmid, head_id, tail_id, label, confidence) against gold
    relations (pmid, id1, id2), as unordered pairs of bare ids in a document. Both sides are put together and dealt by document once."""
    bare = relations.select("pmid", strip_prefix(F.col("head_id")).alias("a"), strip_prefix(F.col("tail_id")).alias("b"), "label", "confidence")
    sure = F.coalesce((F.col("label") != S.NO_RELATION) & (F.col("confidence") >= min_confidence), F.lit(False))
    truth = gold.select("pmid", *_pair("id1", "id2"), F.lit(True).alias("g"), F.lit(False).alias("p"), F.lit(False).alias("sure"))
    found = bare.select("pmid", *_pair("a", "b"), F.lit(False).alias("g"), F.lit(True).alias("p"), sure.alias("sure"))
    each = dealt(truth.unionByName(found), "pmid").groupBy("pmid", "x", "y").agg(*(F.max(c).alias(c) for c in ("g", "p", "sure")))
    return _scored(each, {"model": _against(F.col("g"), F.col("sure")), "cooccurrence": _against(F.col("g"), F.col("p"))})
