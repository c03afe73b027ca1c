"""A tagger that is trained: a structured perceptron over hashed features of tokens, decoded by Viterbi over the tags."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.models import mixing

KIND = "tagger"
#: Rows of weights by a hashed feature, with one weight a tag; then those of a tag after another or at the start.
DIMS, TAGS = 1 << 17, len(S.TAGS)
SIZE = DIMS * TAGS + (TAGS + 1) * TAGS
ROUNDS, SHARDS = 6, 8
TOKEN = re.compile(r"\w+|[^\w\s]")
#: Score of a tag that may not follow: an inside tag only goes on a span of its type.
_BARRED = np.float32(-1e9)
_LEGAL = np.zeros((TAGS + 1, TAGS), dtype=np.float32)
for _before in range(TAGS + 1):
    for _tag, _name in enumerate(S.TAGS):
        if _name[0] == "I" and not (_before < TAGS and S.TAGS[_before][2:] == _name[2:]):
            _LEGAL[_before, _tag] = _BARRED


def shape(word: str) -> str:
    """Kinds of characters, runs as one."""
    return re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else c for c in word))


def features(words: list[str]) -> np.ndarray:
    """Hashed features of each token: spelling, affixes, shape, and the same of its neighbours."""
    low, form = [w.lower() for w in words], [shape(w) for w in words]
    at = lambda x, i: x[i] if 0 <= i < len(x) else "|"
    out = np.empty((len(words), 16), dtype=np.int32)
    for i, w in enumerate(words):
        b = low[i]
        out[i] = mixing.hashed((
            f"w{w}", f"l{b}", f"s{form[i]}", f"p{b[:2]}", f"q{b[:3]}", f"e{b[-2:]}", f"f{b[-3:]}", f"g{b[-4:]}", f"n{min(len(w), 9)}",
            f"a{at(low, i - 1)}", f"b{at(low, i + 1)}", f"c{at(low, i - 1)} {b}", f"d{b} {at(low, i + 1)}", f"h{at(form, i - 1)} {form[i]}", f"i{form[i]} {at(form, i + 1)}", f"j{at(low, i - 2)}",
        ), DIMS)
    return out


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best legal tags of a sentence from each token's scores and those of a tag after another (the last row: at the start)."""
    if not len(scores):
        return np.zeros(0, dtype=np.int64)
    moves = moves + _LEGAL
    best, back = scores[0] + moves[TAGS], np.zeros(scores.shape, dtype=np.int64)
    for i in range(1, len(scores)):
        ways = best[:, None] + moves[:TAGS]
        back[i] = ways.argmax(axis=0)
        best = ways[back[i], np.arange(TAGS)] + scores[i]
    tags = np.empty(len(scores), dtype=np.int64)
    tags[-1] = best.argmax()
    for i in range(len(scores) - 1, 0, -1):
        tags[i - 1] = back[i, tags[i]]
    return tags


def _parts(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return w[: DIMS * TAGS].reshape(DIMS, TAGS), w[DIMS * TAGS : SIZE].reshape(TAGS + 1, TAGS)


def gold_tags(tokens: list[tuple[int, int]], spans: list[dict]) -> list[int]:
    """Of each token the begin or inside tag of the first span that it overlaps, as functions.spans.token_tags gives it."""
    out, last = [], None
    for start, end in tokens:
        hit = next((i for i, s in enumerate(spans) if start < s["end"] and end > s["start"]), None)
        out.append(0 if hit is None else S.TAGS.index(f"{'I' if hit == last else 'B'}-{spans[hit]['label']}"))
        last = hit
    return out


def _examples(sentences: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, tags = [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                found = list(TOKEN.finditer(text or ""))
                ids.append(features([m[0] for m in found]).tobytes())
                tags.append(np.array(gold_tags([m.span() for m in found], spans or []), dtype=np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("pmid"), batch.column("index"), pa.array(ids, pa.binary()), pa.array(tags, pa.binary())], ["pmid", "index", "ids", "tags"])

    return sentences.select(F.col("pmid").cast("string").alias("pmid"), F.col("index").cast("int").alias("index"), "text", "spans").mapInArrow(run, "pmid string, index int, ids binary, tags binary")


def _learn(rows: list[pa.RecordBatch], w: np.ndarray) -> np.ndarray:
    """One pass of the perceptron: the weights after it, and their mean over it."""
    w = w[:SIZE]
    late, count = np.zeros(SIZE, dtype=np.float32), 1
    (emit, moves), (emit_late, moves_late) = _parts(w), _parts(late)
    for batch in rows:
        for ids, tags in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            gold = np.frombuffer(tags, np.int8).astype(np.int64)
            if not len(gold):
                continue
            x = np.frombuffer(ids, np.int32).reshape(len(gold), -1)
            got = viterbi(emit[x].sum(axis=1), moves)
            wrong = np.flatnonzero(got != gold)
            for sign, tag in ((1, gold), (-1, got)) if len(wrong) else ():
                before = np.append(TAGS, tag[:-1])
                np.add.at(moves, (before, tag), sign)
                np.add.at(moves_late, (before, tag), sign * count)
                at = (x[wrong].reshape(-1), np.repeat(tag[wrong], x.shape[1]))
                np.add.at(emit, at, sign)
                np.add.at(emit_late, at, sign * count)
            count += 1
    return np.concatenate([w, w - late / count])


def train(sentences: DataFrame, rounds: int = ROUNDS, shards: int = SHARDS) -> np.ndarray:
    """Weights learnt from sentences (pmid, index, text, spans), as plans.extract.ner_examples gives them: the mean over the rounds of
    each shard's averaged weights. Without sentences all are zero, and nothing is tagged."""
    rows = mixing.sharded(_examples(sentences), ["pmid", "index"], shards)
    try:
        w, means = np.zeros(SIZE, dtype=np.float32), []
        for _ in range(rounds):
            out = mixing.mix(rows, _learn, w)
            if len(out) == SIZE:
                return w
            w = out[:SIZE]
            means.append(out[SIZE:])
        return np.mean(means, axis=0, dtype=np.float32)
    finally:
        rows.unpersist()


def tagged(text: str, w: np.ndarray) -> list[dict]:
    """The spans of one text."""
    found = list(TOKEN.finditer(text))
    if not found:
        return []
    emit, moves = _parts(w)
    spans: list[dict] = []
    for m, tag in zip(found, viterbi(emit[features([m[0] for m in found])].sum(axis=1), moves).tolist(), strict=True):
        name = S.TAGS[tag]
        if name[0] == "B":
            spans.append({"start": m.start(), "end": m.end(), "label": name[2:], "text": ""})
        elif name[0] == "I":
            spans[-1]["end"] = m.end()
    return [s | {"text": text[s["start"] : s["end"]]} for s in spans]


class PerceptronTagger:
    """Tags a text's spans (schemas.SPANS); null and empty texts have none. The weights reach each worker once."""

    def __init__(self, spark: SparkSession, weights: np.ndarray):
        self.spark, self.weights = spark, weights
        self.bound = spark.sparkContext.broadcast(weights)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PerceptronTagger:
        return cls(spark, mixing.load(spark, path, KIND, SIZE))

    def save(self, path: str) -> None:
        mixing.save(self.spark, path, KIND, self.weights)

    def __call__(self, text: Column) -> Column:
        bound = self.bound

        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            w = bound.value
            for texts in parts:
                yield pd.Series([tagged(t, w) for t in texts.fillna("")], index=texts.index)

        return F.pandas_udf(run, S.SPANS)(text)
