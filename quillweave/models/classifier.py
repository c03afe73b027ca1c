"""A pair classifier that is trained: multinomial logistic regression over hashed features around the marks."""

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
from quillweave.operators import evaluation

KIND = "classifier"
DIMS, LABELS = 1 << 17, len(S.RELATION_LABELS)
SIZE = DIMS * LABELS
ROUNDS, SHARDS, RATE, L2 = 8, 8, 0.3, 1e-6
_MARKS = (*S.HEAD_MARKS, *S.TAIL_MARKS)
_TOKEN = re.compile("|".join(map(re.escape, _MARKS)) + r"|\w+|[^\w\s]")
RESULT = "struct<label:string,probabilities:map<string,double>>"


def features(marked: str) -> np.ndarray:
    """Distinct hashed features: words before, between and after the two marked names, pairs of neighbours between them, the
    order of the names and how far apart they are. A text without marks has the words alone."""
    tokens = [t if t in _MARKS else t.lower() for t in _TOKEN.findall(marked)]
    at = [tokens.index(m) if m in tokens else -1 for m in _MARKS]
    if min(at) < 0:
        return np.unique(mixing.hashed(["none", *(f"x{t}" for t in tokens)], DIMS))
    (left, left_end), (right, right_end) = sorted([(at[0], at[1]), (at[2], at[3])])
    before, between, after = tokens[:left], tokens[left_end + 1 : right], tokens[right_end + 1 :]
    names = [f"o{at[0] < at[2]}", f"d{min(len(between), 12)}", "bias"]
    names += [f"b{t}" for t in between] + [f"B{t[:5]}" for t in between] + [f"p{a} {b}" for a, b in zip(between, between[1:], strict=False)]
    names += [f"l{t}" for t in before[-4:]] + [f"r{t}" for t in after[:4]] + [f"x{t}" for t in before + after]
    names += [f"h{t}" for t in tokens[at[0] + 1 : at[1]]] + [f"t{t}" for t in tokens[at[2] + 1 : at[3]]] + [f"f{t} {at[0] < at[2]}" for t in between]
    return np.unique(mixing.hashed(names, DIMS))


def label_distribution(examples: DataFrame, *by: str) -> DataFrame:
    """(by..., label, n): how many examples have each label."""
    return examples.groupBy(*by, "label").agg(F.count("*").alias("n"))


def class_weights(examples: DataFrame) -> np.ndarray:
    """Of each label the weight that makes labels count alike; one for labels that don't occur."""
    n = {r["label"]: r["n"] for r in label_distribution(examples).where(F.col("label").isin(*S.RELATION_LABELS)).collect()}
    return np.array([sum(n.values()) / (len(n) * n[c]) if c in n else 1.0 for c in S.RELATION_LABELS], dtype=np.float32)


def _examples(examples: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = [features(t or "").astype(np.int32).tobytes() for t in batch.column(0).to_pylist()]
            label = [S.RELATION_LABELS.index(c) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.int32()), pa.array(ids, pa.binary())], ["text", "label", "ids"])

    return examples.select(F.col("text").cast("string").alias("text"), "label").where(F.col("label").isin(*S.RELATION_LABELS)).mapInArrow(run, "text string, label int, ids binary")


def probabilities(w: np.ndarray, ids: np.ndarray) -> np.ndarray:
    z = w.reshape(DIMS, LABELS)[ids].sum(axis=0)
    e = np.exp(z - z.max())
    return e / e.sum()


def _learner(weight: np.ndarray, seed: int):
    def learn(rows: list[pa.RecordBatch], w: np.ndarray) -> np.ndarray:
        """One pass of gradient steps over a shard in a drawn order, each coordinate with a rate of its own (the sum of its squares)."""
        labels = np.concatenate([b.column(1).to_numpy() for b in rows])
        ids = [np.frombuffer(x, np.int32) for b in rows for x in b.column(2).to_pylist()]
        table, squares = w.reshape(DIMS, LABELS), np.full((DIMS, LABELS), 1e-2, dtype=np.float32)
        for i in np.random.default_rng(seed).permutation(len(ids)):
            at = ids[i]
            g = probabilities(w, at).astype(np.float32)
            g[labels[i]] -= 1
            g = weight[labels[i]] * g + L2 * table[at]
            squares[at] += g * g
            table[at] -= RATE * g / np.sqrt(squares[at])
        return w

    return learn


def train(examples: DataFrame, development: DataFrame | None = None, rounds: int = ROUNDS, shards: int = SHARDS) -> tuple[np.ndarray, list[float]]:
    """Weights learnt from examples (text, label), as plans.extract.relation_examples gives them, and the typed F1 on the development
    examples after each round: the best round's weights are returned, the first of equals, or the last round's without any. Labels weigh
    by how rare they are; other labels are left out."""
    rows = mixing.sharded(_examples(examples), ["text", "label"], shards)
    held = None if development is None else development.select("text", F.col("label").alias("gold")).persist()
    try:
        weight, w = class_weights(examples), np.zeros(SIZE, dtype=np.float32)
        best, scores = w, []
        for k in range(rounds):
            w = mixing.mix(rows, _learner(weight, k), w)
            if held is None:
                best = w
                continue
            classifier = LogisticClassifier(examples.sparkSession, w)
            pairs = held.select("gold", classifier(F.col("text"))["label"].alias("predicted"))
            f1 = evaluation.sentence_level(pairs).where(F.col("measure") == "typed").first()["f1"]
            classifier.bound.destroy()
            if not scores or f1 > max(scores):
                best = w
            scores.append(f1)
        return best, scores
    finally:
        rows.unpersist()
        if held is not None:
            held.unpersist()


class LogisticClassifier:
    """Labels marked sentences, with the probability of each label; a null text counts as empty. The weights reach each worker once."""

    def __init__(self, spark: SparkSession, weights: np.ndarray):
        self.spark, self.weights = spark, weights
        self.bound = spark.sparkContext.broadcast(weights)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LogisticClassifier:
        return cls(spark, mixing.load(spark, path, KIND, SIZE))

    def save(self, path: str) -> None:
        mixing.save(self.spark, path, KIND, self.weights)

    def __call__(self, marked: Column) -> Column:
        bound = self.bound

        def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            w = bound.value
            for texts in parts:
                found = [probabilities(w, features(t)) for t in texts.fillna("")]
                yield pd.DataFrame({"label": [S.RELATION_LABELS[p.argmax()] for p in found], "probabilities": [dict(zip(S.RELATION_LABELS, map(float, p), strict=True)) for p in found]}, index=texts.index)

        return F.pandas_udf(run, RESULT)(marked)
