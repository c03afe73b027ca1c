"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import ALNUM, U64, arrow, hash_bound, lower_bytes, mix, pieces, range_hashes, session_of, text_column, words

#: Hashed coordinates. Weights are zero but for those that L1 leaves, so what is broadcast is at most 8 MB, mostly far less.
DIMS = 1 << 20
#: The most labelled documents that the model is fitted on: those whose ids hash lowest.
SAMPLE = 24_000
EPOCHS = 2
#: Bytes of a word's stems, each of which counts as a word of its own beside it.
STEMS = (4, 5, 6)
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.7, 0.1


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of each word, stem, pair of neighbours and pair with one word between, in lower case."""
    low = lower_bytes(raw)
    start, end, row = words(low, offsets, ALNUM)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = range_hashes(low, start, end)
    rows, keys = [row], [one]
    for size in STEMS:
        long = end - start >= size
        rows.append(row[long])
        keys.append(range_hashes(low, start[long], start[long] + size) ^ U64(0x5EED))
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            same = row[gap:] == row[:-gap]
            rows.append(row[gap:][same])
            keys.append((one[:-gap] * U64(3) + one[gap:] * U64(2 * gap + 5))[same])
        coordinate = mix(np.concatenate(keys)) & U64(DIMS - 1)
    return np.concatenate(rows), coordinate.astype(np.int64)


def _distinct(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(row * DIMS + at)
    return both // DIMS, both % DIMS


class Learner:
    """FTRL-proximal: each coordinate has its own rate, from the sum of its squared gradients; L1 keeps most at zero.
    Coordinate DIMS is the bias, without L1."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == DIMS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        """One example, its distinct coordinates."""
        at = np.append(at, DIMS)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(DIMS + 1)
        w = self.weights(at)
        keep = np.flatnonzero(w)
        return keep.astype(np.int32), w[keep].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero weights (coordinate, weight) learnt from docs (id, text) with labels (id, label 0 or 1).

    Rows without a label count for nothing, null texts as empty; a document with several labels is toxic if one says so.
    At most `sample` documents are learnt from, in the order of their ids' hashes; one task does it, an example at a
    time. Without labels every weight is zero and every score one half.
    """
    known = labels.where(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(F.max("label").cast("int").alias("label"))
    # Twice the sample by expectation passes the bound, so few rows meet in the task that ranks them.
    chosen = known.withColumn("h", F.xxhash64("id")).where(F.col("h") <= hash_bound(2 * sample, known.count())).orderBy("h", "id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "id").select("h", "id", "label", "text").repartition(1).sortWithinPartitions("h", "id", "text")

    def run(batches):
        learner, seen = Learner(), []
        for part in pieces(batches, 1 << 20):
            row, at = _distinct(*features(*text_column(part.column(3))))
            label = part.column(2).to_pylist()
            cut = np.searchsorted(row, np.arange(len(label) + 1))
            for i, y in enumerate(label):
                one = at[cut[i] : cut[i + 1]]
                learner.learn(one, y)
                seen.append((one.astype(np.int32), y))
        for _ in range(EPOCHS - 1):
            for one, y in seen:
                learner.learn(one, y)
        at, w = learner.sparse()
        yield pa.RecordBatch.from_pydict({"at": [at.tobytes()], "w": [w.tobytes()]})

    found = arrow(rows, run, "at binary, w binary").collect()
    return (np.frombuffer(found[0]["at"], np.int32), np.frombuffer(found[0]["w"], np.float32)) if found else (np.zeros(0, np.int32), np.zeros(0, np.float32))


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score from 0 to 1. A null or empty text has the score of the bias alone; a null id stays null;
    repeated rows give repeated results; texts are read whole."""
    bound = session_of(docs).sparkContext.broadcast(weights)

    def run(batches):
        at, w = bound.value
        dense = np.zeros(DIMS + 1, dtype=np.float32)
        dense[at] = w
        for part in pieces(batches, 1 << 20):
            row, key = features(*text_column(part.column(1)))
            hit = dense[key] != 0
            row, key = _distinct(row[hit], key[hit])
            margin = np.bincount(row, weights=dense[key].astype(np.float64), minlength=part.num_rows) + float(dense[DIMS])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))], ["id", "score"])

    return arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), run, "id long, score double")
