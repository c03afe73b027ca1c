"""Quality scores by attention-based multiple-instance learning: every passage of a document is encoded, gated attention learnt from
document labels weighs the passages, and the weighted sum is what is scored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import U64, arrow, hash_bound, lower_bytes, pieces, range_hashes, session_of, text_column, words

#: Words of a passage; the last one of a text may be shorter. A text without words is one empty passage.
PASSAGE = 48
#: The most labelled documents that the model is fitted on: those whose ids hash lowest.
SAMPLE = 8_000
EPOCHS, BATCH, RATE, SEED = 8, 64, 3e-3, 7
#: Hashed counts of a passage's words, encoded passage, gate.
BUCKETS, CODE, GATE = 64, 24, 16

_CLASS = np.full(256, 6, dtype=np.uint8)  # other symbols
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[[0x20, 0x09]] = 3
_CLASS[0x0A:0x0E] = 4
_CLASS[[*b".,;:!?'\"-"]] = 5
WIDTH = 8 + 10 + BUCKETS


def passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each passage of the rows that offsets mark in raw, and the row of each: shares of kinds of characters, lengths,
    repetitions and spellings of words, hashed words. Every row has a passage."""
    low = lower_bytes(raw)
    start, end, row = words(low, offsets)
    rows = len(offsets) - 1
    n_words = np.bincount(row, minlength=rows)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    base = np.cumsum(n_passages) - n_passages
    first_word = np.cumsum(n_words) - n_words
    of = base[row] + (np.arange(len(row)) - first_word[row]) // PASSAGE
    total = int(n_passages.sum())
    out = np.zeros((total, WIDTH), dtype=np.float32)
    owner = np.repeat(np.arange(rows), n_passages)
    if not len(start):
        return out, owner
    heads = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    used, tails = of[heads], np.append(heads[1:], len(of)) - 1
    count = (tails - heads + 1).astype(np.float32)
    kind = _CLASS[raw]
    size = (end[tails] - start[heads]).astype(np.float32)
    for c in range(8):
        upto = np.concatenate([[0], np.cumsum(kind == c, dtype=np.int64)])
        out[used, c] = (upto[end[tails]] - upto[start[heads]]) / size
    mean = lambda x: np.add.reduceat(x.astype(np.float32), heads) / count
    length, key = end - start, range_hashes(low, start, end)
    same = np.append(False, (key[1:] == key[:-1]) & (of[1:] == of[:-1]))
    order = np.lexsort((key, of))
    new = np.append(True, (key[order][1:] != key[order][:-1]) | (of[order][1:] != of[order][:-1]))
    letters = np.concatenate([[0], np.cumsum((kind < 2) | (kind == 7), dtype=np.int64)])
    upper = np.concatenate([[0], np.cumsum(kind == 1, dtype=np.int64)])
    capital, lettered = upper[end] - upper[start], letters[end] - letters[start]
    numbers = (mean(length), np.sqrt(mean(length * length)), mean(same), np.bincount(of[order][new], minlength=total)[used] / count, mean(capital > 0), mean(capital > 1), mean(length == 1), mean(length > 14), mean(lettered == 0), np.log1p(count))
    for i, x in enumerate(numbers):
        out[used, 8 + i] = x
    hashed = np.bincount(of * BUCKETS + (key & U64(BUCKETS - 1)).astype(np.int64), minlength=total * BUCKETS).reshape(total, BUCKETS)
    out[:, 18:] = np.sqrt(hashed)
    return out, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: dict, x: np.ndarray, heads: np.ndarray, owner: np.ndarray) -> dict:
    """The net's values for passages x of documents that start at heads: attention is tanh times sigmoid of the encoded passage,
    softmaxed over each document's passages."""
    h = np.tanh((x - p["mean"]) / p["scale"] @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"] + p["v"]), _sigmoid(h @ p["U"] + p["u"])
    e = (t * s) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, heads)[owner])
    a = e / np.add.reduceat(e, heads)[owner]
    z = np.add.reduceat(h * a[:, None], heads)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}


def gradients(p: dict, f: dict, x: np.ndarray, heads: np.ndarray, owner: np.ndarray, label: np.ndarray) -> dict:
    """Of the mean log loss, by each learnt array."""
    off = (f["y"] - label) / len(label)
    h, t, s, a = f["h"], f["t"], f["s"], f["a"]
    dz = (off[:, None] * p["c"])[owner]
    da = (h * dz).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, heads)[owner])
    dg = de[:, None] * p["w"]
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
    return {
        "W": ((x - p["mean"]) / p["scale"]).T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "v": dt.sum(axis=0), "U": h.T @ ds, "u": ds.sum(axis=0),
        "w": (t * s).T @ de, "c": f["z"].T @ off, "d": off.sum(),
    }


def start(mean: np.ndarray, scale: np.ndarray) -> dict:
    draw = np.random.default_rng(SEED)
    of = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    zero = lambda n: np.zeros(n, dtype=np.float32)
    return {"mean": mean, "scale": scale, "W": of(len(mean), CODE), "b": zero(CODE), "V": of(CODE, GATE), "v": zero(GATE), "U": of(CODE, GATE), "u": zero(GATE), "w": of(GATE), "c": of(CODE), "d": np.float32(0)}


def learn(x: np.ndarray, owner: np.ndarray, label: np.ndarray) -> dict:
    """The model of passages x of documents owner (ascending, each has some) with labels, by Adam over shuffled batches of documents."""
    p = start(x.mean(axis=0), x.std(axis=0) + np.float32(1e-2))
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(v) for k, v in p.items()}
    begin = np.searchsorted(owner, np.arange(len(label) + 1))
    draw, step = np.random.default_rng(SEED), 0
    for _ in range(EPOCHS):
        for some in np.array_split(draw.permutation(len(label)), max(1, len(label) // BATCH)):
            size = begin[some + 1] - begin[some]
            heads = np.cumsum(size) - size
            part = x[np.repeat(begin[some] - heads, size) + np.arange(size.sum())]
            who = np.repeat(np.arange(len(some)), size)
            step += 1
            for k, g in gradients(p, forward(p, part, heads, who), part, heads, who, label[some]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
    return {k: np.asarray(a, dtype=np.float32) for k, a in p.items()}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The model learnt from docs (id, text) with labels (id, label 0 or 1); None without any labelled document.

    Rows without a label count for nothing, null texts as empty; a document with several labels is good if one says so. At most `sample`
    documents are learnt from, in the order of their ids' hashes. Tasks encode their passages, whole texts of them; one learns from those.
    """
    known = labels.where(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(F.max("label").cast("int").alias("label"))
    # Twice the sample by expectation passes the bound, so few rows meet in the task that ranks them.
    chosen = known.withColumn("h", F.xxhash64("id")).where(F.col("h") <= hash_bound(2 * sample, known.count())).orderBy("h", "id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "id").select("h", "id", "label", "text")

    def encode(batches):
        for part in pieces(batches, 1 << 20, text_at=3):
            x, owner = passages(*text_column(part.column(3)))
            cut = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
            packed = pa.array([x[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), packed], ["h", "id", "label", "x"])

    def run(batches):
        found, label = [], []
        for batch in batches:
            found += [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in batch.column(3).to_pylist()]
            label += batch.column(2).to_pylist()
        if found:
            p = learn(np.concatenate(found), np.repeat(np.arange(len(found)), [len(f) for f in found]), np.array(label, dtype=np.float32))
            yield pa.RecordBatch.from_pydict({"name": list(p), "value": [a.tobytes() for a in p.values()]})

    passed = arrow(rows, encode, "h long, id long, label int, x binary").repartition(1).sortWithinPartitions("h", "id", "x")
    got = {r["name"]: np.frombuffer(r["value"], np.float32) for r in arrow(passed, run, "name string, value binary").collect()}
    if not got:
        return None
    shape = start(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32))
    return {k: v.reshape(np.shape(shape[k])) for k, v in got.items()}


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score from 0 to 1, n_passages, top (the passage that has most attention, from 0) and its share. Without a model every
    score is one half. A null or empty text is one empty passage; a null id stays null; repeated rows give repeated results; texts
    are read whole."""
    bound = session_of(docs).sparkContext.broadcast(model)

    def run(batches):
        p = bound.value
        for part in pieces(batches, 1 << 20, text_at=1):
            x, owner = passages(*text_column(part.column(1)))
            heads = np.searchsorted(owner, np.arange(part.num_rows))
            size = np.diff(np.append(heads, len(owner)))
            if p is None:
                y, a = np.full(part.num_rows, 0.5), (1 / size)[owner]
            else:
                f = forward(p, x, heads, owner)
                y, a = f["y"].astype(np.float64), f["a"]
            most = np.maximum.reduceat(a, heads)
            at = np.flatnonzero(a == most[owner])
            top = at[np.searchsorted(owner[at], np.arange(part.num_rows))] - heads  # the first of equals
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(y), pa.array(size.astype(np.int64)), pa.array(top.astype(np.int64)), pa.array(most.astype(np.float64))], ["id", "score", "n_passages", "top", "share"])

    return arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), run, "id long, score double, n_passages long, top long, share double")
