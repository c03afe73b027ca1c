"""Language-model scores: a hashed maximum-entropy model with class-factored softmax beside exact unigram counts."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import U64, Scratch, arrow, lower_bytes, mix, pieces, range_hashes, session_of, text_column, words

#: Classes, slots of a class, and how many of all slots are buckets of rare words; the others are single frequent words.
CLASSES, MEMBERS, RARE = 32, 64, 512
SLOTS = CLASSES * MEMBERS
OWN = SLOTS - RARE
#: Rows of the hashed weight tables: of the class softmax and of the softmax within a class.
CLASS_ROWS, MEMBER_ROWS = 4096, 8192
#: Rounds of training (each document is learnt from in one of them), tokens of an update, step.
ROUNDS, BATCH, RATE = 3, 4096, 0.08
#: Uses of a weight row in a batch up to which its gradients are summed along with other rows'.
PASSES = 24
#: Tokens, or weight rows, that are worked on at once, so that their arrays stay in a core's cache.
STRIP = 512
#: Up to this size of all logits their softmax needs no shift by each token's largest one: no sum of exponentials leaves float32.
PLAIN = 80
#: Frequent words whose counts are sent to all tasks (at most 4 MB); the counts of the others are joined.
FREQUENT = 1 << 18
#: Distinct words that a task holds before it passes their counts on.
HELD = 2_000_000
END = np.int64(1)
START = SLOTS


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of all tokens in order: the words (63-bit hashes, A-Z in lower case) of each row, then its end."""
    low = lower_bytes(raw)
    start, end, row = words(low, offsets)
    word = (range_hashes(low, start, end) >> U64(1)).astype(np.int64) if len(start) else np.zeros(0, np.int64)
    n = len(offsets) - 1
    at = np.arange(len(row)) + row
    out_row, out = np.repeat(np.arange(n), np.bincount(row, minlength=n) + 1), np.full(len(row) + n, END)
    out[at] = word
    return out_row, out


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, c): how often each token occurs in docs (text). Summed in each task before they are shuffled."""

    def merged(keys, counts):
        k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return k, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)

    def run(batches):
        keys, counts, held = [], [], 0
        out = lambda k, c: pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["w", "c"])
        for part in pieces(batches, 2 << 20):
            k, c = np.unique(tokens(*text_column(part.column(0)))[1], return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD:
                k, c = merged(keys, counts)
                keys, counts, held = [k], [c], len(k)
                if held > HELD // 2:
                    yield out(k, c)
                    keys, counts, held = [], [], 0
        if keys:
            yield out(*merged(keys, counts))

    return arrow(docs.select("text"), run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """Broadcastable. frequent: sorted words and their counts; own: sorted words of single slots and their slots; rare_n and
    rare_v: tokens and distinct words of each bucket of rare words; the biases and hashed rows of both softmaxes."""

    total: int
    distinct: int
    frequent: tuple[np.ndarray, np.ndarray]
    own: tuple[np.ndarray, np.ndarray]
    rare_n: np.ndarray
    rare_v: np.ndarray
    class_bias: np.ndarray
    member_bias: np.ndarray
    class_rows: np.ndarray
    member_rows: np.ndarray

    def slots(self, word: np.ndarray) -> np.ndarray:
        out = OWN + (mix(word.view(U64)) % U64(RARE)).astype(np.int64)
        names, slot = self.own
        if len(names):
            at = np.minimum(np.searchsorted(names, word), len(names) - 1)
            out = np.where(names[at] == word, slot[at], out)
        return out

    def counts(self, word: np.ndarray) -> np.ndarray:
        """Training counts of words, -1 where they are not among the frequent ones."""
        names, n = self.frequent
        if not len(names):
            return np.full(len(word), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(names, word), len(names) - 1)
        return np.where(names[at] == word, n[at], -1)


def contexts(row: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Tokens x 4 hashes: the slot before, the two before, the one two before and the one three before."""
    before = []
    for k in (1, 2, 3):
        b = np.full(len(slot), START, dtype=np.int64)
        same = row[k:] == row[:-k]
        b[k:][same] = slot[:-k][same]
        before.append(b.astype(U64))
    one, two, three = before
    with np.errstate(over="ignore"):
        return np.stack([mix(h) for h in (one * U64(8) + U64(1), (one * U64(4096) + two) * U64(8) + U64(2), two * U64(8) + U64(3), three * U64(8) + U64(4))], axis=1)


def rows_of(context: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weight rows of each token: those of its context, and those of its context in the class of its slot."""
    with np.errstate(over="ignore"):
        inner = mix(context ^ ((slot // MEMBERS).astype(U64) * U64(0x9E3779B97F4A7C15))[:, None])
    return (context % U64(CLASS_ROWS)).astype(np.uint16), (inner % U64(MEMBER_ROWS)).astype(np.uint16)


def _softmax(z: np.ndarray) -> None:
    """In place."""
    if z.max(initial=0) > PLAIN or z.min(initial=0) < -PLAIN:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], np.float32))[:, None]


def forward(m: Model, outer: np.ndarray, inner: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of all classes, and of all slots of the token's class."""
    of = slot // MEMBERS
    a, b = np.empty((len(slot), CLASSES), np.float32), np.empty((len(slot), MEMBERS), np.float32)
    spaces = [np.empty((min(len(slot), STRIP), x.shape[1]), np.float32) for x in (a, b)]
    for i in range(0, len(slot), STRIP):
        j = min(i + STRIP, len(slot))
        a[i:j] = m.class_bias
        m.member_bias.take(of[i:j], axis=0, out=b[i:j], mode="clip")
        for x, table, rows, space in ((a[i:j], m.class_rows, outer[i:j], spaces[0][: j - i]), (b[i:j], m.member_rows, inner[i:j], spaces[1][: j - i])):
            for k in range(rows.shape[1]):
                x += table.take(rows[:, k], axis=0, out=space, mode="clip")
            _softmax(x)
    return a, b


def log_slots(m: Model, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """log10 of each token's slot's probability in its context."""
    out = np.zeros(len(slot))
    context = contexts(row, slot)
    for i in range(0, len(slot), BATCH):
        s = slot[i : i + BATCH]
        a, b = forward(m, *rows_of(context[i : i + BATCH], s), s)
        k = np.arange(len(s))
        out[i : i + BATCH] = np.log10(a[k, s // MEMBERS].astype(np.float64)) + np.log10(b[k, s % MEMBERS].astype(np.float64))
    return out


def _sums(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that occur, how often, the sum of x over the tokens of each), most used rows first; rows: tokens x features. Rows
    that occur up to PASSES times are summed for all at once, an occurrence at a time; the others one by one."""
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    at, token = flat[order], order // rows.shape[1]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(np.append(first, len(at)))
    by = np.argsort(-n, kind="stable")
    first, n = first[by], n[by]
    out = x.take(token[first], axis=0)
    more = np.searchsorted(-n, -np.arange(PASSES + 1))  # how many rows occur more than 0, 1, 2, ... times
    often = int(more[PASSES])
    for j in range(1, PASSES):
        out[often : more[j]] += x.take(token[first[often : more[j]] + j], axis=0)
    for i in range(often):
        x.take(token[first[i] : first[i] + n[i]], axis=0).sum(axis=0, out=out[i])
    return at[first], n, out


def _descend(weights: np.ndarray, squares: np.ndarray, hits: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One update by the summed gradients of a batch; each weight has its own rate."""
    u, n, g = _sums(gradient, rows)
    hits[u] += n
    for i in range(0, len(u), STRIP):
        v, x = u[i : i + STRIP], g[i : i + STRIP]
        s = squares.take(v, axis=0)
        s += x * x
        squares[v] = s
        s += 1e-3
        x *= RATE
        x /= np.sqrt(s, out=s)
        weights[v] -= x


def learnt(docs: DataFrame, model: Model) -> Model:
    """The model after a round: every task descends on its own documents from the same weights; the moves of each weight
    row are averaged by how often the tasks used it."""
    bound = session_of(docs).sparkContext.broadcast(model)

    def run(batches):
        m = bound.value
        tables = {0: m.class_rows.copy(), 1: m.member_rows.copy()}
        mine = replace(m, class_rows=tables[0], member_rows=tables[1])
        squares = {k: np.zeros_like(t) for k, t in tables.items()}
        hits = {k: np.zeros(len(t), dtype=np.int64) for k, t in tables.items()}
        for part in pieces(batches, 1 << 20):
            row, word = tokens(*text_column(part.column(0)))
            slot = mine.slots(word)
            context = contexts(row, slot)
            for i in range(0, len(slot), BATCH):
                s = slot[i : i + BATCH]
                outer, inner = rows_of(context[i : i + BATCH], s)
                a, b = forward(mine, outer, inner, s)
                k = np.arange(len(s))
                a[k, s // MEMBERS] -= 1
                b[k, s % MEMBERS] -= 1
                _descend(tables[0], squares[0], hits[0], outer, a)
                _descend(tables[1], squares[1], hits[1], inner, b)
        for k, start in ((0, m.class_rows), (1, m.member_rows)):
            u = np.flatnonzero(hits[k])
            if len(u):
                move = ((tables[k][u] - start[u]) * hits[k][u, None]).astype(np.float32)
                yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(u), k), pa.int32()), "row": pa.array(u, pa.int32()), "hits": pa.array(hits[k][u]), "move": pa.array([x.tobytes() for x in move], pa.binary())})

    def summed(key, table):
        row, hits = table.column("row").to_numpy(), table.column("hits").to_numpy()
        move = np.frombuffer(b"".join(table.column("move").to_pylist()), dtype=np.float32).reshape(len(row), -1)
        u, at = np.unique(row, return_inverse=True)
        total, n = np.zeros((len(u), move.shape[1])), np.bincount(at, weights=hits)
        np.add.at(total, at, move)
        return pa.table({"kind": pa.array([key[0].as_py()] * len(u), pa.int32()), "row": pa.array(u, pa.int32()), "move": pa.array([x.tobytes() for x in (total / n[:, None]).astype(np.float32)], pa.binary())})

    moves = arrow(docs.select("text"), run, "kind int, row int, hits long, move binary").withColumn("block", F.shiftright("row", 4)).groupBy("kind", "block").applyInArrow(summed, "kind int, row int, move binary").toArrow()
    tables = [model.class_rows.copy(), model.member_rows.copy()]
    for kind, row, move in zip(*(moves.column(c).to_pylist() for c in ("kind", "row", "move")), strict=True):
        tables[kind][row] += np.frombuffer(move, dtype=np.float32)
    return replace(model, class_rows=tables[0], member_rows=tables[1])


def start(counts: DataFrame) -> Model:
    """The model before training: biases by the counts of classes and slots, all else zero. Of the counts (w, c) only the
    frequent ones and sums over buckets reach the driver."""
    top = counts.orderBy(F.col("c").desc(), "w").limit(FREQUENT).toArrow()
    names, n = (top.column(c).to_numpy() for c in ("w", "c"))
    order = np.argsort(names)
    own = names[:OWN]
    sort = np.argsort(own)
    all_ = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()

    def buckets(batches):
        rare_n, rare_v = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
        for batch in batches:
            w, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = ~np.isin(w, own)
            at = (mix(w[keep].view(U64)) % U64(RARE)).astype(np.int64)
            rare_n += np.bincount(at, weights=c[keep], minlength=RARE).astype(np.int64)
            rare_v += np.bincount(at, minlength=RARE)
        yield pa.RecordBatch.from_pydict({"b": pa.array(np.arange(RARE), pa.int32()), "n": rare_n, "v": rare_v})

    found = arrow(counts.select("w", "c"), buckets, "b int, n long, v long").groupBy("b").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow()
    rare_n, rare_v = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
    rare_n[found.column("b").to_numpy()], rare_v[found.column("b").to_numpy()] = found.column("n").to_numpy(), found.column("v").to_numpy()
    weight = np.full(SLOTS, 0.1)
    weight[: len(own)] += n[: len(own)]
    weight[OWN:] += rare_n
    grid = weight.reshape(CLASSES, MEMBERS)
    return Model(
        int(all_["n"]), int(all_["v"]), (names[order], n[order]), (own[sort], sort.astype(np.int64)), rare_n, rare_v,
        np.log(grid.sum(axis=1) / grid.sum()).astype(np.float32), np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32),
        np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((MEMBER_ROWS, MEMBERS), np.float32),
    )


PARTS = "row long, doc_id long, n_tokens long, n_known long, base double, score double, w array<long>, tf array<long>"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """What a task knows of each of its documents without the counts of infrequent words, which it lists (w, tf)."""
    bound = session_of(docs).sparkContext.broadcast(model)

    def run(batches):
        from pyspark import TaskContext

        m, n_row = bound.value, TaskContext.get().partitionId() << 40
        floor = np.log10(m.total + m.distinct + 1)
        within = np.log10(m.rare_n + m.rare_v + 1.0)
        for part in pieces(batches, 1 << 20):
            n = part.num_rows
            row, word = tokens(*text_column(part.column(1)))
            slot = m.slots(word)
            own = log_slots(m, row, slot)
            rare = slot >= OWN
            own[rare] -= within[slot[rare] - OWN]
            c = m.counts(word)
            known = c >= 0
            log = np.where(known, np.log10(np.maximum(c, 0) + 1.0), 0.0)
            sums = lambda x: np.bincount(row, weights=x, minlength=n)  # noqa: B023, E731
            lost = ~known
            words_, inverse = np.unique(word[lost], return_inverse=True)
            key, tf = np.unique(row[lost] * np.int64(max(1, len(words_))) + inverse, return_counts=True)
            at = np.concatenate([[0], np.cumsum(np.bincount(key // max(1, len(words_)), minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(n_row + np.arange(n)), part.column(0), pa.array(np.bincount(row, minlength=n)), pa.array(sums(c > 0).astype(np.int64)), pa.array(sums(log - floor)), pa.array(sums(own + np.where(rare, log, 0.0))),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(words_[key % max(1, len(words_))])), pa.ListArray.from_arrays(pa.array(at), pa.array(tf.astype(np.int64)))],
                [f.split()[0] for f in PARTS.split(", ")],
            )
            n_row += n

    return arrow(docs.select("doc_id", "text"), run, PARTS)


def train(docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """docs: (doc_id, text), all learnt from; counts: word_counts of them."""
    model = start(counts)
    part = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(rounds))
    for r in range(rounds):
        model = learnt(docs.where(part == r), model)
    return model


def language_scores(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    A token's probability is that of its slot's class in its context, times that of the slot within the class, times,
    for a bucket of rare words, the word's share (c + 1) / (n + v + 1) of the bucket. Counts are exact for all words: the
    most frequent ones' are broadcast, the others' joined. A null text is empty: the end alone; a null id stays null;
    repeated rows give repeated results. Without training rows all counts are zero.
    """
    scratch = Scratch(session_of(docs), "lm")
    pick = lambda d: d.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs, training = pick(docs), pick(training)
    counts = scratch.keep(word_counts(training))
    model = train(training, counts, rounds)
    parts = scratch.keep(scored(docs, model))
    asked = parts.select("row", F.explode(F.arrays_zip("w", "tf")).alias("x")).select("row", F.col("x.w").alias("w"), F.col("x.tf").alias("tf"))
    # A listed word is always of a bucket of rare words, as every single slot's word is frequent.
    joined = asked.join(counts, "w").groupBy("row").agg(F.sum("tf").alias("known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("log"))
    return parts.drop("w", "tf").join(joined, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("log", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("log", F.lit(0.0))).alias("score"),
    )
