"""Approximate nearest neighbours by learned partitions: a balanced partitioning of a neighbour graph, a small
classifier that routes to the most probable partitions, and exact reranking."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillweave.llm.common import arrow, hash_bound, session_of

#: Vectors that the partitions and the classifier are fitted on (those whose ids hash lowest); all rows are indexed.
SAMPLE = 8192
#: Rows of a partition, as far as MOST_PARTITIONS allow; partitions are split into blocks of BLOCK_ROWS by hash of the id.
PARTITION_ROWS, MOST_PARTITIONS, BLOCK_ROWS, QUERY_ROWS = 2048, 64, 16_384, 512
NEIGHBOURS, HIDDEN, EPOCHS, SLACK = 10, 96, 40, 1.1
#: Share of the neighbours of held-out sample vectors that routing must reach; it sets the probability mass probed.
TARGET = 0.97


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v): rows with an id and a vector whose components are all there and finite, not all zero. Exactly
    repeated rows count once; other rows with the same id all take part. Missing components (unequal lengths) count as 0."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(fine).distinct()


def matrix(column, dims: int | None = None) -> np.ndarray:
    """An Arrow column of lists as rows, cut or padded with 0 to dims, each divided by the power of two at its largest
    magnitude, which changes no digit of a cosine."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), max(int(size.max(initial=0)), dims or 1)))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    top = np.abs(out).max(axis=1, keepdims=True)
    return np.ldexp(out, -np.frexp(top)[1])[:, : dims or out.shape[1]]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The product of each row of x with that of y (or with y alone), summed in the order of the components, so that equal
    vectors have equal products whatever block they stand in."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += x[:, i] * y[..., i]
    return total


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest other rows of each row of unit vectors."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -2
        out[i : i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else out[i : i + 1024]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each row, each of at most SLACK times its share. Halves along the main direction give the start;
    rounds of moves then take each row to the part of most of its neighbours that has room, largest gains first."""
    part = np.zeros(len(x), dtype=np.int64)
    for level in range(parts.bit_length() - 1):
        nxt = np.zeros_like(part)
        for p in range(1 << level):
            own = np.flatnonzero(part == p)
            if len(own) > 1:
                y = x[own] - x[own].mean(axis=0)
                d = y[0]
                for _ in range(8):
                    d = y.T @ (y @ d)
                    d = d / max(np.linalg.norm(d), 1e-300)
                order = np.argsort(y @ d, kind="stable")
                nxt[own[order[len(own) // 2 :]]] = 1
        part = part * 2 + nxt
    room = int(np.ceil(SLACK * len(x) / parts))
    size = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), dtype=np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """Broadcastable: a perceptron with one hidden layer, and the probability mass that a query's partitions must reach."""

    dims: int
    weights: list[np.ndarray]
    mass: float
    parts: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        z = np.maximum(x @ a + b, 0) @ c + d
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """For each row the most probable partitions, as many as it takes to reach the mass."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        reach = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        return [o[: min(self.parts, int(np.searchsorted(r, self.mass)) + 1)] for o, r in zip(order, reach, strict=True)]


def train(x: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, seed: int = 7) -> Router:
    """Fit the classifier to the parts of each row and of its neighbours (three quarters of the rows learn, by Adam),
    then set the mass by the rows held out."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(n), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    learn, held = (np.arange(n) % 4 != 0), (np.arange(n) % 4 == 0)
    own = np.flatnonzero(learn) if learn.any() else np.arange(n)
    w = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            g = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (g @ w[2].T) * (h > 0)
            t += 1
            for i, grad in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                grad = grad + (1e-4 * w[i] if i in (0, 2) else 0)
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                w[i] = w[i] - 0.004 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    router = Router(d, w, 1.0, parts)
    if held.any():
        p = router.probabilities(x)
        home = p.argmax(axis=1)
        q = np.flatnonzero(held)
        order = np.argsort(-p[q], axis=1, kind="stable")
        rank = np.argsort(order, axis=1)
        reach = np.cumsum(np.take_along_axis(p[q], order, axis=1), axis=1)
        before = reach - np.take_along_axis(p[q], order, axis=1)
        need = np.take_along_axis(before, np.take_along_axis(rank, home[graph[q]], axis=1), axis=1)
        router.mass = float(min(1.0, np.quantile(need, TARGET) + 1e-9))
    return router


def fit(vectors: DataFrame, count: int, sample: int = SAMPLE) -> Router:
    """The router, fitted on the driver on a bounded sample of the vectors (id, v)."""
    # Twice the sample by expectation passes the bound, so few rows meet in the task that ranks them.
    rows = vectors.where(F.xxhash64("id") <= hash_bound(2 * sample, count)).orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").toArrow()
    x = unit(matrix(rows.column("v")))
    parts = 1
    while parts < MOST_PARTITIONS and parts * PARTITION_ROWS < count and parts * 64 <= len(x):
        parts *= 2
    if parts == 1 or len(x) < 2:
        return Router(x.shape[1], [np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1.0, 1)
    graph = neighbour_graph(x)
    return train(x, graph, balanced_partition(x, graph, parts), parts)


ROUTED = "id long, v array<double>, part int"


def assign(vectors: DataFrame, router: Router, probe: bool) -> DataFrame:
    """(id, v, part): each row's most probable partition, or with `probe` each of those that a search visits."""
    bound = session_of(vectors).sparkContext.broadcast(router)

    def run(batches):
        r = bound.value
        for batch in batches:
            if batch.num_rows:
                x = unit(matrix(batch.column(1), r.dims))
                found = r.probes(x) if probe else [np.array([i]) for i in r.probabilities(x).argmax(axis=1)]
                take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(found), pa.int32())], ["id", "v", "part"])

    return arrow(vectors.select("id", "v"), run, ROUTED)


def packed(key: tuple, table: pa.Table) -> pa.Table:
    x = matrix(table.column("v"))
    ids = table.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "ids": [ids.tobytes()], "x": [x.tobytes()]})


PACKED = "part int, block long, ids binary, x binary"


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, sample: int = SAMPLE) -> DataFrame:
    """The nearest rows of `vectors` to each of `queries` (both (id, v): see usable) by cosine, in double precision, but
    for the query's own id: query_id, rank (from 1), vec_id, score. Ties go to the smaller vec_id.

    Approximate in that only the partitions that the router finds probable are searched; every row of those is scored
    exactly. Every row is indexed, in one partition. Fewer rows in the searched partitions give fewer results; no vectors
    or queries give none.
    """
    count = vectors.count()
    if not count:
        return vectors.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    router = fit(vectors, count, sample)
    rows, asked = assign(vectors, router, False), assign(queries, router, True)
    per_part = rows.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    blocked = rows.join(F.broadcast(per_part), "part").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("bigint")))
    index = blocked.groupBy("part", "block").applyInArrow(packed, PACKED)
    groups = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("groups"))
    grouped = asked.join(F.broadcast(groups), "part").withColumn("block", F.pmod(F.xxhash64("id"), F.col("groups").cast("bigint")))
    asking = grouped.groupBy("part", "block").applyInArrow(packed, PACKED).join(F.broadcast(per_part), "part").select("part", F.col("ids").alias("query_ids"), F.col("x").alias("queries"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qi, ri = np.frombuffer(r["query_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
                q, x = np.frombuffer(r["queries"]).reshape(len(qi), -1), np.frombuffer(r["x"]).reshape(len(ri), -1)
                d = min(q.shape[1], x.shape[1])
                norm = np.sqrt(dots(x, x))
                s = (q[:, :d] @ x[:, :d].T) / np.outer(np.sqrt(dots(q, q)), norm)
                s[qi[:, None] == ri[None, :]] = -np.inf
                out: tuple[list, list, list] = ([], [], [])
                for i in range(len(qi)):
                    floor = np.partition(s[i], len(ri) - k)[len(ri) - k] if len(ri) > k else -np.inf
                    # Matrix products differ in their last digits with the block's shape: what comes near is scored again.
                    near = np.flatnonzero((s[i] >= floor - 1e-9) & (s[i] > -np.inf))
                    score = dots(x[near, :d], q[i, :d]) / (np.sqrt(dots(q[i : i + 1], q[i : i + 1])) * norm[near])
                    best = np.lexsort((ri[near], -score))[:k]
                    out[0].extend([int(qi[i])] * len(best))
                    out[1].extend(ri[near[best]].tolist())
                    out[2].extend(score[best].tolist())
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    found = arrow(index.join(asking, ["part", "block"]), run, "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
