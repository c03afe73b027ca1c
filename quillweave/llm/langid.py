"""Language identification by nearest centroid over TF-IDF letter n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillweave.llm.common import Scratch, arrow, hash_bound, lean, lower_bytes, pieces, session_of, text_column

UNKNOWN = "und"
#: Dimensions of the hashed n-grams (two and three bytes).
DIMS = 4096
#: Centroids of a language, and the most documents of a language that they are fitted on: the smallest by hash of the id.
CENTROIDS, SAMPLE = 4, 1500
ROUNDS = 8
#: A text is rejected if its best cosine is below this share of the lowest hundredth of that centroid's sample (of its
#: language's, if the centroid has fewer than ENOUGH rows or a tighter sample). A text of fewer n-grams than FULL shares
#: fewer with any centroid, so its bar is lower by the root of their number.
REJECT, ENOUGH, FULL = 0.6, 100, 400

#: Rows that are turned into vectors at once (4096 dimensions each), however short they are.
ROWS = 128
#: Bytes of text that are turned into vectors at once.
CHUNK = 1 << 18

_LETTER = np.array([i >= 128 or chr(i).isalpha() for i in range(256)])


def counts(raw: np.ndarray, offsets: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Rows x dims: how often each hashed n-gram of two and three bytes occurs in the row. Signs other than letters count
    as one blank each, and a blank stands before and after the row; n-grams of blanks alone don't count."""
    n = len(offsets) - 1
    low = lower_bytes(raw)
    low = np.where(_LETTER[low], low, 32).astype(np.uint32)
    size = np.diff(offsets)
    at = np.repeat(np.arange(n) * 2 + 1, size) + np.arange(len(low))
    padded = np.full(len(low) + 2 * n, 32, dtype=np.uint32)
    padded[at] = low
    row = np.repeat(np.arange(n), size + 2)
    out = np.zeros(n * dims, dtype=np.int64)
    for k in (2, 3):
        if len(padded) < k:
            continue
        code = padded[: len(padded) - k + 1].copy()
        for j in range(1, k):
            code = code * np.uint32(256) + padded[j : len(padded) - k + 1 + j]
        blank = np.uint32(sum(32 << 8 * j for j in range(k)))
        mine = (row[: len(code)] == row[k - 1 :]) & (code != blank)
        slot = (code[mine] * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(dims)
        out += np.bincount(row[: len(code)][mine] * dims + slot, minlength=n * dims)
    return out.reshape(n, dims)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """Broadcastable: the languages, their centroids (unit rows), the weight of each n-gram, the least cosine
    kept by each centroid."""

    langs: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def vectors(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.weighted(counts(raw, offsets))

    def weighted(self, found: np.ndarray) -> np.ndarray:
        return unit(np.log1p(found).astype(np.float32) * self.idf)

    def nearest(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language and cosine of each row's nearest centroid, and whether that is near enough; ties go to
        the language first by name."""
        found = counts(raw, offsets)
        cosine = self.weighted(found) @ self.centroids.T
        best = np.argmax(cosine, axis=1)
        score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0).astype(np.float64)
        return self.owner[best], score, score >= self.least[best] * np.sqrt(np.minimum(1.0, found.sum(axis=1) / FULL))


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; the first centre is the mean, each next the row farthest from those before."""
    centres = [unit(x.mean(axis=0, keepdims=True))[0]]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(np.argmin((x @ np.array(centres).T).max(axis=1)))])
    c = np.array(centres)
    for _ in range(rounds):
        mine = np.argmax(x @ c.T, axis=1)
        c = unit(np.array([x[mine == j].mean(axis=0) if (mine == j).any() else c[j] for j in range(len(c))]))
    return c


def bars(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The least cosine kept by each centroid. A row is compared with its own centroid as that would be without the row,
    so that few rows don't look nearer than new texts will be."""
    cosine = x @ c.T
    mine, every = np.argmax(cosine, axis=1), np.arange(len(x))
    total = np.array([x[mine == j].sum(axis=0) for j in range(len(c))])
    along = np.einsum("ij,ij->i", x, total[mine])
    rest = np.sqrt(np.maximum((total**2).sum(axis=1)[mine] - 2 * along + 1, 0))
    cosine[every, mine] = np.where(np.bincount(mine, minlength=len(c))[mine] > 1, (along - 1) / np.where(rest > 1e-3, rest, 1), 0)
    best = np.clip(cosine.max(axis=1), 0, 1)
    all_ = np.quantile(best, 0.01)
    own = [np.quantile(best[mine == j], 0.01) if (mine == j).sum() >= ENOUGH else all_ for j in range(len(c))]
    return REJECT * np.minimum(own, all_)


def fit(train: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learn from (id, text, lang) rows with text and lang. Of each language at most `sample` rows count, those whose
    ids hash lowest (their ids are broadcast, so no text but theirs is shuffled; of rows of one id the first by text counts).
    The rest of the fit is on the executors, one task a language, and only centroids reach the driver.
    Without rows the model knows no language and calls every text unknown."""
    spark = session_of(train)
    scratch = Scratch(spark, "langid")
    usable = train.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "id", F.xxhash64("id").alias("h"))
    size = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # Twice the sample by expectation lies below this bound; so only a few rows a language are ranked, by their ids alone.
    bound = F.create_map(*(F.lit(x) for lang, n in size.items() for x in (lang, hash_bound(2 * sample, n)))) if size else F.create_map().cast("map<string,bigint>")
    low = usable.where(F.col("h") <= F.element_at(bound, F.col("lang"))).groupBy("lang", "id").agg(F.first("h").alias("h"))
    chosen = low.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("h", "id"))).where(F.col("n") <= sample).select("lang", "id")
    rows = train.join(F.broadcast(chosen), ["lang", "id"]).where(F.col("text").rlike(r"\p{L}"))
    rows = scratch.keep(rows.groupBy("lang", "id").agg(F.min("text").alias("text")).select("lang", "text"))

    def frequencies(batches):
        lean()
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for part in pieces(batches, CHUNK, ROWS):
            c = counts(*text_column(part.column(1)))
            total, n = total + (c > 0).sum(axis=0), n + len(c)
        yield pa.RecordBatch.from_pydict({"n": [n], "df": [total.tobytes()]})

    seen = arrow(rows, frequencies, "n long, df binary").collect()
    total, n = sum((np.frombuffer(r["df"], dtype=np.int64) for r in seen), np.zeros(DIMS, dtype=np.int64)), sum(r["n"] for r in seen)
    idf = np.log((1 + n) / (1 + total)).astype(np.float32) + np.float32(1)
    base = Model([], np.zeros(0, np.int64), np.zeros((0, DIMS), np.float32), idf, np.zeros(0))

    def centres(key, table):
        lean()
        x = np.concatenate([base.vectors(*text_column(p.column(1))) for p in pieces(table.to_batches(), CHUNK, ROWS)])
        c = cluster(x, centroids)
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "centroids": [c.astype(np.float32).tobytes()], "least": [bars(x, c).astype(np.float64).tobytes()]})

    found = sorted(rows.groupBy("lang").applyInArrow(centres, "lang string, centroids binary, least binary").collect(), key=lambda r: r["lang"])
    scratch.drop(rows)
    blocks = [np.frombuffer(r["centroids"], dtype=np.float32).reshape(-1, DIMS) for r in found]
    owner = np.concatenate([np.full(len(b), i) for i, b in enumerate(blocks)]) if blocks else base.owner
    return Model([r["lang"] for r in found], owner.astype(np.int64), np.concatenate([base.centroids, *blocks]), idf, np.concatenate([base.least, *(np.frombuffer(r["least"]) for r in found)]))


FOUND = ("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Per row: id, lang_pred, score (cosine of the nearest centroid) and rejected (less near than the nearest centroid asks
    of a text of that length). With `carry` the row's own columns stand in place of id, but for those named as the results.

    A null text, or one without a letter, is `und` with score 0 and rejected. A null id stays null, repeated rows give
    repeated results; very long texts are read whole, in constant memory but for their letters.
    """
    bound = session_of(docs).sparkContext.broadcast(model)
    names = [c for c in docs.columns if c.lower() not in dict(FOUND)] if carry else ["id"]
    text = F.col(text_col).cast("string")
    own = [(text if c == text_col else F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)] if carry else [F.col(id_col).cast("long").alias("c0")]
    if text_col not in names or not carry:
        own.append(text.alias("text"))
    df = docs.select(*own, F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    at = names.index(text_col) if carry and text_col in names else len(names)

    def run(batches):
        lean()
        m = bound.value
        for part in pieces(batches, CHUNK, ROWS, at):
            letters = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool) & bool(m.langs)
            if m.langs:
                lang, score, near = m.nearest(*text_column(part.column(at)))
            else:
                lang, score, near = np.zeros(len(letters), np.int64), np.zeros(len(letters)), letters
            found = [m.langs[i] if ok else UNKNOWN for i, ok in zip(lang, letters, strict=True)]
            score = np.where(letters, score, 0.0)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(found, pa.string()), pa.array(score), pa.array(~(letters & near))], [*(f"c{i}" for i in range(len(names))), *dict(FOUND)])

    kinds = ", ".join(f"c{i} {df.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names)))
    return arrow(df, run, f"{kinds}, " + ", ".join(f"{n} {t}" for n, t in FOUND)).toDF(*names, *dict(FOUND))
