"""Training by iterative parameter mixing: in each round every shard learns from its rows, starting from the same weights, and the
results are averaged. Weights have a fixed size; what a round moves is that size for each shard, summed in blocks by the cluster."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Weights in a block.
BLOCK = 1 << 15


def hashed(features: Iterable[str], size: int) -> list[int]:
    return [zlib.crc32(f.encode()) & size - 1 for f in features]


def sharded(examples: DataFrame, by: list[str], shards: int) -> DataFrame:
    """Examples dealt by the hash of columns and sorted by them within a shard, so that a training is the same each time."""
    return examples.repartition(shards, *by).sortWithinPartitions(*by).persist()


def mix(shards: DataFrame, learn: Callable[[list[pa.RecordBatch], np.ndarray], np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The mean of learn(rows, weights) over the shards that have rows; results may be longer than the weights, whose missing part
    counts as zero. Without rows it is the weights."""
    spark = shards.sparkSession
    bound = spark.sparkContext.broadcast(weights)

    def run(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        out = learn(rows, bound.value.copy())
        moved = out - np.concatenate([bound.value, np.zeros(len(out) - len(bound.value), bound.value.dtype)])
        shard = TaskContext.get().partitionId()
        blocks = [b for b in range(0, len(out), BLOCK) if b == 0 or moved[b : b + BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([shard] * len(blocks), pa.int32()), pa.array([len(out)] * len(blocks), pa.int64()), pa.array([moved[b : b + BLOCK].tobytes() for b in blocks], pa.binary())], ["at", "shard", "size", "moved"])

    kind = weights.dtype

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["shard"])  # sums of floats in one order
        total = np.sum([np.frombuffer(r["moved"], kind) for r in rows], axis=0, dtype=kind)
        return pa.table({"at": pa.array([rows[0]["at"]], pa.int64()), "size": pa.array([rows[0]["size"]], pa.int64()), "shards": pa.array([len(rows)], pa.int64()), "moved": pa.array([total.tobytes()], pa.binary())})

    found = shards.mapInArrow(run, "at long, shard int, size long, moved binary").groupBy("at").applyInArrow(add, "at long, size long, shards long, moved binary").toArrow().to_pylist()
    bound.destroy()
    if not found:
        return weights
    n = next(r["shards"] for r in found if r["at"] == 0)  # every shard sends its first block
    out = np.concatenate([weights, np.zeros(found[0]["size"] - len(weights), kind)])
    for r in found:
        part = np.frombuffer(r["moved"], kind)
        out[r["at"] : r["at"] + len(part)] += part / n
    return out


def save(spark: SparkSession, path: str, kind: str, weights: np.ndarray) -> None:
    """Weights that are not zero, as Parquet; replaces what is there."""
    at = np.flatnonzero(weights)
    table = pa.table({"at": pa.array(at, pa.int64()), "weight": pa.array(weights[at].astype(np.float64))})
    rows = spark.createDataFrame(table) if len(at) else spark.createDataFrame([], "at long, weight double")
    rows.select(F.lit(kind).alias("kind"), F.lit(len(weights)).alias("size"), "at", "weight").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, kind: str, size: int) -> np.ndarray:
    """Weights that were saved; FileNotFoundError if there are none of that kind and size."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        raise FileNotFoundError(f"no {kind} at {path}; train one first")
    table = spark.read.parquet(path).where((F.col("kind") == kind) & (F.col("size") == size)).select("at", "weight").toArrow()
    if not table.num_rows:
        raise FileNotFoundError(f"what is at {path} is no {kind} of this version")
    out = np.zeros(size, dtype=np.float32)
    out[table.column("at").to_numpy()] = table.column("weight").to_numpy()
    return out
