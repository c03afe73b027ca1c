"""Helpers shared by the operators: table reads, shared-folder tables, vectorised words and hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """The named columns of a table, and only those."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where the session names none, a temporary one if driver
    and executors are one process; on a cluster that is an error, as no machine-local folder would do."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = getattr(spark, "_quillweave_dir", None)
        if conf is None:
            conf = spark._quillweave_dir = "file://" + tempfile.mkdtemp(prefix="quillweave-")
    return conf.rstrip("/")


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs one stage and lineage stays short."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[len(self.paths)] = path
        out._quillweave_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in dfs:
            path = jvm.org.apache.hadoop.fs.Path(df._quillweave_path)
            path.getFileSystem(conf).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has."""
    taken = {c.lower() for c in df.columns}
    return [next(n for i in range(len(taken) + 1) if (n := f"{'_' * (i + 1)}{name}") not in taken) for name in names]


#: Arrow batches between the engine and Python: bytes at most, where the session doesn't say (its own default is 64 MB).
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow in small batches; a worker gives its free memory back after each task, as it lives on between tasks."""
    spark = session_of(df)
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    return df.mapInArrow(tidy(run), schema)


def tidy(run: Callable) -> Callable:
    def ran(batches):
        import pyarrow as pa

        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            POWERS.clear()
            trim()

    return ran


def trim() -> None:
    """Free pages go back to the system, where the C library can say so."""
    import ctypes

    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


#: Bytes from which on memory goes back to the system as soon as it is freed, see `lean`.
FREED = 1 << 19


def lean() -> None:
    """From now on this worker gives back large arrays when they are freed, where the C library can be told so; by itself
    it comes to keep up to 32 MB of each for later ones."""
    import ctypes

    try:
        ctypes.CDLL(None).mallopt(-3, FREED)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):
        pass


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def hash_bound(wanted: int, rows: int) -> int:
    """About `wanted` of so many rows have an xxhash64 up to this."""
    return min((1 << 63) - 1, -(1 << 63) + wanted * (1 << 64) // max(1, rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds) of an array of uint64."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> U64(33))
        x = x * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.inverse = U64(pow(int(_BASE), -1, 1 << 64))
        self.clear()

    def clear(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n + n // 8, 4096)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, _BASE)]))
                self.down = np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, self.inverse)]))


POWERS = _Powers()


def range_hashes(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of units[start:end] for each range: differences of one rolling sum, so no loop over ranges."""
    POWERS.to(len(units) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(units) + 1, dtype=U64)
        space = np.empty(min(len(units), 1 << 14), dtype=U64)  # short runs need no arrays of the text's length in between
        for i in range(0, len(units), 1 << 14):
            run = space[: len(units) - i]
            run[:] = units[i : i + (1 << 14)]
            run += U64(1)
            run *= POWERS.up[i : i + len(run)]
            run[0] += total[i]
            np.cumsum(run, out=total[i + 1 : i + 1 + len(run)])
        return mix(((total[end] - total[start]) * POWERS.down[start]) ^ ((end - start).astype(U64) << U64(48)))


#: Bits of a map of wanted rows. It has a fixed size; with many rows it lets more others through, never fewer of its own.
WANTED = 1 << 24


def slots(*keys: np.ndarray) -> np.ndarray:
    """The bit of each row with these int64 keys."""
    h = np.zeros(len(keys[0]), dtype=U64)
    for k in keys:
        h = mix(h + k.astype(np.int64).view(U64) + U64(1))
    return (h & U64(WANTED - 1)).astype(np.int64)


def wanted_rows(rows: DataFrame):
    """A broadcast map of the rows' (long) columns, to be asked by is_wanted before anything is shuffled."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(slots(*(c.to_numpy() for c in batch.columns))), pa.int32())], ["slot"])

    bits = np.zeros(WANTED, dtype=bool)
    bits[arrow(rows, run, "slot int").distinct().toArrow().column(0).to_numpy()] = True
    return session_of(rows).sparkContext.broadcast(np.packbits(bits))


def is_wanted(bits: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    slot = slots(*keys)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, byte by byte."""
    return raw + ((raw - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def text_column(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the n + 1 offsets of its rows; null is empty. Copies nothing but nulls."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(at) and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


NOT_WHITE = ~_WHITE
#: Digits, ASCII letters and all bytes of letters beyond ASCII.
ALNUM = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


def words(raw: np.ndarray, offsets: np.ndarray, of: np.ndarray = NOT_WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (a run of the bytes that `of` marks; by default all but 0x20 and 0x09-0x0D) of
    the rows that offsets mark in raw."""
    solid = of.take(raw)
    first = solid.copy()
    np.greater(solid[1:], solid[:-1], out=first[1:])
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    first[inner] = solid[inner]
    last = solid.copy()
    np.greater(solid[:-1], solid[1:], out=last[:-1])
    last[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


#: Rows that a task holds before it passes them on, and how many groups they are dealt into by a key.
HELD, BUCKETS = 1_000_000, 1024


def bucketed(key: np.ndarray, *columns: np.ndarray, lists: tuple[np.ndarray, np.ndarray] | None = None):
    """One Arrow row for each bucket of the int64 keys that occurs: its number, and the bytes of each column. Numbers by the million
    so pass a shuffle as a few rows; unpacked() reads them in a group's function. lists: the lengths of a column of lists, and the numbers
    in them, which come last."""
    import pyarrow as pa

    bucket = (mix(key.view(U64)) >> U64(54)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    count = np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(count)
    binary = lambda n, c: pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer((np.concatenate([[0], np.cumsum(n)]) * c.itemsize).astype(np.int32)), pa.py_buffer(c)])
    packed = [binary(count[used], c.take(order)) for c in columns]
    if lists is not None:
        of = np.repeat(bucket, lists[0])
        packed.append(binary(np.bincount(of, minlength=BUCKETS)[used], lists[1].take(np.argsort(of, kind="stable"))))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *packed], ["bucket", *(f"c{i}" for i in range(len(packed)))])


def unpacked(table, *kinds: type) -> list[np.ndarray]:
    """The numbers of a group of bucketed()'s rows, column by column."""
    return [np.frombuffer(b"".join(table.column(f"c{i}").to_pylist()), dtype=k) for i, k in enumerate(kinds)]


def key_counts(docs: DataFrame, keys: Callable, text_at: int = 0, least: int = 1) -> DataFrame:
    """(w, c): how often each int64 key occurs that keys(raw, offsets) finds in the texts of a column, if `least` times or more.
    Summed in each task before they are shuffled."""
    import pyarrow as pa

    def merged(found, counts):
        k, inverse = np.unique(np.concatenate(found), return_inverse=True)
        return k, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)

    def run(batches):
        found, counts, held = [], [], 0
        for part in pieces(batches, 1 << 18):
            k, c = np.unique(keys(*text_column(part.column(text_at))), return_counts=True)
            found.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD:
                k, c = merged(found, counts)
                found, counts, held = [k], [c], len(k)
                if held > HELD // 2:
                    yield bucketed(k, k, c)
                    found, counts, held = [], [], 0
        if found:
            k, c = merged(found, counts)
            yield bucketed(k, k, c)

    def summed(table):
        k, c = merged(*([x] for x in unpacked(table, np.int64, np.int64)))
        keep = c >= least
        return pa.table({"w": k[keep], "c": c[keep]})

    return arrow(docs, run, "bucket int, c0 binary, c1 binary").groupBy("bucket").applyInArrow(summed, "w long, c long")


def overlaps(row: np.ndarray, column: np.ndarray, rows: int, left: np.ndarray, right: np.ndarray, step: int = 512) -> np.ndarray:
    """How many columns each row of `left` shares with each of `right`, from the (row, column) places of ones. Products of
    dense strips of `step` columns, so memory doesn't grow with the number of columns; strips take less than the result."""
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        i, j = np.searchsorted(column, (at, at + step))
        strip = np.zeros((rows, step), dtype=np.float32)
        strip[row[i:j], column[i:j] - at] = 1
        out += strip[left] @ strip[right].T
    return out


def pieces(batches, limit: int = 4 << 20, rows: int = 1 << 20, text_at: int | str = "text"):
    """Arrow batches cut into runs of about `limit` bytes of text (the column of that place or name) and at most `rows` rows, so that memory
    is bounded by the longest text, not by the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_column(batch.column(text_at))
        i = 0
        while i < batch.num_rows:
            j = min(i + rows, max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1))
            yield batch.slice(i, j - i)
            i = j
