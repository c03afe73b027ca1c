"""Dictionary tagging with a whole vocabulary.

A name is found by its key (functions.keys): the words of a run of tokens, in any order and spelling that the key leaves open. The hashes of a
run's words are summed, so one pass over prefix sums finds the key of every run of every length in flat sorted arrays, and what
is found is compared with the key as it is spelled. Those arrays are broadcast if the vocabulary's size allows it; else the
runs that a bit map lets through are joined with the vocabulary by key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions import spans as SP
from quillweave.functions.keys import LEAST_PLURAL, spelled
from quillweave.operators.linking import lexicon_index

#: The most keys that are broadcast, about 40 bytes each.
MOST = 1 << 21
#: Bits of the map that runs pass before they are joined with a larger vocabulary.
BITS = 1 << 26
TOKEN = re.compile(r"[\w\u0300-\u036f]+")
#: What may stand between the tokens of a name.
GAP = re.compile(r"[\s'\u2019`/.\-\u2010-\u2015]*")
_POSSESSIVE = "'’`"
_U64 = np.uint64


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def _mixed(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = total + count.astype(_U64) * _U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U64(31))) * _U64(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U64(29))


def key_hash(keys: list[str]) -> np.ndarray:
    """A hash of each key that doesn't depend on the order of its words."""
    words = [k.split() for k in keys]
    total = np.array([sum(map(_word_hash, w)) & (1 << 64) - 1 for w in words], dtype=_U64)
    return _mixed(total, np.array([len(w) for w in words], dtype=np.int64))


def singular_word(word: str) -> str:
    """functions.keys.singular of one word."""
    if len(word) < LEAST_PLURAL:
        return word
    return word[:-3] + "y" if word.endswith("ies") else word[:-1] if word.endswith("s") and not word.endswith("ss") else word


class _Runs:
    """All runs of tokens of some texts, with the hashes of their keys as they are and of singular words."""

    def __init__(self, known: dict[str, tuple[int, int, int]]):
        self.known = known

    def _token(self, token: str) -> tuple[int, int, int]:
        found = self.known.get(token)
        if found is None:
            words = spelled(token).split()
            found = (len(words), sum(map(_word_hash, words)) & (1 << 64) - 1, sum(_word_hash(singular_word(w)) for w in words) & (1 << 64) - 1)
            if len(self.known) < 1 << 18:
                self.known[token] = found
        return found

    def of(self, texts: list[str], longest: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, start, end, hash, singular hash) of the runs of 1, 2, ... tokens with at most `longest` words; the first and last token
        has a word."""
        text, start, end, part, run, values = [], [], [], 0, [], []
        for i, t in enumerate(texts):
            last = None
            for m in TOKEN.finditer(t):
                if last is None or not GAP.fullmatch(t, last, m.start()):
                    part += 1
                last = m.end()
                text.append(i)
                start.append(m.start())
                end.append(last)
                run.append(part)
                values.append((0, 0, 0) if m[0] in ("s", "S") and m.start() and t[m.start() - 1] in _POSSESSIVE else self._token(m[0]))
            part += 1
        if not values:
            return
        text, start, end, run = (np.array(x, dtype=np.int64) for x in (text, start, end, run))
        count = np.array([v[0] for v in values], dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(count)])
        total, single = (np.concatenate([np.zeros(1, _U64), np.cumsum(np.array([v[k] for v in values], dtype=_U64))]) for k in (1, 2))
        at = np.flatnonzero(count)  # where a run may begin; those that may go on stay
        n = 1
        while len(at):
            words = upto[at + n] - upto[at]
            at, words = at[words <= longest], words[words <= longest]
            whole = count[at + n - 1] > 0
            i, w = at[whole], words[whole]
            with np.errstate(over="ignore"):
                yield text[i], start[i], end[i + n - 1], _mixed(total[i + n] - total[i], w), _mixed(single[i + n] - single[i], w)
            at = at[at + n < len(run)]
            at = at[run[at + n] == run[at]]
            n += 1


@dataclass
class Table:
    """Keys in flat arrays, by hash: where each one's spelling is, and its type."""

    hashes: np.ndarray
    offsets: np.ndarray
    spelling: bytes
    types: np.ndarray
    longest: int

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The first place of each hash, or -1."""
        at = np.searchsorted(self.hashes, hashes)
        found = at < len(self.hashes)
        found[found] = self.hashes[at[found]] == hashes[found]
        return np.where(found, at, -1)

    def type_of(self, at: int, key: bytes) -> int:
        """The type of a key, by its spelling, among those with its hash; -1 if it is none of them."""
        first = self.hashes[at]
        while at < len(self.hashes) and self.hashes[at] == first:
            if self.spelling[self.offsets[at] : self.offsets[at + 1]] == key:
                return int(self.types[at])
            at += 1
        return -1


def _longest_first(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    kept: list[tuple[int, int, int]] = []
    for s, e, kind in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
        if all(e <= a or b <= s for a, b, _ in kept):
            kept.append((s, e, kind))
    return sorted(kept)


def _spans(texts: list[str], table: Table, known: dict) -> list[list[dict]]:
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, start, end, plain, single in _Runs(known).of(texts, table.longest):
        one, two = table.find(plain), table.find(single)
        for j in np.flatnonzero((one >= 0) | (two >= 0)).tolist():
            words = spelled(texts[text[j]][start[j] : end[j]]).split()
            kind = -1
            if one[j] >= 0:
                kind = table.type_of(one[j], " ".join(words).encode())
            if kind < 0 and two[j] >= 0:
                kind = table.type_of(two[j], " ".join(sorted(map(singular_word, words))).encode())
            if kind >= 0:
                found[text[j]].append((int(start[j]), int(end[j]), kind))
    return [[{"start": s, "end": e, "label": S.ENTITY_TYPES[k], "text": t[s:e]} for s, e, k in _longest_first(f)] for t, f in zip(texts, found, strict=True)]


class Dictionary:
    """Tags the names of a vocabulary (schemas.LEXICON) in sentences.

    A run of tokens is a name if its key, or else that of its singular words, is a key of the vocabulary (as linking looks names up); of several
    types of a key the first of schemas.ENTITY_TYPES counts. Longer names go first, then earlier ones; names don't overlap.
    Null texts have none; other types are left out.
    """

    def __init__(self, lexicon: DataFrame, most: int = MOST):
        self.spark = lexicon.sparkSession
        known = F.array_position(F.array(*map(F.lit, S.ENTITY_TYPES)), F.col("type"))
        keys = lexicon_index(lexicon).where(F.col("type").isin(*S.ENTITY_TYPES)).groupBy("key").agg((F.min(known) - 1).cast("int").alias("kind"))
        self.keys = keys.persist()
        words = F.size(F.split("key", " "))
        self.n_keys, longest = self.keys.agg(F.count("*"), F.max(words)).first()
        self.longest, self.broadcast = longest or 0, self.n_keys <= most
        if self.broadcast:
            self.table = self.spark.sparkContext.broadcast(self._table())

    def _table(self) -> Table:
        def run(batches):
            for batch in batches:
                keys = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(key_hash(keys).view(np.int64)), batch.column(0), batch.column(1)], ["h", "key", "kind"])

        rows = self.keys.mapInArrow(run, "h long, key string, kind int").toArrow()
        hashes = rows.column("h").to_numpy().view(_U64)
        order = np.argsort(hashes, kind="stable")
        spelling = [k.encode() for k in rows.column("key").take(pa.array(order)).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in spelling], dtype=np.int64)]).astype(np.int64)
        return Table(hashes[order], offsets, b"".join(spelling), rows.column("kind").to_numpy()[order].astype(np.int8), self.longest)

    def __call__(self, text: Column) -> Column:
        """The spans of a text, for a vocabulary that is broadcast."""
        if not self.broadcast:
            raise ValueError("the vocabulary is too large for a column; use tag()")
        table = self.table

        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known: dict = {}
            for texts in parts:
                yield pd.Series(_spans(texts.fillna("").tolist(), table.value, known), index=texts.index)

        return F.pandas_udf(run, S.SPANS)(text)

    def tag(self, sentences: DataFrame) -> DataFrame:
        """sentences (pmid, index, text, ...) with `spans`; pmid and index tell a sentence apart where the vocabulary is joined."""
        if self.broadcast:
            return sentences.withColumn("spans", self(F.col("text")))
        hits = self._runs(sentences).join(self.keys.withColumnRenamed("kind", "_kind"), "key")
        one = hits.groupBy("pmid", "index", "start", "end").agg(F.min_by("_kind", "rank").alias("kind"), F.first("surface").alias("text"))
        names = F.array(*map(F.lit, S.ENTITY_TYPES))
        span = F.struct("start", "end", F.get(names, F.col("kind")).alias("label"), "text")
        spans = one.groupBy("pmid", "index").agg(F.array_sort(F.collect_list(span)).alias("_spans"))
        joined = sentences.join(spans, ["pmid", "index"], "left")
        return joined.withColumn("spans", SP.remove_overlaps(F.coalesce("_spans", F.array().cast(S.SPANS)))).select(*sentences.columns, "spans")

    def _runs(self, sentences: DataFrame) -> DataFrame:
        """(pmid, index, start, end, surface, rank, key) of runs whose hash the vocabulary's bit map has."""
        longest = self.longest

        def hashed(batches):
            for batch in batches:
                slots = np.unique((key_hash(batch.column(0).to_pylist()) & _U64(BITS - 1)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(slots)], ["slot"])

        bits = np.zeros(BITS, dtype=bool)
        bits[self.keys.select("key").mapInArrow(hashed, "slot long").distinct().toArrow().column(0).to_numpy()] = True
        bound = self.spark.sparkContext.broadcast(np.packbits(bits))

        def run(batches):
            known: dict = {}
            for batch in batches:
                pmid, index, texts = (batch.column(c).to_pylist() for c in range(3))
                texts, out = [t or "" for t in texts], []
                for text, start, end, *hashes in _Runs(known).of(texts, longest):
                    slot = [(h & _U64(BITS - 1)).astype(np.int64) for h in hashes]
                    may = [bound.value[s >> 3] >> (7 - (s & 7)).astype(np.uint8) & 1 == 1 for s in slot]
                    for j in np.flatnonzero(may[0] | may[1]).tolist():
                        i, s, e = int(text[j]), int(start[j]), int(end[j])
                        words = spelled(texts[i][s:e]).split()
                        keys = (" ".join(words), " ".join(sorted(map(singular_word, words))))
                        out += [(pmid[i], index[i], s, e, texts[i][s:e], k, keys[k]) for k in range(1 if keys[0] == keys[1] else 2)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string()), strict=True)], ["pmid", "index", "start", "end", "surface", "rank", "key"])

        return sentences.select(F.col("pmid").cast("string"), F.col("index").cast("int"), "text").mapInArrow(run, "pmid string, index int, start int, end int, surface string, rank int, key string")
