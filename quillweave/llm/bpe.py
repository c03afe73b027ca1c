"""Byte-level BPE encoding and decoding of whole texts, with tree concatenation for long unsplit text."""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import arrow, lean, pieces, range_hashes, text_column

#: Bytes of unsplit text that are encoded at once; longer text is halved.
LEAF = 4096
#: Entries of the cache of encoded words of a task.
CACHE = 200_000
#: Bytes of text that are encoded at once: some forty times as many are held meanwhile.
CHUNK = 1 << 18
OTHER, LETTER, NUMBER, SPACE, RARE = range(5)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one
    from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def classes() -> np.ndarray:
    """The class of each code point of the first plane that Unicode has had since 3.2; the others, on whose class
    libraries may differ, are RARE."""
    out = np.full(0x110000, RARE, dtype=np.uint8)
    kind = lambda c: LETTER if c[0] == "L" else NUMBER if c[0] == "N" else OTHER
    for i in range(0x10000):
        old, new = unicodedata.ucd_3_2_0.category(chr(i)), unicodedata.category(chr(i))
        if old not in ("Cn", "Cs") and kind(old) == kind(new):
            out[i] = kind(new)
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x3000]] = SPACE
    out[0x180E] = RARE
    return out


def word_starts(points: np.ndarray, kind: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer's pieces start. Pieces are runs of letters, numbers or other signs, each with one blank
    before it; the endings 's 't 're 've 'm 'll 'd; and white space, whose last sign stands apart before other text.
    rows: where rows start (empty rows left out)."""
    first = np.zeros(len(points) + 1, dtype=bool)
    first[rows] = True
    run = first[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    run[:1] = True
    starts = run.copy()
    after = np.flatnonzero(run & (kind != SPACE) & ~first[:-1])
    after = after[after > 0]
    after = after[kind[after - 1] == SPACE]
    starts[after - 1] = True
    starts[after] = points[after - 1] != 0x20
    quotes = np.flatnonzero((points == 0x27) & starts)
    if len(quotes):
        ahead = np.concatenate([points, np.zeros(3, points.dtype)])
        bar = np.concatenate([first[:-1], np.ones(4, bool)])
        one, two = np.where(bar[quotes + 1], 0, ahead[quotes + 1]), np.where(bar[quotes + 1] | bar[quotes + 2], 0, ahead[quotes + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        hit = quotes[short | long]
        starts[hit + 1] = False
        end = hit + np.where(short, 2, 3)[short | long]
        end = end[end < len(points)]
        starts[end[kind[end] == LETTER]] = True
    return np.flatnonzero(starts)


class Codec:
    """Ids as the library of the vocabulary file gives them, many texts at a time."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("the vocabulary must be byte-level BPE without normaliser and prefix space")
        letters = byte_letters()
        self.path = path
        self.cutter = Tokenizer.from_file(path).pre_tokenizer  # a worker keeps that, not the library's own vocabulary
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special tokens must be plain strings")
        self.added = added
        self.marks = "(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")"
        self.plain = {ord(c): b for c, b in letters.items()}
        self.bytes = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token) if token not in added else token.encode()
        for token, i in added.items():
            self.bytes[i] = token.encode()
        ranks = {self.bytes[i]: i for token, i in vocab.items() if token not in added}
        self.core = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.token_at = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes])])
        self.token_bytes = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.clear()

    @functools.cached_property
    def library(self):
        """The library's own encoder, for comparisons."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.table = np.zeros(1 << 12, dtype=np.int64)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)

    def learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """Put the ids of new words at the end of the tables; slot i's are flat[table[i] : table[i + 1]]."""
        n = len(self.slot)
        ids = [self.whole(w) for w in words]
        ends = self.table[n] + np.cumsum([len(x) for x in ids])
        while len(self.table) <= n + len(ids):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[n + 1 : n + 1 + len(ids)] = ends
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.table[n] : ends[-1]] = [i for x in ids for i in x]
        self.slot.update(zip(keys.tolist(), range(n, n + len(ids)), strict=True))

    def bpe(self, data: bytes) -> list[int]:
        return self.core._encode_single_piece(data)

    def whole(self, data: bytes, leaf: int = LEAF) -> list[int]:
        """One piece of text, however long: its leaves in parallel, then joined in pairs up the tree."""
        if len(data) <= leaf:
            return self.bpe(data)
        parts = [data]
        while len(parts[0]) > leaf:
            parts = [half for p in parts for half in (p[: len(p) // 2], p[len(p) // 2 :])]
        with ThreadPoolExecutor(2) as pool:
            done = list(pool.map(self.bpe, parts))
        while len(done) > 1:
            done = [self.join(done[i], done[i + 1]) for i in range(0, len(done), 2)]
        return done[0]

    def join(self, left: list[int], right: list[int], window: int = 4) -> list[int]:
        """The ids of both texts as one: a window around the seam is encoded anew and grows until it agrees with what
        stays on either side, which is so when the two ids at each edge, encoded together, come out as they are."""
        while True:
            a, b = left[:-window], right[window:]
            middle = self.bpe(b"".join(self.bytes[i] for i in left[-window:] + right[:window]))
            holds = lambda x, y: self.bpe(self.bytes[x] + self.bytes[y]) == [x, y]
            if (not a or not middle or holds(a[-1], middle[0])) and (not b or not middle or holds(middle[-1], b[0])):
                return a + middle + b
            window *= 2

    def cut(self, text: str) -> list[int]:
        """The ids of a text with special tokens or letters of unsure class: the library cuts it into words, whose ids are
        found like all others'."""
        out, known = [], {}
        for part in re.split(self.marks, text) if self.special else [text]:
            if part in self.added:
                out.append(self.added[part])
                continue
            for word, _ in self.cutter.pre_tokenize_str(part) if part else ():
                if word not in known:
                    known[word] = self.whole(word.translate(self.plain).encode("latin-1"))
                out += known[word]
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the n + 1 offsets of the rows in them."""
        n = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        try:
            text = raw.tobytes().decode()
        except UnicodeDecodeError:  # bytes that are no UTF-8 count as U+FFFD
            rows = [raw[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            raw, offsets = np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
            text = raw.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets] if len(points) < len(raw) else offsets
        kind = classes()[points]
        odd = np.unique(np.searchsorted(at, np.flatnonzero(kind == RARE), side="right") - 1).tolist()
        for s in self.special:
            i = text.find(s)
            while i >= 0:
                odd.append(int(np.searchsorted(at, i, side="right")) - 1)
                i = text.find(s, i + 1)
        starts = word_starts(points, kind, at[:-1][at[1:] > at[:-1]])
        ends = np.append(starts[1:], len(points))
        keys, index, inverse = np.unique(range_hashes(points, starts, ends), return_index=True, return_inverse=True)
        if len(self.slot) > CACHE:
            self.clear()
        slot = np.fromiter((self.slot.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(slot < 0)
        if len(new):
            self.learn(keys[new], [text[a:b].encode() for a, b in zip(starts[index[new]].tolist(), ends[index[new]].tolist(), strict=True)])
            slot[new] = np.arange(len(self.slot) - len(new), len(self.slot))
        table, slot = self.table, slot[inverse]
        count = table[slot + 1] - table[slot]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.arange(before[-1]) + np.repeat(table[slot] - before[:-1], count)]
        out = before[np.searchsorted(starts, at)]
        if odd:  # rows that the library cuts into words itself
            parts = np.split(ids, out[1:-1])
            for r in set(odd):
                parts[r] = np.array(self.cut(text[at[r] : at[r + 1]]), dtype=np.uint32)
            ids, out = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids.astype(np.uint32), out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        length = self.token_at[ids + np.uint32(1)] - self.token_at[ids]
        before = np.concatenate([[0], np.cumsum(length)])
        return self.token_bytes[np.arange(before[-1]) + np.repeat(self.token_at[ids] - before[:-1], length)]


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(batches, path: str):
    """(doc_ids, ids, offsets, codec) of each piece of the Arrow batches (doc_id, text). The words found are forgotten in the
    end, as the worker lives on."""
    lean()
    tool = codec(path)
    try:
        for part in pieces(batches, CHUNK):
            yield part.column(0), *tool.encode(*text_column(part.column(1))), tool
    finally:
        tool.clear()


def selected(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), one row per row of docs; a null or empty text has no ids."""

    def run(batches):
        for doc, ids, at, _ in encoded(batches, path):
            yield pa.RecordBatch.from_arrays([doc, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return arrow(selected(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(encodings: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text; null ids give an empty text, bytes that are no UTF-8 U+FFFD."""

    def run(batches):
        tool = codec(path)
        for batch in batches:
            texts = [tool.decode(np.array(x or [], dtype=np.uint32)).tobytes().decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return arrow(encodings.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row: encoded, then decoded, in one pass without shuffle.

    A null text is empty; a null id stays null; repeated rows give repeated results. Memory is bounded by the longest
    text, of which about forty bytes per letter are held.
    """

    def run(batches):
        for doc, ids, at, tool in encoded(batches, path):
            little = ids.astype("<u4")
            spans = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
            back = [tool.decode(ids[a:b]).tobytes().decode("utf-8", "replace").encode() for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(np.diff(at), pa.int64()), pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b in spans]), pa.array([hashlib.sha256(b).hexdigest() for b in back])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return arrow(selected(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
