"""Vector bin packing of documents into training sequences, without a shuffle."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillweave.llm.bpe import encoded, selected
from quillweave.llm.common import arrow

#: Limits of a sequence: tokens, segments, loss-bearing tokens (those behind an example's prompt).
LIMITS = (1024, 64, 992)
#: Examples that are weighed against each other.
POOL = 1024
END = 0

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, loss_tokens long"


@dataclass
class Example:
    """Tokens from `start` on of a document; the first `prompt` of them bear no loss."""

    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int
    prompt: int = 1

    @property
    def loss(self) -> int:
        return max(0, len(self.ids) - self.prompt)

    def cut(self, n: int) -> tuple[Example, Example]:
        return Example(self.doc, self.start, self.ids[:n], self.doc_tokens, self.prompt), Example(self.doc, self.start + n, self.ids[n:], self.doc_tokens, max(0, self.prompt - n))


def power_below(n: int) -> int:
    return 1 << (n.bit_length() - 1)


class Packer:
    """Places examples into one sequence after another.

    Each step takes, of the pool's examples that fit all three limits, the one with the largest dot product of its
    demands and of what is left, both as shares of the limits. If none fits, or one segment is left, an example is cut: the
    smallest of those whose front fills the gap, else the one with the longest front that fits; its rest goes back. A
    sequence that can't be filled (too few tokens, segments or prompt tokens) is closed at the largest power of two, by
    cutting its last pieces, so no sequence is padded.
    """

    def __init__(self, limits: tuple[int, int, int] = LIMITS, cut: bool = True):
        self.limits, self.cut = limits, cut
        self.items: list[Example | None] = []
        self.free: list[int] = []
        self.size, self.prompt = np.zeros(64, dtype=np.int64), np.zeros(64, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.items) - len(self.free)

    def add(self, example: Example) -> None:
        if not self.cut and (len(example.ids) > self.limits[0] or example.loss > self.limits[2]):
            raise ValueError("an example that is not to be cut exceeds the limits of a sequence")
        if not self.free:
            self.free.append(len(self.items))
            self.items.append(None)
            if len(self.items) > len(self.size):
                self.size, self.prompt = (np.concatenate([x, np.zeros_like(x)]) for x in (self.size, self.prompt))
        self._put(self.free.pop(), example)

    def _put(self, k: int, example: Example) -> None:
        self.items[k] = example if len(example.ids) else None
        self.size[k], self.prompt[k] = len(example.ids), example.prompt
        if not len(example.ids):
            self.free.append(k)

    def choose(self, left: tuple[int, int, int]) -> tuple[int, int] | None:
        """(example, how much of it) to place next; None if nothing can be placed."""
        n = len(self.items)
        size, prompt = self.size[:n], self.prompt[:n]
        loss = np.maximum(size - prompt, 0)
        fits = (size > 0) & (size <= left[0]) & (loss <= left[2])
        if self.cut and left[1] == 1:
            fits &= size == left[0]
        if fits.any():
            share = [x / most for x, most in zip(left, self.limits, strict=True)]
            weight = size * (share[0] / self.limits[0]) + share[1] / self.limits[1] + loss * (share[2] / self.limits[2])
            k = int(np.argmax(np.where(fits, weight, -1.0)))
            return k, int(size[k])
        if not self.cut:
            return None
        front = np.minimum(size, np.minimum(left[0], left[2] + prompt))
        whole = np.flatnonzero((front == left[0]) & (size > 0))
        k = int(whole[np.argmin(size[whole])]) if len(whole) else int(np.argmax(front)) if n else 0
        return (k, int(front[k])) if n and front[k] > 0 else None

    def sequence(self, room: int) -> list[Example]:
        """Takes from the pool what fills a sequence of `room` tokens, as far as the limits allow."""
        left, placed = (room, self.limits[1], self.limits[2]), []
        while left[0] and left[1] and (found := self.choose(left)):
            k, n = found
            mine, rest = self.items[k].cut(n)
            placed.append(mine)
            self._put(k, rest)
            left = (left[0] - n, left[1] - 1, left[2] - mine.loss)
        total = sum(len(e.ids) for e in placed)
        if self.cut and 0 < total < self.limits[0]:
            spare = total - power_below(total)
            while spare:
                e = placed.pop()
                n = max(0, len(e.ids) - spare)
                mine, rest = e.cut(n)
                if n:
                    placed.append(mine)
                self.add(rest)
                spare -= len(rest.ids)
        return placed

    def drain(self, keep: int):
        """Sequences, until the pool holds no more than `keep` examples."""
        while len(self) > keep:
            yield self.sequence(self.limits[0])


def first_lines(ids: np.ndarray, at: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Tokens of each row up to its first token with a line break, that included; 0 for a row without one. breaks: whether
    each token has one."""
    where = np.flatnonzero(breaks[ids]) if len(ids) else np.zeros(0, np.int64)
    next_ = np.append(where, len(ids))[np.searchsorted(where, at[:-1])]
    return np.where(next_ < at[1:], next_ + 1 - at[:-1], 0)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limits: tuple[int, int, int] = LIMITS, pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    A document's ids end with id 0; an empty or null text is that id alone. Its first line is its prompt, which bears no
    loss, if other text follows in a line of its own; all else bears loss, so a sequence must hold some prompts: at most
    limits[2] of its tokens bear loss. Documents join a pool of `pool` examples, which are placed, whole or cut, by Packer.
    Every task packs what it reads, so nothing is shuffled, and a task that is run again gives the same sequences;
    sequence_id holds the task's number and the sequence's within it. Sequences hold the limit of tokens or a power of two. A
    null id stays null; repeated rows are packed apart, in the order in which they come; equally good examples go by place
    in the pool.
    """

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        packer, n, breaks = Packer(limits), 0, None
        names = [f.split()[0].strip("`") for f in SCHEMA.split(", ")]
        out: list[list] = [[] for _ in names]

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
            for c in out:
                c.clear()
            return made

        def rows(keep):
            nonlocal n
            for placed in packer.drain(keep):
                offset = 0
                for e in placed:
                    for column, v in zip(out, (e.doc, e.start, len(e.ids), zlib.crc32(e.ids), e.doc_tokens, base + n, offset, e.loss), strict=True):
                        column.append(v)
                    offset += len(e.ids)
                n += 1
                if len(out[0]) >= 8192:
                    yield batch()

        for docs_, ids, at, tool in encoded(batches, path):
            if breaks is None:
                breaks = np.array([b"\n" in b for b in tool.bytes])
            prompts = first_lines(ids, at, breaks)
            for doc, a, b, prompt in zip(docs_.to_pylist(), at[:-1].tolist(), at[1:].tolist(), prompts.tolist(), strict=True):
                own = np.append(ids[a:b], np.uint32(END)).astype("<u4")
                packer.add(Example(doc, 0, own, len(own), prompt))
                if len(packer) >= pool:
                    yield from rows(pool // 2)
        yield from rows(0)
        if out[0]:
            yield batch()

    return arrow(selected(docs, id_col, text_col), run, SCHEMA)
