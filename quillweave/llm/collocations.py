"""Phrase collocations: candidates whose sketched count may reach the threshold become delimiter-guarded automata, which count
overlapping matches exactly, shard by shard; thresholds and scores follow from the sums."""

from __future__ import annotations

import itertools

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillweave.llm.common import BUCKETS, HELD, U64, Scratch, arrow, lower_bytes, mix, pieces, range_hashes, session_of, words

LEAST, LONGEST, TOP, COVER = 30, 4, 2000, 80
#: Counters of a level's sketch: about one for so many bytes of text, within these bounds (powers of two). What is broadcast is a bit for each,
#: so 32 MB a level at most. Beyond that size more candidates pass that the exact counts then drop: more work, the same rows.
BYTES_A_COUNTER, FEWEST, MOST = 16, 1 << 16, 1 << 28
#: Bytes of text that one automaton is made for, and read in.
SHARD = 2 << 20
#: Bytes of text that a task counts at least, if there are more such tasks than cores: partial sums of small tasks would repeat most phrases.
TASK = 64 << 20
#: A piece ends at any of these bytes; words are what blanks and tabs leave of it.
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SOLID = ~_BREAK
_SOLID[[0x20, 0x09]] = False


class Words:
    """The words of some texts of one language, in order."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.raw = lower_bytes(np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8))
        self.start, self.end, _ = words(self.raw, np.array([0, len(self.raw)]), _SOLID)
        broken = np.cumsum(_BREAK[self.raw], dtype=np.int32)
        # Whether the next word follows in the same piece.
        self.next = np.append(broken[self.start[1:]] == broken[self.end[:-1] - 1], False)[: len(self.start)]
        tag = np.frombuffer(lang.encode(), dtype=np.uint8)
        self.hash = range_hashes(self.raw, self.start, self.end) ^ range_hashes(tag, np.array([0]), np.array([len(tag)]))[0]

    def levels(self, maps: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For phrases of 1, 2, ... words: where one may be frequent, by the maps of the levels known so far and its own parts, and
        the hash of the phrase at each word. One level more than there are maps."""
        may, key, out = np.ones(len(self.start), dtype=bool), mix(self.hash), []
        for n in range(len(maps) + 1):
            if n:
                may = np.append(may[:-1] & may[1:], False)
                may &= self.next if n == 1 else True
                with np.errstate(over="ignore"):
                    key = mix(key * U64(3) + np.append(self.hash[n:], np.zeros(min(n, len(key)), U64)))
            if n < len(maps):
                at = np.flatnonzero(may)
                slot = (key[at] & U64(len(maps[n]) * 8 - 1)).astype(np.int64)
                may = np.zeros(len(may), dtype=bool)
                may[at] = maps[n][slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1
            out.append((may, key))
        return out

    def guarded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with a blank on each side, two where a piece ends, so that no pattern of words and single blanks matches across
        pieces or within words; and where each word starts and ends there."""
        raw, times = self.raw.copy(), np.zeros(len(self.raw), dtype=np.int8)
        edge = np.zeros(len(raw) + 1, dtype=np.int8)
        edge[self.start] = 1
        edge[self.end] -= 1
        times[:] = np.cumsum(edge[:-1], dtype=np.int8)
        times[self.end] = np.where(self.next, 1, 2)
        times[0] = 1
        raw[self.end] = raw[0] = 0x20
        at = np.cumsum(times, dtype=np.int64)
        return np.repeat(raw, times), at[self.start] - 1, at[self.end - 1]


def _by_language(batches, work):
    """work(Words) for the texts of each language, as many at a time as fill a shard."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for part in pieces(batches, SHARD):
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
        if size >= SHARD:
            while held:
                yield from work(*held.popitem())
            size = 0
    while held:
        yield from work(*held.popitem())


def _sketch(docs: DataFrame, maps, width: int, least: int) -> np.ndarray:
    """A bit for each counter that phrases of one level more than there are maps bring to `least` or more: upper bounds, as phrases share counters. Counts are summed
    in each task, shuffled by ranges of counters, and added up row by row."""
    span = max(8, width // BUCKETS)

    def run(batches):
        found, counts, held = [], [], 0

        def merged():
            slot, inverse = np.unique(np.concatenate(found), return_inverse=True)
            return slot, np.minimum(np.bincount(inverse, weights=np.concatenate(counts)), least).astype(np.uint32)

        def rows(slot, count):
            cut = np.searchsorted(slot, np.arange(0, width + span, span))
            used = np.flatnonzero(cut[1:] > cut[:-1])
            column = lambda x: pa.array([x[cut[b] : cut[b + 1]].tobytes() for b in used], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), column(slot), column(count)], ["bucket", "slots", "counts"])

        def work(lang, texts):
            one = Words(lang, texts)
            if not len(one.start):
                return
            may, key = one.levels(maps.value)[-1]
            yield np.unique((key[may] & U64(width - 1)).astype(np.uint32), return_counts=True)

        for slot, count in _by_language(batches, work):
            found.append(slot)
            counts.append(count)
            held += len(slot)
            if held > HELD:
                one = merged()
                found, counts, held = [one[0]], [one[1]], len(one[0])
                if held > HELD // 2:
                    yield rows(*one)
                    found, counts, held = [], [], 0
        if found:
            yield rows(*merged())

    def add(batches):
        bucket, total = None, None
        for batch in batches:
            for b, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if bucket is not None:
                        yield done(bucket, total)
                    bucket, total = b, np.zeros(span, dtype=np.uint32)
                slot = np.frombuffer(slots, np.uint32) - np.uint32(b * span)
                total[slot] = np.minimum(total[slot] + np.frombuffer(counts, np.uint32), least)  # a row names a counter once
        if bucket is not None:
            yield done(bucket, total)

    def done(bucket, total):
        return pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "bits": [np.packbits(total >= least, bitorder="little").tobytes()]})

    partial = arrow(docs, run, "bucket int, slots binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    bits = np.zeros(width // 8, dtype=np.uint8)
    for row in arrow(partial, add, "bucket int, bits binary").toArrow().to_pylist():
        bits[row["bucket"] * span // 8 :][: span // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _count(docs: DataFrame, maps, longest: int) -> DataFrame:
    """(lang, size, phrase, c): exact counts of all candidates, summed in each task; size 0 counts all words."""

    def work(lang, texts):
        """Patterns of the candidates that occur here, and how often each does."""
        found = Words(lang, texts)
        yield lang, 0, "", len(found.start)
        if not len(found.start):
            return
        levels = found.levels(maps.value)
        text, start, end = found.guarded()
        known = _identities(text, start)
        identity, patterns = known, []
        for n, (may, _) in enumerate(levels[:longest]):
            at = np.flatnonzero(may)
            if n:
                # The pair of the phrase without its last word and that word identifies it.
                pair = identity[at] * (int(known.max()) + 1) + known[at + n]
                _, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
                identity = np.full(len(start), -1, dtype=np.int64)
                identity[at] = inverse
                patterns += [(n + 1, text[start[i] - 1 : end[i + n] + 1].tobytes().decode(errors="surrogateescape")) for i in at[first].tolist()]
            elif len(at):
                _, first, count = np.unique(known[at], return_index=True, return_counts=True)
                for i, c in zip(at[first].tolist(), count.tolist(), strict=True):
                    yield lang, 1, text[start[i] : end[i]].tobytes().decode(errors="surrogateescape"), c
        if patterns:
            machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, (_, phrase) in enumerate(patterns):
                machine.add_word(phrase, i)
            machine.make_automaton()
            hits = np.fromiter((i for _, i in machine.iter(text.tobytes().decode(errors="surrogateescape"))), dtype=np.int32)
            for (n, phrase), c in zip(patterns, np.bincount(hits, minlength=len(patterns)).tolist(), strict=True):
                yield lang, n, phrase[1:-1], c

    def run(batches):
        total: dict[tuple[str, int], dict[str, int]] = {}
        held = 0

        def rows():
            while total:
                (lang, n), counts = total.popitem()
                for some in itertools.batched(counts.items(), 1 << 16):
                    phrase, c = zip(*some, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array([n] * len(c), pa.int32()), pa.array(phrase), pa.array(c, pa.int64())], ["lang", "size", "phrase", "c"])

        for lang, n, phrase, c in _by_language(batches, work):
            counts = total.setdefault((lang, n), {})
            if phrase not in counts:
                held += 1
            counts[phrase] = counts.get(phrase, 0) + c
            if held >= HELD:
                yield from rows()
                held = 0
        yield from rows()

    return arrow(docs, run, "lang string, size int, phrase string, c long").groupBy("lang", "size", "phrase").agg(F.sum("c").alias("c"))


def _identities(text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words only: they are compared as they are spelled, not by a hash."""
    # What follows a word up to the next one is blanks.
    offsets = pa.py_buffer(np.append(start, len(text)).astype(np.int64))
    spelled = pa.Array.from_buffers(pa.large_string(), len(start), [None, offsets, pa.py_buffer(text)])
    return pc.dictionary_encode(pc.ascii_rtrim(spelled, " ")).indices.to_numpy().astype(np.int64)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """Per language, the `top` phrases of 2 to `longest` words by score: lang, rank, phrase, a, l, r, n, score.

    A-Z become lower case; `.,;:!?` and line ends part pieces, blanks and tabs part words. Phrases that occur `least` times or more (a) are
    candidates; the cut in two with the least score floor(2000000 * a / (l + r)) counts, ties to the shorter first part. A candidate whose
    words lie in a longer candidate that has `cover` percent of its occurrences goes. Ties of the score go to the larger a, then to the smaller
    phrase in byte order. A null text is empty, a null language is `und`; repeated rows count each time; other columns are not
    read; a table without rows, or without candidates, gives none. Texts are read whole, memory is bounded by the longest text.
    """
    spark = session_of(docs)
    scratch = Scratch(spark, "collocations")
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = 1 << min(max(FEWEST.bit_length() - 1, (size // BYTES_A_COUNTER).bit_length()), MOST.bit_length() - 1)
    maps: list[np.ndarray] = []
    known = spark.sparkContext.broadcast(maps)
    for _ in range(longest):
        maps = [*maps, _sketch(docs, known, width, least)]
        known.destroy()
        known = spark.sparkContext.broadcast(maps)
    counts = scratch.keep(_count(docs.coalesce(max(spark.sparkContext.defaultParallelism, size // TASK)), known, longest))
    known.destroy()
    word = F.split("phrase", " ")
    found = counts.where((F.col("size") >= 2) & (F.col("c") >= least)).select("lang", "phrase", "size", F.col("c").alias("a"), word.alias("w"))
    join = lambda at, n: F.array_join(F.slice("w", at, n), " ")
    parts = counts.where(F.col("size") >= 1).select("lang", "phrase", "c")
    side = lambda name, c: parts.select("lang", F.col("phrase").alias(name), F.col("c").alias(c))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("first"), join(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    score = F.expr("cast(a as decimal(20, 0)) * 2000000 div (cast(l as decimal(20, 0)) + r)")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))
    inner = found.where(F.col("size") > 2).select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n"))
    inner = inner.select("lang", "a", "w", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("at"))
    longer = inner.groupBy("lang", join(F.col("at"), F.col("n")).alias("phrase")).agg(F.max("a").alias("within"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(F.col("within").isNull() | (F.col("within").cast("decimal(20, 0)") * 100 < F.col("a").cast("decimal(20, 0)") * cover))
    order = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), "phrase")
    best = left.select("lang", F.row_number().over(order).alias("rank"), "phrase", "a", "s.l", "s.r", "s.score").where(F.col("rank") <= top)
    n = counts.where(F.col("size") == 0).select("lang", F.col("c").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, top: int = TOP, cover: int = COVER) -> str:
    """The same rows in SQL, for phrases of 2 to 4 words, by counting every phrase."""
    return rf"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                        FROM documents),
             lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
             places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0),
             counted AS (SELECT lang, list_slice(w, i, i + s - 1) AS w, count(*) AS a
                         FROM places, (VALUES (1), (2), (3), (4)) sizes(s) WHERE i + s - 1 <= len(w) GROUP BY ALL),
             totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE len(w) = 1 GROUP BY lang),
             found AS (SELECT * FROM counted WHERE len(w) >= 2 AND a >= {least}),
             cuts AS (SELECT f.lang, f.w, f.a, k, l.a AS l, r.a AS r, (2000000 * CAST(f.a AS HUGEINT)) // (l.a + r.a) AS score
                      FROM (SELECT *, unnest(range(1, len(w))) AS k FROM found) f
                      JOIN counted l ON l.lang = f.lang AND l.w = list_slice(f.w, 1, k)
                      JOIN counted r ON r.lang = f.lang AND r.w = list_slice(f.w, k + 1, len(f.w))),
             scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
             starts AS (SELECT lang, w, a, unnest(range(1, len(w) + 1)) AS i FROM found WHERE len(w) > 2),
             longer AS (SELECT lang, list_slice(w, i, i + s - 1) AS w, max(a) AS within
                        FROM starts, (VALUES (2), (3)) sizes(s) WHERE s < len(w) AND i + s - 1 <= len(w) GROUP BY ALL),
             kept AS (SELECT s.lang, array_to_string(s.w, ' ') AS phrase, s.a, s.l, s.r, s.score
                      FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.w = s.w
                      WHERE o.within IS NULL OR 100 * CAST(o.within AS HUGEINT) < {cover} * s.a),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, CAST(r.score AS BIGINT) AS score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {top}"""
