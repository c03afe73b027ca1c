"""Line deduplication by an exact set-similarity join over the lines' words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillweave.functions.arrays import let
from quillweave.llm.common import U64, Scratch, arrow, bucketed, fresh, is_wanted, key_counts, lower_bytes, mix, overlaps, pieces, range_hashes, session_of, text_column, unpacked, wanted_rows, words

#: Lines match at 100 * shared words >= PERCENT * words of either. Lines of fewer than LEAST different words stay, unless
#: the caller asks for another least: with EVERY, as the query and the pipeline do, all lines with a word take part.
PERCENT, LEAST, EVERY = 90, 4, 1
#: A word that occurs more often than RARE has no list of its own, but lists with each later word of a prefix. At most
#: FREQUENT words are told apart so, the most frequent ones; their counts are broadcast (9 bytes each).
RARE, FREQUENT = 128, 1 << 22
#: A list of two words of more lines than LONG (as many as a rare word's list may hold) is compared in blocks of BLOCK x
#: BLOCK lines, of which BAND meet the others at a time: numbers of all their pairs take a hundred MB.
LONG, BLOCK, BAND = 128, 2048, 512
#: Postings of rare words that a task holds before it passes them on; pairs of them that are compared at once.
HELD, AT_ONCE = 1_000_000, 1 << 19
#: Bits of the signature that candidate pairs are filtered by before their words are joined.
WIDE_BITS = 256

LINES = "doc_id long, line_no long, n int, d1 long, d2 long, sig long, prefix array<long>"
#: The lines of rows that share an id are numbered apart by this much.
APART = 1 << 40


def line_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts and the end, document, number in it) of all lines, which end at byte 0x0A; every document has one."""
    breaks = np.flatnonzero(raw == 10)
    count = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.cumsum(count) - count
    starts = np.empty(int(count.sum()) + 1, dtype=np.int64)
    inner = np.ones(len(starts), dtype=bool)
    inner[first] = False
    inner[-1] = False
    starts[first], starts[inner], starts[-1] = offsets[:-1], breaks + 1, len(raw)
    return starts, np.repeat(np.arange(len(count)), count), np.arange(len(starts) - 1) - np.repeat(first, count)


def misses(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words of a line of n a match may lack: one that is as long or longer, and one that is as long or shorter."""
    return n + (-2 * percent * n // (100 + percent)), n + (-percent * n // 100)


def has_partners(n: np.ndarray, percent: int) -> np.ndarray:
    """Lines long enough to match others than equal ones."""
    return n * 100 >= percent * (n + 1)


class Order:
    """A total order of words, rare ones first: by the logarithm of their count if they are frequent, then by hash. A
    word is 63 bits of its hash and a last bit that says whether it is frequent."""

    def __init__(self, names: np.ndarray, counts: np.ndarray):
        order = np.argsort(names)
        self.names, self.level = names[order], np.minimum(255, np.log2(counts[order] + 1.0) * 6).astype(np.uint8)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(len(hashes), np.uint8)
        at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
        return np.where(self.names[at] == hashes, self.level[at], 0).astype(np.uint8)


def hashed(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = lower_bytes(raw)
    start, end, _ = words(low, offsets)
    return (range_hashes(low, start, end) & ~U64(1)).view(np.int64) if len(start) else np.zeros(0, np.int64)


def word_order(docs: DataFrame, scratch: Scratch):
    """The order, by exact counts of all words of all texts, and a broadcast map of the words that occur more than once (the
    lists of others hold one line). The driver gets the frequent words only, FREQUENT at most, and a map of fixed size."""
    several = scratch.keep(key_counts(docs.select("text"), hashed, least=2))
    shared, common = wanted_rows(several.select("w")), several.where(F.col("c") > RARE)
    by_level = {r["k"]: r["n"] for r in common.groupBy(F.floor(F.log2("c")).alias("k")).agg(F.count("*").alias("n")).collect()}
    least, n = max(by_level, default=0) + 1, 0
    for k in sorted(by_level, reverse=True):
        n += by_level[k]
        if n > FREQUENT:
            break
        least = k
    found = common.where(F.col("c") >= 2**least).toArrow()
    scratch.drop(several)
    return Order(*(found.column(c).to_numpy() for c in ("w", "c"))), shared


def line_sets(raw: np.ndarray, bounds: np.ndarray, order: Order) -> tuple[np.ndarray, np.ndarray]:
    """(line, word) of the lines' distinct words, each line's in order."""
    low = lower_bytes(raw)
    start, end, row = words(low, bounds)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    names, inverse = np.unique((range_hashes(low, start, end) & ~U64(1)).view(np.int64), return_inverse=True)
    level = order.levels(names)
    sort = np.argsort(level, kind="stable")
    rank = np.empty(len(sort), dtype=np.int64)
    rank[sort] = np.arange(len(sort))
    both = np.sort((row.astype(np.int64) << 32) | rank[inverse])
    both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both >> 32, (names | (level > 0))[sort][both & 0xFFFFFFFF]


def lines(docs: DataFrame, order: Order, percent: int, least: int) -> DataFrame:
    """A row for each line of at least `least` different words: digests of its set, a 64-bit signature, and the words that
    a match may lack, with two more. And one for each document, with line_no -1 - base, the number of its lines in n and its
    key in d1."""
    bound = session_of(docs).sparkContext.broadcast(order)
    names = [f.split()[0] for f in LINES.split(", ")]

    def run(batches):
        for part in pieces(batches, 1 << 20):
            raw, at = text_column(part.column(1))
            ids, base = part.column(0).to_numpy(zero_copy_only=False), part.column(2).to_numpy(zero_copy_only=False)
            bounds, doc, number = line_bounds(raw, at)
            row, word = line_sets(raw, bounds, bound.value)
            n = np.bincount(row, minlength=len(doc))
            first = np.concatenate([[0], np.cumsum(n)])
            use = np.flatnonzero(n >= least)
            plain = word.view(U64)
            with np.errstate(over="ignore"):
                digests = [np.concatenate([np.zeros(1, U64), np.cumsum(mix(plain ^ U64(salt)))]) for salt in (0x13579BDF, 0x2468ACE1)]
                digests = [(d[first[use + 1]] - d[first[use]]).view(np.int64) for d in digests]
            full = np.zeros(len(doc), dtype=U64)
            if len(word):
                full[n > 0] = np.bitwise_or.reduceat(U64(1) << (mix(plain) & U64(63)), first[:-1][n > 0])
            p = np.where((n >= least) & has_partners(n, percent), np.minimum(n, misses(n, percent)[1] + 2), 0)
            mine = np.arange(len(word)) - first[:-1][row] < p[row]
            offsets = np.concatenate([[0], np.cumsum(p[use])]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(word[mine]))
            yield pa.RecordBatch.from_arrays([pa.array(ids[doc[use]]), pa.array(base[doc[use]] + number[use]), pa.array(n[use], pa.int32()), *map(pa.array, digests), pa.array(full[use].view(np.int64)), prefix], names)
            none = np.zeros(len(ids), np.int64)
            empty = pa.ListArray.from_arrays(pa.array(np.zeros(len(ids) + 1, np.int32)), pa.array([], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(-1 - base), pa.array(np.bincount(doc, minlength=len(ids)), pa.int32()), part.column(3), pa.array(none), pa.array(none), empty], names)

    return arrow(docs, run, LINES)


CLASSES = "n int, d1 long, d2 long, d long, l long, sig long, lines long, prefix array<long>"


def classes_of(own: DataFrame) -> DataFrame:
    """A row for each different set of words: its digests, its first line (d, l), and how many lines have it. Lines are reduced to
    classes in each task before they are shuffled."""
    kinds = (np.int32, np.int64, np.int64, np.int64, np.int64, np.int64, np.int64, np.int32, np.int64)

    def reduced(n, d1, d2, d, line, sign, lines_, size, words_):
        order = np.lexsort((line, d, d2, d1, n))
        same = np.zeros(len(order), dtype=bool)
        same[1:] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (n, d1, d2)])
        first = np.flatnonzero(~same)
        f = order[first]
        start = (np.cumsum(size, dtype=np.int64) - size)[f]
        own_size = size[f].astype(np.int64)
        at = np.repeat(start - np.cumsum(own_size) + own_size, own_size) + np.arange(own_size.sum())
        return *(x[f] for x in (n, d1, d2, d, line, sign)), np.add.reduceat(lines_[order], first), size[f], words_[at]

    def dealt(held):
        *columns, words_ = reduced(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return bucketed(columns[1], *columns, lists=(columns[-1], words_))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(6)
            size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            d, line, count, d1, d2, sign = (batch.column(i).to_numpy() for i in range(6))
            held.append((count, d1, d2, d, line, sign, np.ones(len(d), np.int64), size, column.flatten().to_numpy()))
            n += len(d)
            if n > HELD // 5:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    def summed(table):
        *columns, size, words_ = reduced(*unpacked(table, *kinds))
        prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(words_))
        return pa.Table.from_arrays([*map(pa.array, columns), prefix], [f.split()[0] for f in CLASSES.split(", ")])

    rows = arrow(own.select("doc_id", "line_no", "n", "d1", "d2", "sig", "prefix"), run, "bucket int, " + ", ".join(f"c{i} binary" for i in range(len(kinds))))
    return rows.groupBy("bucket").applyInArrow(summed, CLASSES)


def placed(batch, percent: int) -> tuple[np.ndarray, ...]:
    """Of a batch of classes: the words of all prefixes, the line of each and its place in it, each line's number of them, and each
    word's line's misses()."""
    column = batch.column(4)
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    return flat, row, pos, size, *(m[row] for m in misses(batch.column(2).to_numpy().astype(np.int64), percent))


def single_pairs(classes: DataFrame, shared, percent: int) -> DataFrame:
    """(xd, xl, yd, yl) of lines that share the list of a rare word, as candidate_pairs() has them, maybe more than once. A line
    stands in the list of each rare word that a shorter or equal line may lack; only those that a longer or equal one may lack,
    which come first, make it a pair's shorter line."""

    def dealt(held):
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        return bucketed(columns[0], *columns)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            flat, row, pos, _, shorter, longer = placed(batch, percent)
            at = np.flatnonzero((flat & 1 == 0) & (pos <= longer))
            at = at[is_wanted(shared.value, flat[at])]
            d, line, size, sign = (batch.column(i).to_numpy()[row[at]] for i in range(4))
            # The place in the line, and in the last bit whether it may be the shorter one.
            held.append((flat[at], d, line, sign, size.astype(np.int32), ((pos[at] + 1) * 2 + (pos[at] <= shorter[at])).astype(np.uint32)))
            n += len(at)
            if n > HELD:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    def compare(table):
        key, d, line, sign, n, place = unpacked(table, *[np.int64] * 3, np.uint64, np.int32, np.uint32)
        order = np.lexsort((line, d, n, key))
        key, d, line, sign, n, place = (x[order] for x in (key, d, line, sign, n, place))
        n, pos = n.astype(np.int64), (place >> 1).astype(np.int64)
        # A list's lines stand by length, then by id: a line's partners are those behind it that are not too long.
        both = (np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) << 32) | n
        most = np.searchsorted(both, both - n + np.minimum(100 * n // percent, (1 << 32) - 1), side="right")
        count = np.where(place & 1 == 1, most - np.arange(len(key)) - 1, 0)
        ends, found, i = np.cumsum(count), [], 0
        while i < len(key):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + AT_ONCE, side="right")))
            x = np.repeat(np.arange(i, j), count[i:j])
            y = x + 1 + np.arange(len(x)) - np.repeat(ends[i:j] - count[i:j] - (ends[i - 1] if i else 0), count[i:j])
            total = n[x] + n[y]
            need = -(-percent * total // (100 + percent))
            ok = (np.minimum(n[x] - pos[x], n[y] - pos[y]) + 1 >= need) & (np.bitwise_count(sign[x] ^ sign[y]) <= total - 2 * need)
            found.append((x[ok], y[ok]))
            i = j
        x, y = (np.concatenate(f) for f in zip(*found, strict=True))
        return pa.table({"xd": d[x], "xl": line[x], "yd": d[y], "yl": line[y]})

    rows = arrow(classes.select("d", "l", "n", "sig", "prefix"), run, "bucket int, " + ", ".join(f"c{i} binary" for i in range(6)))
    return rows.groupBy("bucket").applyInArrow(compare, "xd long, xl long, yd long, yl long")


def doubles(batch, percent: int) -> tuple[np.ndarray, ...]:
    """(line, k1, k2, probe, place) of the lists of two words that a batch's lines stand in, as one that a longer or equal line may match,
    and (probe) as one that may match a shorter or equal one: for each frequent word that the other may lack, those of the
    word and each later one up to one more. Matching lines share the list of their first common word, if that is rare
    (single_pairs), else of their first two."""
    flat, row, pos, size, *lacking = placed(batch, percent)
    at, k2, probe = [], [], []
    for asks, lacks in enumerate(lacking):
        wide = np.flatnonzero((flat & 1 == 1) & (pos <= lacks))
        after = np.minimum(size[row[wide]], lacks[wide] + 2) - 1 - pos[wide]
        left = np.repeat(wide, after)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
        at.append(left)
        k2.append(flat[right])
        probe.append(np.full(len(left), bool(asks)))
    at = np.concatenate(at)
    return row[at], flat[at], np.concatenate(k2), np.concatenate(probe), pos[at]


def shared_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(k1, k2, n) of the lists of two words that may hold a pair: two lines at least, one of them as the shorter. A line that stands
    in a list as the shorter one does so as the longer one too (the latter may lack more), so the probes are the list's lines.
    Postings are counted in each task, and only the counts are shuffled."""

    def counted(held):
        k1, k2, n, lines_ = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((k2, k1))
        k1, k2 = k1[order], k2[order]
        first = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        return k1[first], k2[first], np.add.reduceat(n[order], first), np.add.reduceat(lines_[order], first)

    def dealt(k1, k2, *counts):
        return bucketed((mix(k1.view(U64)) ^ k2.view(U64)).view(np.int64), k1, k2, *counts)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            _, k1, k2, probe, _ = doubles(batch, percent)
            if len(k1):
                held.append((k1, k2, np.ones(len(k1), np.int64), probe.astype(np.int64)))
                n += len(k1)
            if n > HELD:
                held = [counted(held)]
                n = len(held[0][0])
                if n > HELD // 2:
                    yield dealt(*held[0])
                    held, n = [], 0
        if n:
            yield dealt(*counted(held))

    def summed(table):
        k1, k2, n, lines_ = counted([unpacked(table, *[np.int64] * 4)])
        keep = (lines_ > 1) & (n > lines_)
        return pa.table({"k1": k1[keep], "k2": k2[keep], "n": n[keep]})

    rows = arrow(classes.select("d", "l", "n", "sig", "prefix"), run, "bucket int, " + ", ".join(f"c{i} binary" for i in range(4)))
    return rows.groupBy("bucket").applyInArrow(summed, "k1 long, k2 long, n long")


POSTS = "k1 long, k2 long, probe boolean, pos int, d long, l long, n int, sig long"


def postings(classes: DataFrame, wanted, percent: int) -> DataFrame:
    """A row for each line in each of the wanted lists of two words, and maybe of others, see doubles()."""

    def run(batches):
        for batch in batches:
            row, k1, k2, probe, pos = doubles(batch, percent)
            keep = np.flatnonzero(is_wanted(wanted.value, k1, k2))
            take = pa.array(row[keep])
            made = [pa.array(k1[keep]), pa.array(k2[keep]), pa.array(probe[keep]), pa.array(pos[keep] + 1, pa.int32()), *(batch.column(i).take(take) for i in range(4))]
            out = pa.RecordBatch.from_arrays(made, [f.split()[0] for f in POSTS.split(", ")])
            for i in range(0, out.num_rows, 65_536):
                yield out.slice(i, 65_536)

    return arrow(classes.select("d", "l", "n", "sig", "prefix"), run, POSTS)


def in_lists(posts: DataFrame, wanted) -> DataFrame:
    """The postings of the wanted lists, and maybe of others, without a shuffle."""

    def run(batches):
        for batch in batches:
            keep = is_wanted(wanted.value, batch.column(0).to_numpy(), batch.column(1).to_numpy())
            if keep.any():
                yield batch.filter(pa.array(keep))

    return arrow(posts, run, POSTS)


def candidate_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """(xd, xl, yd, yl) of lines that share a list, x the shorter or, of equal ones, the earlier, and pass the filters of
    length, of position (what follows the shared word must suffice) and of signature (bits that differ are words that differ)."""
    side = lambda k, probe: posts.where(F.col("probe") == probe).select("k1", "k2", *(F.col(c).alias(f"{k}{c}") for c in ("pos", "d", "l", "n", "sig")))
    total = F.col("xn") + F.col("yn")
    need = F.ceil(total * percent / (100.0 + percent) - 1e-6)
    ahead = (F.col("xn") < F.col("yn")) | ((F.col("xn") == F.col("yn")) & ((F.col("xd") < F.col("yd")) | ((F.col("xd") == F.col("yd")) & (F.col("xl") < F.col("yl")))))
    fits = F.col("xn") * 100 >= F.col("yn") * percent
    rest = F.least(F.col("xn") - F.col("xpos"), F.col("yn") - F.col("ypos")) + 1
    differ = F.bit_count(F.col("xsig").bitwiseXOR(F.col("ysig")))
    return side("x", False).join(side("y", True), ["k1", "k2"]).where(ahead & fits & (rest >= need) & (differ <= total - 2 * need)).select("xd", "xl", "yd", "yl")


WORDS = "d long, l long, n int, s0 long, s1 long, s2 long, s3 long, words array<long>"


def wide_signatures(row: np.ndarray, word: np.ndarray, count: int) -> list[np.ndarray]:
    """The four longs of each line's signature: a bit for each of its words, WIDE_BITS of them."""
    bit = (mix(word.view(U64)) & U64(WIDE_BITS - 1)).astype(np.int64)
    out = np.zeros((count, WIDE_BITS // 64), np.int64)
    for low in range(0, count, 8192):
        high = min(low + 8192, count)
        i, j = np.searchsorted(row, (low, high))
        flags = np.zeros((high - low, WIDE_BITS), dtype=bool)
        flags[row[i:j] - low, bit[i:j]] = True
        out[low:high] = np.packbits(flags, axis=1).view(np.int64)
    return [np.ascontiguousarray(out[:, c]) for c in range(out.shape[1])]


def fetched(lines_: DataFrame, docs: DataFrame, order: Order) -> DataFrame:
    """(d, l, n, s0 to s3, words) of the wanted lines (d, l), and maybe of others: how many distinct words they have, a
    signature of WIDE_BITS bits, and those words in order."""
    wanted, bound = wanted_rows(lines_), session_of(docs).sparkContext.broadcast(order)

    def run(batches):
        for part in pieces(batches, 1 << 20):
            raw, at = text_column(part.column(1))
            ids, base = part.column(0).to_numpy(zero_copy_only=False), part.column(2).to_numpy(zero_copy_only=False)
            bounds, doc, number = line_bounds(raw, at)
            number = number + base[doc]
            use = np.flatnonzero(is_wanted(wanted.value, ids[doc], number))
            if len(use):
                own = np.concatenate([raw[bounds[i] : bounds[i + 1]] for i in use.tolist()])
                cut = np.concatenate([[0], np.cumsum(bounds[use + 1] - bounds[use])])
                row, word = line_sets(own, cut, bound.value)
                size = np.bincount(row, minlength=len(use))
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                signs = wide_signatures(row, word, len(use))
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc[use]]), pa.array(number[use]), pa.array(size, pa.int32()), *map(pa.array, signs), pa.ListArray.from_arrays(pa.array(offsets), pa.array(word))], [f.split()[0] for f in WORDS.split(", ")])

    return arrow(docs, run, WORDS)


def within(pairs: DataFrame, words_: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide signatures don't differ in more bits than similar enough sets differ in words: no link is lost,
    and few of the other pairs are joined to their words."""
    signs = [f"s{i}" for i in range(WIDE_BITS // 64)]
    side = lambda k: words_.select(*(F.col(c).alias(k + c) for c in ("d", "l", "n", *signs)))
    joined = pairs.join(side("x"), ["xd", "xl"]).join(side("y"), ["yd", "yl"])
    total = F.col("xn") + F.col("yn")
    differ = sum((F.bit_count(F.col("x" + s).bitwiseXOR(F.col("y" + s))) for s in signs), F.lit(0))
    return joined.where(differ <= total - 2 * F.ceil(total * percent / (100.0 + percent) - 1e-6)).select("xd", "xl", "yd", "yl")


def pair_links(pairs: DataFrame, words_: DataFrame, blocked: DataFrame, percent: int) -> DataFrame:
    """(d, l, links, later): links of pairs whose whole word sets are similar enough. Pairs whose first two common words
    make a blocked list are counted there, so they are left out here."""
    side = lambda k: words_.select(F.col("d").alias(f"{k}d"), F.col("l").alias(f"{k}l"), F.col("words").alias(f"{k}w"))
    joined = pairs.join(side("x"), ["xd", "xl"]).join(side("y"), ["yd", "yl"]).withColumn("both", F.array_intersect("xw", "yw"))
    alike = 100 * F.size("both") >= percent * (F.size("xw") + F.size("yw") - F.size("both"))
    found = joined.where(alike).select("xd", "xl", "yd", "yl", F.col("both")[0].alias("k1"), F.try_element_at("both", F.lit(2)).alias("k2")).join(blocked.select("k1", "k2"), ["k1", "k2"], "left_anti")
    ahead = (F.col("xd") < F.col("yd")) | ((F.col("xd") == F.col("yd")) & (F.col("xl") < F.col("yl")))
    of = lambda d, l, late: F.struct(F.col(d).alias("d"), F.col(l).alias("l"), F.lit(1).cast("long").alias("links"), late.cast("int").alias("later"))  # noqa: E731, E741
    return found.select(F.explode(F.array(of("xd", "xl", ~ahead), of("yd", "yl", ahead))).alias("c")).select("c.*")


COUNTS = "d long, l long, links long, later int"


def block_links(posts: DataFrame, blocked: DataFrame, words_: DataFrame, percent: int) -> DataFrame:
    """(d, l, links, later) of the lines of blocked lists: every pair of a list whose first two common words are the
    list's is compared as a whole.

    A list is dealt into chunks of BLOCK lines by hash and each pair of chunks is compared by one task, by matrix products:
    how many words two lines share, and whether they share one that comes before the list's. Only sums by line leave it.
    """
    dealt = posts.join(blocked, ["k1", "k2"]).select("k1", "k2", "d", "l", F.pmod(F.xxhash64("d", "l"), "chunks").cast("int").alias("mine"), "chunks").distinct()
    cells = dealt.join(words_, ["d", "l"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = cells.select("k1", "k2", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "d", "l", "words")

    def compare(key, table):
        w1, w2, i, j = (k.as_py() for k in key)
        d, line, mine = (table.column(c).to_numpy() for c in ("d", "l", "mine"))
        lists = table.column("words").combine_chunks()
        size = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        flat = lists.flatten().to_numpy()
        values, at = np.unique(flat, return_inverse=True)
        row = np.repeat(np.arange(len(d)), size)
        pos = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        until = np.zeros(len(d), dtype=np.int64)
        until[row[flat == w2]] = pos[flat == w2]
        has = np.isin(np.arange(len(d)), row[flat == w1]) & np.isin(np.arange(len(d)), row[flat == w2])
        often = np.bincount(at, minlength=len(values)) > 1
        slot = np.cumsum(often) - 1
        keep = often[at]
        early = keep & (pos < until[row]) & (flat != w1)
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        ok = has[left][:, None] & has[right][None, :]
        for first in range(0, len(left), BAND):
            band = left[first : first + BAND]
            shared = overlaps(row[keep], slot[at[keep]], len(d), band, right)
            earlier = overlaps(row[early], slot[at[early]], len(d), band, right)
            total = size[band][:, None] + size[right][None, :]
            ok[first : first + BAND] &= (100 * shared >= percent * (total - shared)) & (earlier == 0)
        place = np.empty(len(d), dtype=np.int64)
        place[np.lexsort((line, d))] = np.arange(len(d))
        if i == j:
            np.fill_diagonal(ok, False)
        links, later = np.zeros(len(d), dtype=np.int64), np.zeros(len(d), dtype=np.int32)
        links[left] += ok.sum(axis=1)
        later[left] |= (ok & (place[right][None, :] < place[left][:, None])).any(axis=1)
        if i != j:
            links[right] += ok.sum(axis=0)
            later[right] |= (ok & (place[left][:, None] < place[right][None, :])).any(axis=0)
        some = links > 0
        return pa.table({"d": pa.array(d[some], pa.int64()), "l": pa.array(line[some], pa.int64()), "links": pa.array(links[some]), "later": pa.array(later[some])})

    return cells.groupBy("k1", "k2", "i", "j").applyInArrow(compare, COUNTS)


def links_of(classes: DataFrame, docs: DataFrame, order: Order, shared, percent: int, scratch: Scratch) -> DataFrame:
    """(d, l, links, later) of the classes' first lines: how many classes match, and whether one of them comes before.

    Lists of one rare word hold RARE lines at most, lists of two words mostly few: both give pairs, which the filters leave
    few of. Long lists of two words are compared in blocks, as a family of thousands of variants of a line would give the
    square of that in pairs. Whether a list is long is counted exactly, and no pair depends on it.
    """
    lists = scratch.keep(shared_lists(classes, percent))
    double = scratch.keep(postings(classes, wanted_rows(lists.select("k1", "k2")), percent))
    blocked = scratch.keep(lists.where(F.col("n") > LONG).select("k1", "k2", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks")))
    short = in_lists(double, wanted_rows(lists.where(F.col("n") <= LONG).select("k1", "k2"))).join(blocked, ["k1", "k2"], "left_anti")
    pairs = scratch.keep(single_pairs(classes, shared, percent).union(candidate_pairs(short, percent)).distinct())
    dense = double.join(blocked, ["k1", "k2"], "left_semi").select("d", "l")
    wanted = pairs.select(F.col("xd").alias("d"), F.col("xl").alias("l")).union(pairs.select("yd", "yl")).union(dense)
    words_ = scratch.keep(fetched(wanted, docs, order))
    near = scratch.keep(within(pairs, words_, percent))
    found = scratch.keep(pair_links(near, words_, blocked, percent).union(block_links(double, blocked, words_, percent)).groupBy("d", "l").agg(F.sum("links").alias("links"), F.max("later").alias("later")))
    scratch.drop(double, lists, blocked, pairs, near, words_)
    return found


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text, base, key): exactly repeated rows once; rows that share an id but not the text have bases of their own,
    which set their lines' numbers apart."""
    row = lambda d, base: d.select("doc_id", "text", base.cast("long").alias("base"), text_key().alias("key"))
    many = scratch.keep(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if many.isEmpty():
        return row(docs, F.lit(0))
    again = docs.join(many, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    place = F.row_number().over(W.partitionBy("doc_id").orderBy(text_key(), F.length("text"))) - 1
    return scratch.keep(row(docs.join(many, "doc_id", "left_anti"), F.lit(0)).union(row(again, place * F.lit(APART))))


def text_key(text_col: str = "text"):
    """What tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def match_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """One row per different (document id, text): doc_id, text_key, n_lines, removed (array of line numbers from 0), n_links,
    class_id.

    Lines with equal word sets (A-Z in lower case; words by white space) are one class, whose first line is that with the
    smallest (doc_id, number). Classes whose sets have a Jaccard similarity of at least percent / 100 are linked, all of
    them, exactly. A line is removed if its class or a linked one has an earlier first line. n_links counts the links of
    the classes of the document's lines; class_id is the smallest document with an equal line, itself included. Lines of fewer
    than `least` different words stay. A null text is empty. Documents with a null id take no part and give one row
    each, without removals. Exactly repeated rows count once; rows with the same id and other texts are documents of their
    own, in the order of their texts' hashes.
    """
    scratch = Scratch(session_of(docs), "lines")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = numbered(docs.where(F.col("doc_id").isNotNull()), scratch)
    order, shared = word_order(known, scratch)
    every = scratch.keep(lines(known, order, percent, least))
    own = every.where("line_no >= 0")
    classes = scratch.keep(classes_of(own))
    per_line = links_of(classes.where(F.size("prefix") > 0), known, order, shared, percent, scratch)
    # A line alone in its class, without links, says nothing that its document's own row doesn't.
    decided = classes.select("n", "d1", "d2", "d", "l", "lines").join(per_line, ["d", "l"], "left").where("lines > 1 OR links > 0").select("n", "d1", "d2", "d", "l", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("later", F.lit(0)).alias("later"))
    flagged = own.select("doc_id", "line_no", "n", "d1", "d2").join(decided, ["n", "d1", "d2"])
    gone = (F.col("later") == 1) | (F.col("doc_id") != F.col("d")) | (F.col("line_no") != F.col("l"))
    base = F.shiftright("line_no", 40)
    none = F.lit(None).cast("long")
    rows = flagged.select("doc_id", base.alias("base"), none.alias("key"), F.when(gone, F.col("line_no").bitwiseAND(APART - 1)).cast("int").alias("gone"), "links", F.col("d").alias("first"), F.lit(0).alias("lines"))
    rows = rows.union(every.where("line_no < 0").select("doc_id", F.shiftright(-1 - F.col("line_no"), 40), "d1", F.lit(None).cast("int"), F.lit(0).cast("long"), F.col("doc_id"), "n"))
    found = rows.groupBy("doc_id", "base").agg(F.max("key").alias("text_key"), F.sum("lines").alias("n_lines"), F.array_sort(F.collect_set("gone")).alias("removed"), F.sum("links").alias("n_links"), F.min("first").alias("class_id")).drop("base")
    found = scratch.keep(found)
    scratch.drop(every, classes, per_line)
    lost = docs.where(F.col("doc_id").isNull()).select("doc_id", text_key().alias("text_key"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.array().cast("array<int>").alias("removed"), F.lit(0).cast("long").alias("n_links"), none.alias("class_id"))
    return found.unionByName(lost)


def remove_lines(docs: DataFrame, matched: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the lines that match_lines removes, row by row: rows of one id lose their own lines only, exactly repeated
    rows the same ones. Documents that lose a line and keep no word are left out. Any other columns stay, whatever their names."""
    id_, key, removed = fresh(docs, "id", "key", "gone")
    gone = matched.where(F.size("removed") > 0).select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("removed").alias(removed))
    joined = docs.join(gone, (docs[id_col] == F.col(id_)) & (text_key(text_col) == F.col(key)), "left")
    every = F.split(F.col(text_col), "\n")
    kept = let(every, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(removed)), lambda i: F.element_at(x, i + 1)), "\n"))
    text = F.when(F.col(removed).isNull(), F.col(text_col)).otherwise(kept)
    return joined.withColumn(text_col, text).where(F.col(removed).isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)
