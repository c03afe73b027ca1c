"""Near-duplicate documents: bottom-k sketches from one hash function, exact Jaccard on whole shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import U64, Scratch, arrow, fresh, is_wanted, lean, lower_bytes, mix, overlaps, pieces, range_hashes, session_of, text_column, wanted_rows, words
from quillweave.llm.components import components

#: Words of a shingle; links need 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 5, 75
#: Retained values of a document, and how many of them (lowest first) are looked up in inverted lists. A pair of
#: similarity 0.75 shares none of 16 with a probability of 0.25 ** 16.
SKETCH, LISTED = 64, 16
#: Retained values for comparisons within long lists, by how many standard deviations fewer than expected may be shared, and
#: the long lists of a class.
WIDE, DEVIATIONS, LISTED_LONG = 256, 5, 10
#: An inverted list of more classes than LONG is a long one. The map of those has SPARE bits a value, 2 ** MOST_BITS at most.
LONG, SPARE, MOST_BITS = 64, 16, 30
#: Documents with more than this share of values of long lists are also compared over those lists.
SHARED = 1 / 3
#: The union sketch's estimate must reach this: 0.75 less four and a half standard deviations.
ESTIMATE = 0.5
#: Stars over long lists: pivots of a list, lists of a class.
PIVOTS, STARRED = 4, 6
#: Rows of a side of a compared block.
BLOCK = 1024


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) of all rows' shingles in order of row and hash; hashes have 63 bits."""
    low = lower_bytes(raw)
    start, end, row = words(low, offsets)
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = range_hashes(low, start, end)
    with np.errstate(over="ignore"):
        span = n - SHINGLE + 1
        rows, keys = [], []
        if span > 0:
            h = one[:span].copy()
            for i in range(1, SHINGLE):
                h = h * U64(0x9E3779B97F4A7C15) + one[i : i + span]
            whole = row[:span] == row[SHINGLE - 1 :]
            rows.append(row[:span][whole])
            keys.append(h[whole])
        counts = np.bincount(row, minlength=len(offsets) - 1)
        few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(few):
            first = np.searchsorted(row, few)
            h = np.zeros(len(few), U64)
            for i in range(SHINGLE - 1):
                there = counts[few] > i
                h = np.where(there, h * U64(0x9E3779B97F4A7C15) + one[np.minimum(first + i, n - 1)], h)
            rows.append(few)
            keys.append(h + counts[few].astype(U64))
        key = mix(np.concatenate(keys)) >> U64(1)
    row = np.concatenate(rows)
    order = np.lexsort((key, row))
    row, key = row[order], key[order].astype(np.int64)
    keep = np.ones(len(row), dtype=bool)
    keep[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[keep], key[keep]


def sketches(docs: DataFrame, size: int = SKETCH, wanted=None) -> DataFrame:
    """doc_id, n (distinct shingles), d1 and d2 (digests of the set), sketch (its lowest hashes in order); only of wanted
    documents, if a map of those (common.wanted_rows) is given."""

    def run(batches):
        lean()
        if wanted is not None:
            batches = (b.filter(pa.array(is_wanted(wanted.value, b.column(0).to_numpy()))) for b in batches)
        for part in pieces(batches, 1 << 20):
            row, key = shingles(*text_column(part.column(1)))
            n = np.bincount(row, minlength=part.num_rows)
            first = np.concatenate([[0], np.cumsum(n)])
            digests = []
            for salt in (0x1234567, 0x89ABCDEF):
                with np.errstate(over="ignore"):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(key.astype(U64) ^ U64(salt)))])
                    digests.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            low = np.arange(len(key)) - np.repeat(first[:-1], n) < size
            at = np.concatenate([[0], np.cumsum(np.minimum(n, size))])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *map(pa.array, digests), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(key[low]))], ["doc_id", "n", "d1", "d2", "sketch"])

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, n long, d1 long, d2 long, sketch array<long>")


def long_lists(classes: DataFrame, scratch: Scratch):
    """A broadcast bitmap of the retained values that more than LONG classes hold, counted exactly. It has at least SPARE bits a
    value, so hardly any other value looks like one; such a list would be treated as a long one, and lose no pair."""
    found = scratch.keep(classes.select(F.explode("sketch").alias("v")).groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") > LONG).select("v"))
    size = 1 << min(MOST_BITS, max(10, (SPARE * found.count()).bit_length()))

    def slots_(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(batch.column(0).to_numpy() & (size - 1)))], ["slot"])

    bits = np.zeros(size, dtype=bool)
    bits[arrow(found, slots_, "slot long").toArrow().column(0).to_numpy()] = True
    scratch.drop(found)
    return session_of(classes).sparkContext.broadcast(np.packbits(bits).tobytes())


def listed(classes: DataFrame, hot) -> DataFrame:
    """rep, n, m, sketch, rare (lowest values of short lists) and common (lowest of long lists, only of classes with a
    large share of such values)."""

    def run(batches):
        bits = np.frombuffer(hot.value, np.uint8)
        slot = len(bits) * 8 - 1
        for batch in batches:
            column = batch.column(3)
            size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            flat = column.flatten().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            at = flat & slot
            common = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            out = []
            for mine in (~common, common):
                if mine is not common:
                    keep = mine
                else:
                    keep = mine & (np.bincount(row, weights=common, minlength=len(size)) > SHARED * size)[row]
                order = np.cumsum(keep)
                before = np.concatenate([[0], order])[np.cumsum(size) - size]
                keep = keep & (order - before[row] <= (LISTED_LONG if mine is common else LISTED))
                at = np.concatenate([[0], np.cumsum(np.bincount(row, weights=keep, minlength=len(size)))])
                out.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat[keep])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], ["rep", "n", "m", "sketch", "rare", "common"])

    return arrow(classes.select("rep", "n", "m", "sketch"), run, "rep long, n long, m long, sketch array<long>, rare array<long>, common array<long>")


def _alike(x: str, y: str) -> Column:
    """Sizes that allow the similarity."""
    return (F.col(x) * 100 >= F.col(y) * PERCENT) & (F.col(y) * 100 >= F.col(x) * PERCENT)


def rare_pairs(lists: DataFrame) -> DataFrame:
    """(a, b), a < b, of classes that share a retained value of a short list."""
    posts = lists.select("rep", "n", F.explode("rare").alias("value"))
    return posts.select("value", F.col("rep").alias("a"), F.col("n").alias("an")).join(posts.select("value", F.col("rep").alias("b"), F.col("n").alias("bn")), "value").where((F.col("a") < F.col("b")) & _alike("an", "bn")).select("a", "b").distinct()


def star_pairs(lists: DataFrame) -> DataFrame:
    """(a, b) of each class with a pivot of each of its long lists: one pair per entry, however long the list. Pivots are the class
    with most copies and those of lowest hash."""
    posts = lists.where(F.size("common") > 0).select("rep", "n", "m", F.explode(F.slice("common", 1, STARRED)).alias("value"))
    order = [-F.col("m") if i == 0 else F.xxhash64("rep", F.lit(i)) for i in range(PIVOTS)]
    pick = [F.min(F.struct(o.alias("o"), F.col("rep").alias("y"), F.col("n").alias("yn"))) for o in order]
    pivots = posts.groupBy("value").agg(F.array(*pick).alias("p"), F.count("*").alias("c")).where("c > 1").select("value", "p")
    # Each entry of a list meets one of the list's pivots; its other lists lead it to other ones.
    mine = F.get("p", F.pmod(F.xxhash64("rep", "value"), F.size("p")).cast("int"))
    pairs = posts.join(pivots, "value").select(F.col("rep").alias("x"), F.col("n").alias("xn"), mine.alias("p")).select("x", "xn", "p.y", "p.yn")
    pairs = pairs.where((F.col("x") != F.col("y")) & _alike("xn", "yn"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose union sketch (the lowest values of both sketches together) shares enough."""
    side = lambda k: classes.select(F.col("rep").alias(k), F.col("sketch").alias(f"{k}s"), F.col("n").alias(f"{k}n"))
    both = F.array_intersect("as", "bs")
    union = F.slice(F.array_sort(F.array_union("as", "bs")), 1, SKETCH)
    whole = (F.col("an") <= SKETCH) & (F.col("bn") <= SKETCH)
    enough = F.when(whole, 100 * F.size(both) >= PERCENT * (F.col("an") + F.col("bn") - F.size(both))).otherwise(F.size(F.array_intersect(both, union)) >= ESTIMATE * F.size(union))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(enough).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of documents whose whole shingle sets are similar enough."""
    pairs = scratch.keep(pairs)
    wanted = wanted_rows(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))

    def fetch(batches):
        for batch in batches:
            yield batch.filter(pa.array(is_wanted(wanted.value, batch.column(0).to_numpy())))

    texts = arrow(docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), "text"), fetch, "id long, text string")
    joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("at")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("bt")), "b").select("a", "b", "at", "bt")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                x, y = (shingles(*text_column(part.column(c))) for c in (2, 3))
                cut = lambda s: np.searchsorted(s[0], np.arange(part.num_rows + 1))  # noqa: B023, E731
                xc, yc, keep = cut(x), cut(y), []
                for r in range(part.num_rows):
                    p, q = x[1][xc[r] : xc[r + 1]], y[1][yc[r] : yc[r + 1]]
                    shared = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(bool(shared) and 100 * shared >= PERCENT * (len(p) + len(q) - shared))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow(joined, run, "a long, b long").distinct()


def block_pairs(lists: DataFrame, found: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of classes of different components so far that share a value of a long list and whose wide sketches agree.
    Those are made of the texts anew, for the classes of open lists only.

    In a list, the classes of its largest component are linked already, so they are compared with the others only: with s
    others among n classes the work is s * n, not n * n. Both parts are dealt into chunks of BLOCK classes by hash (those of
    the largest component have negative numbers); each pair of chunks is compared as a whole by one task: only pairs whose
    sketches agree leave it, each from the lowest list that both stand in, and no pair is written down before.
    """
    placed = lists.where(F.size("common") > 0).join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    posts = placed.select(F.explode("common").alias("value"), "rep", "component", "n", "common")
    parts = posts.groupBy("value", "component").agg(F.count("*").alias("c"))
    open_ = parts.groupBy("value").agg(F.max(F.struct("c", "component")).alias("main"), F.sum("c").alias("all"), F.count("*").alias("k")).where("k > 1")
    chunks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ = open_.select("value", F.col("main.component").alias("main"), chunks(F.col("main.c")).alias("mains"), chunks(F.col("all") - F.col("main.c")).alias("others"))
    posts = scratch.keep(posts.join(open_, "value"))
    wanted = wanted_rows(posts.select("rep").distinct())
    wide = scratch.keep(sketches(docs.where(F.col("doc_id").isNotNull()), WIDE, wanted).select(F.col("doc_id").alias("rep"), "n", "sketch").dropDuplicates(["rep", "n", "sketch"]))
    in_main = F.col("component") == F.col("main")
    place = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    dealt = posts.join(wide, ["rep", "n"]).withColumn("mine", F.when(in_main, -1 - place(F.col("mains"))).otherwise(place(F.col("others"))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.when(in_main, F.lit(0)).otherwise(-F.col("mains")), F.col("others") - 1)))
    cells = dealt.select("value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "component", "n", "common", "sketch")

    def compare(key, table):
        rep, comp, n, mine = (table.column(c).to_numpy() for c in ("rep", "component", "n", "mine"))
        lists_ = table.column("sketch").combine_chunks()
        size = np.asarray(lists_.value_lengths().to_numpy(zero_copy_only=False))
        values, at = np.unique(lists_.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(rep)), size)
        often = np.bincount(at, minlength=len(values)) > 1
        slot = np.cumsum(often) - 1
        left = np.flatnonzero(mine == key[1].as_py())
        right = np.flatnonzero(mine == key[2].as_py())
        shared = overlaps(row[often[at]], slot[at[often[at]]], len(rep), left, right)
        lists_ = table.column("common").combine_chunks()
        size = np.asarray(lists_.value_lengths().to_numpy(zero_copy_only=False))
        values, at = np.unique(lists_.flatten().to_numpy(), return_inverse=True)
        row, low = np.repeat(np.arange(len(rep)), size), values[at] < key[0].as_py()
        before = overlaps(row[low], at[low], len(rep), left, right)
        small, large = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
        # Of a whole set that many values are shared, of its lowest WIDE that part of them, less the allowance: whichever sketch
        # ends first, the other set lacks no more of its values than a draw of WIDE from the larger set would.
        whole = PERCENT / (100 + PERCENT) * (small + large)
        part = whole / np.maximum(large, 1)
        need = np.where(large <= WIDE, whole, WIDE * part - DEVIATIONS * np.sqrt(WIDE * part * np.maximum(1 - part, 0)))
        ok = (shared >= need - 1e-3) & (before == 0) & (comp[left][:, None] != comp[right][None, :]) & (100 * small >= PERCENT * large)
        x, y = np.nonzero(np.triu(ok) if key[1] == key[2] else ok)
        a, b = rep[left[x]], rep[right[y]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return cells.groupBy("value", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents with equal shingle sets are one class. Inverted lists of the classes' retained values give candidate pairs:
    all pairs of short lists; of long lists the pairs with their pivot, then, block by block, those between what is not
    linked yet. Union sketches filter, whole sets confirm. A null text is empty; empty documents are linked with nothing and
    kept. So are rows with a null id, whose component is null. Rows with the same id and different texts share an id, so
    their classes are linked; the row is kept if its id is its component's smallest.
    """
    spark = session_of(docs)
    scratch = Scratch(spark, "neardup")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = scratch.keep(sketches(docs))
    classes = scratch.keep(base.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("m"), F.first("sketch").alias("sketch")))
    lists = scratch.keep(listed(classes, long_lists(classes, scratch)))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return scratch.keep(verified(pairs, docs, scratch))

    linked = components(confirmed(estimated(rare_pairs(lists).union(star_pairs(lists)).distinct(), lists)), scratch)
    new = confirmed(block_pairs(lists, linked, docs, scratch))
    if not new.isEmpty():
        linked = components(new.union(linked.select(F.col("node").alias("a"), F.col("component").alias("b"))), scratch)
    of_class = classes.select("n", "d1", "d2", "rep").join(linked.withColumnRenamed("node", "rep"), "rep", "left").select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    out = base.select("doc_id", "n", "d1", "d2").join(of_class, ["n", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    found = scratch.keep(out)
    scratch.drop(base, classes, lists)
    return found


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose document is its group's smallest; of exactly repeated rows (id and text) one. Rows that share an id
    but not the text stay or go together; rows with a null id stay."""
    gone, many = (fresh(docs, k)[0] for k in ("gone", "many"))
    dropped = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    left = docs.join(dropped, docs[id_col] == F.col(gone), "left_anti")
    again = Scratch(session_of(docs), "repeated").keep(docs.groupBy(F.col(id_col).alias(many)).agg(F.count("*").alias("n")).where("n > 1").select(many))
    if again.isEmpty():
        return left
    here = F.col(id_col) == F.col(many)
    return left.join(again, here, "left_anti").union(left.join(again, here, "left_semi").dropDuplicates([id_col, text_col]))
