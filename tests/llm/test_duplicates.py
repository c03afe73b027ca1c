import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline as pipeline
from quillweave.llm import common, linededup, neardup, registry

SPACE = re.compile("[\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return [w for w in SPACE.split((text or "").translate(LOWER)) if w]


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """Plain comparison of all documents with each other."""
    sets, root = {i: shingles(t) for i, t in rows if i is not None}, {}
    find = lambda i: i if root.setdefault(i, i) == i else find(root[i])
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('ABCdefgh')}{rng.randrange(4000)}é"
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(260):
        if i < 120:  # a family around the threshold
            w = list(base)
            for _ in range(rng.randrange(6)):
                w[rng.randrange(len(w))] = word()
        elif i < 170:  # a passage that many share
            w = passage + [word() for _ in range(rng.randrange(5, 80))]
        else:
            w = [word() for _ in range(rng.randrange(1, 60))]
        rows.append((i, " ".join(w)))
    rows += [(300, rows[200][1]), (301, rows[200][1].upper().replace("É", "é")), (302, ""), (303, None), (304, " \t\n"), (305, "one two"), (306, "One  TWO"), (None, rows[0][1]), (5, rows[5][1])]
    return rows


def test_near_duplicates_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LONG", 12)
    monkeypatch.setattr(neardup, "BLOCK", 32)
    rows = corpus(4)
    want, size = components(rows)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sketch string, rep int")
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], size[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = neardup.near_duplicates(spark.createDataFrame([(3, "a b c d e f " * 5000)], "doc_id long, text string")).first()
    assert (one.n_shingles, one.component_id, one.kept) == (6, 3, True)


def matches(rows, percent=90, least=4):
    sets, first = [], {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for i, line in enumerate((t or "").split("\n")):
            s = frozenset(words(line))
            if len(s) >= least:
                sets.append((d, i, s))
                first.setdefault(s, (d, i))
    links, later, classes = dict.fromkeys(first, 0), set(), list(first)
    for n, a in enumerate(classes):
        for b in classes[n + 1 :]:
            shared = len(a & b)
            if 100 * shared >= percent * len(a | b):
                links[a] += 1
                links[b] += 1
                later.add(max(a, b, key=first.get))
    out = {d: ([], 0) for d, _ in rows if d is not None}
    for d, i, s in sets:
        removed, n = out[d]
        out[d] = (removed + [i] * (s in later or first[s] != (d, i)), n + links[s])
    return out


def lines(seed, n=160):
    rng = random.Random(seed)
    bases = [[f"w{b}x{i}" for i in range(24)] for b in range(3)]
    rows = []
    for d in range(n):
        out = []
        for b in bases:
            w = list(b)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(24)] = f"r{rng.randrange(60)}"
            out.append(" ".join(w))
        out.append(" ".join(f"t{rng.randrange(9)}" for _ in range(12)))
        rows.append((d, "\n".join(out)))
    return rows + [(900, None), (901, ""), (902, "short line\n\nshort line"), (903, rows[0][1]), (904, rows[0][1].split("\n")[0] + "\nmy own words are here now"), (None, "a\nb")]


def test_lines_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(linededup, "RARE", 6)
    monkeypatch.setattr(linededup, "LONG", 15)
    monkeypatch.setattr(linededup, "BLOCK", 48)
    rows = lines(3)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n int, d1 string")
    matched = linededup.match_lines(docs)
    got = {r.doc_id: r for r in matched.collect()}
    want = matches(rows)
    assert {d: (r.removed, r.n_links) for d, r in got.items() if d is not None} == want
    assert got[None].n_lines == 2 and got[None].removed == [] and got[900].n_lines == 1 and got[903].class_id == 0
    kept = {r.doc_id: r.text for r in linededup.remove_lines(docs, matched).collect()}
    assert kept[904] == "my own words are here now" and 903 not in kept and kept[902] == "short line\n\nshort line" and kept[901] == "" and kept[None] == "a\nb"


def test_lists_of_one_line_pass_nothing(spark, monkeypatch):
    monkeypatch.setattr(linededup, "RARE", 1)
    grid = [[f"w{i}x{j}" for j in range(12)] for i in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate([*grid, *zip(*grid, strict=True)])]
    alike = [f"v{i}" for i in range(20)]
    rows += [(100, " ".join(alike)), (101, " ".join(["other", *alike[1:]])), (102, " ".join(["more", "v0", *alike[2:]]))]
    real, seen = linededup.in_lists, []

    def in_lists(posts, wanted):
        found = real(posts, wanted)
        seen.extend(found.select("d").collect())
        return found

    monkeypatch.setattr(linededup, "in_lists", in_lists)
    got = {r.doc_id: (r.removed, r.n_links) for r in linededup.match_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == matches(rows) and got[101] == ([0], 1)
    assert seen and {r.d for r in seen} <= {100, 101, 102}


def test_rare_words_lists_are_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for d in range(90):
        w = [f"{d % 3}x{i}" for i in range(rng.randrange(28, 33))]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"r{rng.randrange(40)}"
        rows.append((d - 40, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for held, at_once in ((linededup.HELD, linededup.AT_ONCE), (50, 7)):
        monkeypatch.setattr(linededup, "HELD", held)
        monkeypatch.setattr(linededup, "AT_ONCE", at_once)
        got = {r.doc_id: (r.removed, r.n_links) for r in linededup.match_lines(docs).collect()}
        assert got == matches(rows) and sum(n for _, n in got.values()) > 100


def test_blocks_are_compared_within_a_few_times_their_result():
    rng = np.random.default_rng(1)
    at = np.unique(np.stack([rng.integers(0, 2048, 40_000), rng.integers(0, 9_000, 40_000)], axis=1), axis=0)
    ones = np.zeros((2048, 9_000), np.float32)
    ones[at[:, 0], at[:, 1]] = 1
    left, right = np.arange(1024), np.arange(1024, 2048)
    tracemalloc.start()
    found = common.overlaps(at[:, 0], at[:, 1], 2048, left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == ones[left] @ ones[right].T).all() and peak < 6 * found.nbytes


def test_numbers_come_back_from_their_buckets(spark):
    rng = np.random.default_rng(4)
    key, place = rng.integers(-40, 40, 5000) * (1 << 57), np.arange(5000, dtype=np.uint32)
    batch = common.bucketed(key, key, place)
    assert batch.num_rows <= 80
    found = [common.unpacked(pa.Table.from_batches([batch.slice(i, 1)]), np.int64, np.uint32) for i in range(batch.num_rows)]
    assert len({k for ks, _ in found for k in set(ks.tolist())}) == sum(len(set(ks.tolist())) for ks, _ in found)
    assert sorted(p for _, ps in found for p in ps.tolist()) == place.tolist() and all((key[ps] == ks).all() for ks, ps in found)
    texts = [" ".join(f"w{min(rng.integers(200), rng.integers(200))}" for _ in range(50)) for _ in range(40)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = sorted(r.c for r in common.key_counts(docs, linededup.hashed, least=20).collect())
    assert got == sorted(n for n in collections.Counter(w for t in texts for w in words(t)).values() if n >= 20) and got


def test_only_lists_of_two_lines_make_rows(spark, monkeypatch):
    pairs = [(i, " ".join(f"u{i // 2}x{j}" for j in range(30)) + (" more" if i % 2 else "")) for i in range(40)]
    grid = [[f"w{i}x{j}" for j in range(12)] for i in range(12)]
    crossed = [(100 + i, " ".join(w)) for i, w in enumerate([*grid, *zip(*grid, strict=True)])]
    alike = [(200 + i, " ".join([f"own{i}", *(f"v{j}" for j in range(19))])) for i in range(3)]
    real, seen = linededup.postings, []

    def postings(classes, *more):
        found = real(classes, *more)
        seen.extend(found.select("d").collect())
        return found

    monkeypatch.setattr(linededup, "postings", postings)
    for rare, rows, want in ((128, pairs + crossed + alike, set()), (1, crossed + alike, {200, 201, 202})):
        monkeypatch.setattr(linededup, "RARE", rare)
        seen.clear()
        got = {r.doc_id: (r.removed, r.n_links) for r in linededup.match_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == matches(rows) and got[201] == ([0], 2) and {r.d for r in seen} == want


def test_lines_of_nothing(spark):
    assert linededup.match_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = linededup.match_lines(spark.createDataFrame([(1, "\n".join("a b c d e" for _ in range(3000)))], "doc_id long, text string")).first()
    assert one.n_lines == 3000 and one.removed == list(range(1, 3000))


def test_short_lines_take_part(spark, tmp_path):
    licence = "All rights reserved."
    rows = [(i, f"{licence}\nthis line is only in text {i}\n\n-- --") for i in range(6)] + [(10, "ha " * 50 + "\nha\nHA ho\nho ha hi"), (11, "hi ho HA\nho ha\n \t"), (12, licence.upper()), (13, None), (14, "\n")] + lines(5, 30)[:30]
    rows = [(n, t) for n, (_, t) in enumerate(rows)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: ([int(x) for x in r.removed.split(",") if x], r.n_links) for r in registry.op9_linededup(spark, str(tmp_path)).collect()}
    assert got == matches(rows, least=1)
    assert got[3][0] == [0, 3] and got[6][0] == [1] and got[7][0] == [0, 1] and got[8][0] == [0]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in pipeline.line_dedup(spark, docs, "").collect()}
    assert kept[0] == rows[0][1] and kept[3] == "this line is only in text 3\n" and 8 not in kept and kept[10] == "\n"


def test_rows_of_one_id_keep_their_own_lines(spark):
    rows = [(1, "a b c d e\nfirst"), (2, "p q r s t\nkeep this line too"), (2, "a b c d e\nother words stand here"), (3, "x y z\nx y z"), (3, "x y z\nx y z")]
    docs = spark.createDataFrame([(i, t, 7, 8, 9) for i, t in rows], "doc_id long, text string, _gone int, _id int, _key int")
    matched = linededup.match_lines(docs, least=linededup.EVERY)
    assert sorted((r.doc_id, r.n_lines, len(r.removed)) for r in matched.collect()) == [(1, 2, 0), (2, 2, 0), (2, 2, 1), (3, 2, 1)]
    kept = sorted((r.doc_id, r.text, r._gone, r._id) for r in linededup.remove_lines(docs, matched).collect())
    assert kept == [(1, rows[0][1], 7, 8), (2, "other words stand here", 7, 8), (2, rows[1][1], 7, 8), (3, "x y z", 7, 8), (3, "x y z", 7, 8)]
