import collections
import random
import re

import numpy as np
import pytest

from quillweave.llm import collocations as C

COLUMNS = "doc_id long, text string, lang string, phrase string, c long, size int"


def brute(rows, least, longest, top, cover=80):
    """Every phrase counted one by one, all arithmetic in whole numbers."""
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang, low = "und" if lang is None else lang, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= cover * a for b in inside):
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, (t, lang) in enumerate(rows)], COLUMNS)
    return sorted(tuple(r) for r in C.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("top", [2000, 7])
def test_equal_to_brute_force(spark, top):
    draw = random.Random(top)
    words = ["a", "b", "A", "ab", "é", "É", "😀", "a\x01", "-", "b"]
    rows = [("".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ". ", ".", "\n", "!?", " ,"]) for _ in range(draw.randrange(60))), draw.choice(["en", "fr", None, "und", ""])) for _ in range(120)]
    rows += rows[:20] + [(None, "en"), ("", None), (" \t.", "en"), ("A b\x0cA b\x0b", "en"), ("a " * 3000 + "b", "fr"), ("q r. q r", None)]
    assert found(spark, rows, least=3, top=top) == brute(rows, 3, 4, top)


def test_tables_without_candidates(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("one two", "en")]) == []


def test_covered_candidates_and_shorter_phrases(spark):
    rows = [("x y z w", "en")] * 4 + [("x y", "en"), ("y z q", "en")]
    for longest in (2, 3, 4):
        assert found(spark, rows, least=3, longest=longest) == brute(rows, 3, longest, 2000)


def test_colliding_counters_only_add_candidates(spark, monkeypatch):
    """A sketch so small that every phrase looks frequent gives the same rows."""
    monkeypatch.setattr(C, "MOST", C.FEWEST)
    monkeypatch.setattr(C, "FEWEST", 1 << 10)
    rows = [(" ".join(f"w{i * j % 97}" for j in range(200)), "en") for i in range(40)]
    assert found(spark, rows, least=5) == brute(rows, 5, 4, 2000)


def test_guards():
    one = C.Words("en", [b"Ab  c.d", b"", b"ab\tc"])
    text, start, end = one.guarded()
    assert text.tobytes() == b" ab c  d  ab c  " and [text[s:e].tobytes() for s, e in zip(start, end, strict=True)] == [b"ab", b"c", b"d", b"ab", b"c"]
    assert one.next.tolist() == [True, False, False, True, False] and len(np.unique(C._identities(text, start))) == 3
