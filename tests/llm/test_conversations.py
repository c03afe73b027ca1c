import hashlib
import itertools
import random
import re
import zlib

import pytest

from quillweave.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, key string, segment long"
FORM = re.compile("(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)


def judged(rows):
    rows = sorted(((t is not None, t or 0, r, hashlib.sha256(x.encode()).digest()[:16], x, t) for _, t, r, x in rows), key=lambda r: r[:4])
    seen, out = set(), []
    for _, _, role, _, text, turn in rows:
        body = re.sub("[\x20\x09-\x0d]+$", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def brute(rows):
    """All edits with up to two inserts at each place, tried one by one."""
    rows = judged(rows)
    best = None
    gaps = ["", "I", "II"]
    for edits in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["D", "K", "R"] for *_, f in rows]):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            audit = inserts[0] + "".join(e + i for e, i in zip(edits, inserts[1:], strict=True))
            cost = sum({"K": 0, "R": 3, "D": 4}[e] + (3 if e != "D" and f == "truncated" else 0) for e, (*_, f) in zip(edits, rows, strict=True)) + 3 * audit.count("I")
            if best is not None and (cost, audit) >= best[:2]:
                continue
            roles, texts, it = "", [], iter(rows)
            for letter in audit:
                role, text = ("", "") if letter == "I" else next(it)[1:3]
                if letter == "D":
                    continue
                if letter != "K":
                    role = "assistant" if roles[-1:] == "u" else "user"
                roles += role[:1] or "?"
                texts.append(f"{role}:{text}")
            if FORM.fullmatch(roles):
                best = (cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest())
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[:1] for _, r, *_ in rows]
    counts = [sum(f == k for *_, f in rows) for k in ("blank", "duplicate", "truncated")]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), *best)


def random_rows(draw, ids, most):
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", "U"], ["Ok.", "Yes!", "no", "", " \n", "a b. ", "x?\t", "é."]
    return [(i, draw.choice([None, *range(6)]), draw.choice(roles), draw.choice(texts)) for i in ids for _ in range(draw.randrange(1, most))]


def plain(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_equal_to_all_edits_tried(spark):
    rows = random_rows(random.Random(5), range(60), 5)
    got = plain(C.repair(frame(spark, rows)))
    assert got == {i: brute([r for r in rows if r[0] == i]) for i in range(60)}


def test_segments_join_to_the_whole(spark):
    draw = random.Random(9)
    rows = random_rows(draw, range(12), 40) + [(50, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(300)] + [(51, 3, "user", "same.")] * 200 + [(52, t, "user", "same.") for t in range(90)]
    df = frame(spark, rows)
    whole = plain(C.repair(df, segment=1 << 20))
    assert len(whole[50][6]) >= 300 and whole[51][2] == 199
    for size in (1, 2, 7, 64):
        assert plain(C.repair(df, segment=size)) == whole


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(40), None) for t, (r, x) in enumerate([("user", "a! b."), (None, "c."), ("assistant", None), ("user", "")])] + [(7, None, "user", "n.")]
    want = []
    for c, t, r, x in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if code:
            want += [(c, t, "user" if code == 4 else r, "" if code == 1 else re.sub("[.!?]", "", x) if code == 2 else x)] * (2 if code == 3 else 1)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in C.damage(frame(spark, rows)).collect()), key=key) == sorted(want, key=key)


def test_odd_tables(spark):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    some = frame(spark, [(1, 0, "user", "A."), (1, 1, "assistant", "B."), (None, None, None, None), (None, 5, "user", "long " * 100_000 + ".")])
    got = plain(C.repair(some, frame(spark, [(1, 0, "user", ""), (2, 0, "user", ""), (2, 1, "user", ""), (None, 0, "", "")])))
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KK") and got[2] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[None][:4] == (0, 1, 0, 0) and got[None][6] == "DKI"
    assert got[None][7] == hashlib.sha256(("user:" + "long " * 100_000 + ".\nassistant:").encode()).hexdigest() and C.repair(some.where("false")).count() == 0
    again = C.repair(frame(spark, [(1, 0, "user", "A."), (1, 0, "user", "A."), (1, 1, "assistant", "B.")]))
    assert plain(again)[1][:7] == (0, 0, 1, 0, 1, 4, "KDK")


@pytest.mark.parametrize("segment", [2, 128])
def test_query_is_its_sql(spark, segment):
    import duckdb

    rows = random_rows(random.Random(2), range(80), 12)
    rows = [(c, t, r, x) for c, t, r, x in rows if t is None or r] + [(None, 1, "user", "q."), (None, None, None, None)]
    seen, unique = set(), []
    for r in rows:
        if r not in seen:
            seen.add(r)
            unique.append(r)
    df = frame(spark, unique)
    got = C.repair(C.damage(df), df, segment)
    conversations = df.toPandas()  # noqa: F841
    for c in ("conv_id", "turn"):
        conversations[c] = conversations[c].astype("Int64")
    want = duckdb.sql(C.oracle()).fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
