import numpy as np
import pytest
from pyspark.sql import functions as F

from quillweave.llm import ann, topk


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, score string")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.3 * rng.normal(size=(1500, 16))) / 4
    x[700:720] = x[700]
    out = [(i, [float(np.float32(c)) for c in v], "x", "y") for i, v in enumerate(x)]
    odd = [(2000, None, "", ""), (2050, [float("nan")] * 16, "", ""), (2100, [None] * 16, "", ""), (2150, [float("inf")] * 16, "", ""), (2200, [0.0] * 16, "", ""), (None, [1.0] * 16, "", ""), (2250, [0.5, -0.25], "", "")]
    return out + odd + out[:3]


def test_exact_top_k_is_brute_force(spark, rows):
    v = topk.quantise(frame(spark, rows))
    got = topk.exact_top_k(v, v.where(F.col("id") % 50 == 0), block_rows=400, query_rows=16).collect()
    x = {i: np.floor(256 * np.pad(np.array(e, dtype=float), (0, 16 - len(e)))).astype(int) for i, e, *_ in rows if i is not None and e is not None and i not in (2050, 2100, 2150)}
    want = {}
    for q in (i for i in x if i % 50 == 0):
        best = sorted((-int(x[q] @ x[i]), i) for i in x if i != q)[:5]
        want |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)}
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want


def test_few_and_no_vectors(spark):
    v = topk.quantise(frame(spark, [(0, [1.0], "", ""), (1, [-2.0], "", ""), (50, [float(1 << 30)], "", "")]))
    got = sorted(tuple(r) for r in topk.exact_top_k(v, v.where("id % 50 = 0")).collect())
    big = 256 << 30
    assert got == [(0, 1, 50, 256 * big), (0, 2, 1, -512 * 256), (50, 1, 0, 256 * big), (50, 2, 1, -512 * big)]
    v = topk.quantise(frame(spark, [(0, [1e30], "", ""), (1, [-1e30], "", ""), (2, [1e30], "", "")]))
    most = (1 << 63) - 1
    assert sorted(tuple(r) for r in topk.exact_top_k(v, v.where("id % 50 = 0")).collect()) == [(0, 1, 2, most), (0, 2, 1, -most - 1)]
    none = topk.quantise(frame(spark, []))
    assert topk.exact_top_k(none, none).count() == 0
    none = ann.usable(frame(spark, []))
    assert ann.search(none, none).count() == 0


def test_signed_digits():
    for n in range(300):
        d = topk.signed_digits(n)
        assert sum(s << k for k, s in d) == n and all(b - a > 1 for (a, _), (b, _) in zip(d, d[1:], strict=False))


def test_neighbours_recall_and_scores(spark, rows, monkeypatch):
    monkeypatch.setattr(ann, "PARTITION_ROWS", 200)
    v = ann.usable(frame(spark, rows))
    got = ann.search(v, v.where("id % 50 = 0")).collect()
    x = {i: np.pad(np.array(e, dtype=float), (0, 16 - len(e))) for i, e, *_ in rows if i is not None and e is not None and i not in (2050, 2100, 2150, 2200)}
    ids = np.array(sorted(x))
    m = np.array([x[i] / np.linalg.norm(x[i]) for i in ids])
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        s = m @ (x[q] / np.linalg.norm(x[q]))
        s[ids == q] = -2
        mine = [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert all(abs(s[ids == i][0] - score) < 1e-12 for i, score in mine) and [c for _, c in mine] == sorted((c for _, c in mine), reverse=True)
        kth = np.sort(s)[-5]
        hits += sum(score >= kth - 1e-12 for _, score in mine)
        total += 5
    assert hits / total >= 0.9


def test_partition_is_balanced():
    rng = np.random.default_rng(0)
    x = ann.unit(rng.normal(size=(600, 8)))
    part = ann.balanced_partition(x, ann.neighbour_graph(x), 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.1 * 600 / 8)


def test_ids_that_repeat(spark):
    rows = [(50, [1.0, 0.0], "", ""), (50, [0.0, 1.0], "", ""), (7, [0.0, 2.0], "", ""), (7, [3.0, 0.0], "", ""), (7, [3.0, 0.0], "", ""), (8, [0.5, 0.5], "", "")]
    v = topk.quantise(frame(spark, rows))
    got = sorted(tuple(r) for r in topk.exact_top_k(v, v.where("id = 50")).collect())
    assert got[:2] == [(50, 1, 7, 768 * 256), (50, 2, 7, 512 * 256)] and {r[2] for r in got} == {7, 8}
    w = ann.usable(frame(spark, rows))
    found = sorted(tuple(r) for r in ann.search(w, w.where("id = 50")).collect())
    assert [r[2:] for r in found[:2]] == [(7, 1.0), (7, 1.0)] and {r[2] for r in found} == {7, 8}


def test_equal_vectors_are_ranked_by_id_in_any_block(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(4)
    same = rng.normal(size=64)
    rows = [(i, [float(c) for c in (same if i % 3 else rng.normal(size=64))], "", "") for i in range(600)]
    rows += [(1000 + i, [float(c) * 2.0**i for c in same], "", "") for i in range(9)]
    v = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, score string"))
    got = ann.search(v, v.where("id % 50 = 0")).collect()
    for q in range(50, 600, 50):
        if q % 3:
            mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
            assert [m[1] for m in mine] == [1, 2, 4, 5, 7] and len({m[2] for m in mine}) == 1
