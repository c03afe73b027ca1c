import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quillweave.llm import quality as Q
from quillweave.llm.common import text_column


def table(spark, texts):
    """Clashing names beside the columns that are read; one row twice, one without an id."""
    rows = [(i, t, 0.0, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:1] + [(None, "no id", 0.0, 1)], "doc_id long, text string, score double, owner int")


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "id long, label int")


def corpus(n):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("aeioulnrst") for _ in range(draw.randrange(2, 8)))
    good = lambda: " ".join(word() for _ in range(draw.randrange(20, 150))).capitalize() + "."
    bad = lambda: " ".join([word()] * 60 if draw.random() < 0.5 else [word().upper() + "!!" for _ in range(60)])
    return [good() if i % 3 else good() + " " + bad() for i in range(n)]


def test_gradients_are_the_loss_s():
    draw = np.random.default_rng(1)
    x, owner = draw.standard_normal((9, Q.WIDTH)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 2])
    heads, label = np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    p = {k: np.asarray(v, dtype=np.float64) for k, v in Q.start(x.mean(axis=0), x.std(axis=0) + 0.1).items()}
    loss = lambda: -np.mean([math.log(y if t else 1 - y) for y, t in zip(Q.forward(p, x, heads, owner)["y"], label, strict=True)])
    for name, g in Q.gradients(p, Q.forward(p, x, heads, owner), x, heads, owner, label).items():
        at = tuple(draw.integers(0, s) for s in np.shape(p[name]))
        step = np.zeros_like(p[name])
        step[at] = 1e-5
        base = p[name]
        p[name] = base + step
        up = loss()
        p[name] = base - step
        down = loss()
        p[name] = base
        assert (up - down) / 2e-5 == pytest.approx(np.asarray(g)[at], rel=1e-4, abs=1e-8), name


def test_scores_are_those_of_a_plain_loop(spark):
    texts = corpus(60)
    df = table(spark, texts)
    model = Q.fit(df.selectExpr("doc_id AS id", "text"), labels(spark, [(i, int(i % 3 > 0)) for i in range(60)]))
    got = {r.id: r for r in Q.score(df, model).collect()}
    for i, t in enumerate(texts[:10]):
        x, _ = Q.passages(*text_column(pa.array([t])))
        assert got[i].n_passages == len(x) == -(-len(t.split()) // Q.PASSAGE)
        h = [np.tanh((v - model["mean"]) / model["scale"] @ model["W"] + model["b"]) for v in x]
        e = [math.exp(float((np.tanh(v @ model["V"] + model["v"]) / (1 + np.exp(-(v @ model["U"] + model["u"])))) @ model["w"])) for v in h]
        z = sum(w / sum(e) * v for w, v in zip(e, h, strict=True))
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-float(z @ model["c"] + model["d"]))), abs=1e-4)
        assert got[i].share == pytest.approx(max(e) / sum(e), abs=1e-4) and (len(e) == 1 or e[got[i].top] == pytest.approx(max(e), rel=1e-4))


def test_bad_passages_are_found_in_held_out_documents(spark):
    texts = corpus(600)
    df = table(spark, texts)
    model = Q.fit(df.selectExpr("doc_id AS id", "text"), labels(spark, [(i, int(i % 3 > 0)) for i in range(400)]))
    score = {r.id: r.score for r in Q.score(df, model).collect()}
    held = range(400, 600)
    assert sum((score[i] >= 0.3) == (i % 3 > 0) for i in held) >= 190


def test_odd_rows(spark):
    texts = [None, "", " \n", "word", "😀 é " * 3, "x" * 200_000, "many words " * 50_000]
    df = table(spark, texts)
    docs = df.selectExpr("doc_id AS id", "text")
    model = Q.fit(docs, labels(spark, [(0, 1), (3, 0), (3, 1), (4, None), (5, 0), (6, 0), (99, 1), (None, 1)]))
    rows = Q.score(df, model).collect()
    assert len(rows) == len(texts) + 2 and sum(r.id == 0 for r in rows) == 2 and sum(r.id is None for r in rows) == 1
    got = {r.id: r for r in rows}
    assert all(0 <= r.score <= 1 and r.score == r.score for r in rows) and got[0].score == got[1].score == got[2].score
    assert got[6].n_passages == -(-100_000 // Q.PASSAGE) and got[5].n_passages == 1
    assert Q.fit(docs, labels(spark, [])) is None and {r.score for r in Q.score(df, None).collect()} == {0.5}
    assert Q.score(df.where("false"), model).count() == 0 and Q.fit(docs.where("false"), labels(spark, [(0, 1)])) is None


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    df = table(spark, corpus(200)).selectExpr("doc_id AS id", "text")
    some = labels(spark, [(i, i % 2) for i in range(200)])
    one, two = Q.fit(df, some, sample=50), Q.fit(df.repartition(7), some, sample=50)
    assert all(np.array_equal(one[k], two[k]) for k in one)
