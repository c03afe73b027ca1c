import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quillweave.llm.common import Scratch

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def run(spark, docs):
    scratch, out = Scratch(spark, "test"), {}
    for name, stage in pipeline.STAGES:
        docs = out[name] = scratch.keep(stage(spark, docs, ""))
    return out


def test_stages(spark):
    body = "\n".join(f"this is the line number {n} of a text about {t} and nothing else at all here" for n, t in enumerate(["sea", "land", "rain", "wind"]))
    rows = [(1, body, "en", "a"), (2, body, "en", "b"), (3, "12345 !!", "en", "c"), (4, None, "en", "d"), (5, "my password = q1w2e3r4t5y6 is here and this is all of it", None, "e"), (6, body.replace("sea", "sky").replace("else", "more"), "en", "f"), (7, "the house and the garden are in the town", "en", "g")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], COLUMNS).withColumn("extra", F.lit(1))
    out = run(spark, docs)
    ids = {k: sorted({r.doc_id for r in v.select("doc_id").collect()}) for k, v in out.items()}
    assert ids["language_id"] == [1, 2, 5, 6, 7] and ids["line_dedup"] == [1, 5, 6, 7] and set(ids["near_dedup"]) <= set(ids["line_dedup"]) and 1 in ids["near_dedup"]
    text = {r.doc_id: r for r in out["secret_scan"].collect()}
    assert text[5].text == "my <SECRET> is here and this is all of it" and text[5].n_chars == len(text[5].text) and text[5].lang == "en"
    assert all(v.columns == list(pipeline.COLUMNS) for k, v in out.items() if k != "packing")
    assert ids["packing"] == ids["secret_scan"]


def test_nothing(spark):
    assert run(spark, spark.createDataFrame([], COLUMNS))["packing"].count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables")
def test_run(spark):
    got = pipeline.run(spark, "/root/testdata/sf0.001")
    per = got.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert per.where("n > 1024").count() == 0 and got.select("doc_id").distinct().count() > 150
