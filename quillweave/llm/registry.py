"""The queries of this package and their SQL, by name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quillweave.llm import ann, bpe, collocations, common, conversations, langid, linededup, lm, neardup, packing, quality, secrets, topk, toxicity

VOCABULARY = "byte_bpe_50k.json"


def op1_topk(spark, sf_dir):
    vectors = topk.quantise(common.read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return topk.exact_top_k(vectors, vectors.where(F.col("id") % 50 == 0))


def op2_neardup(spark, sf_dir):
    return neardup.near_duplicates(common.read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_toxicity(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    labels = common.read(spark, sf_dir, "labels", "doc_id", "toxic").where(common.fold("doc_id", 3) != 1)
    weights = toxicity.fit(docs.withColumnRenamed("doc_id", "id"), labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")))
    found = toxicity.score(docs, weights)
    return found.select(F.col("id").alias("doc_id"), (common.fold("id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_secrets(spark, sf_dir):
    return secrets.digest(secrets.scan(common.read(spark, sf_dir, "documents", "doc_id", "text", "source")))


def op5_langid(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    train = docs.where(common.fold("doc_id", 4) != 2).select(F.col("doc_id").alias("id"), "text", "lang")
    found = langid.predict(docs, langid.fit(train))
    return found.select(F.col("id").alias("doc_id"), (common.fold("id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op6_ann(spark, sf_dir):
    vectors = ann.usable(common.read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return ann.search(vectors, vectors.where(F.col("id") % 50 == 0))


def op7_bpe(spark, sf_dir):
    return bpe.round_trip(common.read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(VOCABULARY))


def op8_lm(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    found = lm.language_scores(docs, docs.where(common.fold("doc_id", 7) != 2))
    return found.withColumn("held_out", common.fold("doc_id", 7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_linededup(spark, sf_dir):
    found = linededup.match_lines(common.read(spark, sf_dir, "documents", "doc_id", "text"), least=linededup.EVERY)
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "n_links", "class_id", F.array_join("removed", ",").alias("removed"))


def op10_packing(spark, sf_dir):
    return packing.pack(common.read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(VOCABULARY))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(common.read(spark, sf_dir, "documents", "lang", "text"))


def op12_quality(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    labels = common.read(spark, sf_dir, "labels", "doc_id", "quality").where(common.fold("doc_id", 5) != 0)
    model = quality.fit(docs.withColumnRenamed("doc_id", "id"), labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    found = quality.score(docs, model)
    return found.select(F.col("id").alias("doc_id"), (common.fold("id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages")


def op13_conversations(spark, sf_dir):
    rows = common.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damage(rows), rows)


SQL = {
    "op11_collocations": collocations.oracle(),
    "op13_conversations": conversations.oracle(),
    "op4_secrets": secrets.oracle(),
    "op1_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
                   FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS query_id, b.vec_id,
                          CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
                   FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
}

QUERIES = {f.__name__: f for f in (op1_topk, op2_neardup, op3_toxicity, op4_secrets, op5_langid, op6_ann, op7_bpe, op8_lm, op9_linededup, op10_packing, op11_collocations, op12_quality, op13_conversations)}
