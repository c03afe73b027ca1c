"""Tagging with a whole vocabulary against every run of every text tried one by one."""

import random

import pytest
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.keys import spelled
from quillweave.functions.spans import remove_overlaps
from quillweave.operators import linking
from quillweave.operators.dictionary import GAP, TOKEN, Dictionary, singular_word


def brute(text, keys):
    tokens = [m.span() for m in TOKEN.finditer(text)]
    own = lambda s, e: bool(spelled(text[s:e])) and not (text[s:e] in "sS" and s and text[s - 1] in "'’`")
    found = []
    for i, (start, first) in enumerate(tokens):
        for j in range(i, len(tokens)):
            if j > i and not GAP.fullmatch(text[tokens[j - 1][1] : tokens[j][0]]):
                break
            end = tokens[j][1]
            if not own(start, first) or not own(*tokens[j]):
                continue
            words = spelled(text[start:end]).split()
            kind = keys.get(" ".join(words), keys.get(" ".join(sorted(map(singular_word, words)))))
            if kind is not None:
                found.append((start, end, kind))
    kept = []
    for s, e, k in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
        if all(e <= a or b <= s for a, b, _ in kept):
            kept.append((s, e, k))
    return sorted((s, e, S.ENTITY_TYPES[k], text[s:e]) for s, e, k in kept)


def vocabulary(spark, draw, n):
    words = ["alpha", "beta", "τ", "Crohn's", "disease", "diseases", "bodies", "body", "ss", "s", "É", "a", "b2", "3", "nf-kB", "x_y", "½", "éa"]
    rows = [(draw.choice([*S.ENTITY_TYPES, "Other"]), " ".join(draw.choice(words) for _ in range(draw.randrange(1, 5))), f"id{i}", "n", draw.randrange(3), i) for i in range(n)]
    return words, spark.createDataFrame(rows, S.LEXICON)


@pytest.mark.parametrize("most", [1 << 20, 3])
def test_equal_to_brute_force(spark, most):
    draw = random.Random(4)
    words, lexicon = vocabulary(spark, draw, 60)
    index = linking.lexicon_index(lexicon).where(F.col("type").isin(*S.ENTITY_TYPES)).collect()
    keys = {}
    for r in index:
        keys[r.key] = min(keys.get(r.key, 9), S.ENTITY_TYPES.index(r.type))
    texts = [None, "", "'s", "a's b's", "the the"] + ["".join(draw.choice([*words, "the", "Tau", "ALPHA"]) + draw.choice([" ", " ", "-", ", ", "'s ", "’S ", " (", ". ", "/"]) for _ in range(draw.randrange(25))) for _ in range(200)]
    df = spark.createDataFrame([(str(i), 0, t, "kept", 1) for i, t in enumerate(texts)], "pmid string, index int, text string, key string, kind int")
    dictionary = Dictionary(lexicon, most)
    assert dictionary.broadcast == (most > 3)
    got = {int(r.pmid): sorted(tuple(s) for s in r.spans) for r in dictionary.tag(df).collect()}
    want = {i: brute(t or "", keys) for i, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 100
    plain = dictionary.tag(df.where("pmid > '190'"))
    assert plain.columns == [*df.columns, "spans"]
    again = plain.select("spans", remove_overlaps(F.col("spans")).alias("same")).collect()
    assert all(r.spans == r.same for r in again)


def test_longest_names_first(spark):
    lexicon = spark.createDataFrame([("Disease", "Crohn disease", "D1", "n", 0, 0), ("Gene", "crohn", "G1", "n", 0, 1), ("Disease", "Parkinson disease dementia", "D2", "n", 0, 2), ("Chemical", "dementia", "C", "n", 0, 3), ("Gene", "dementia", "G", "n", 0, 4)], S.LEXICON)
    text = "Crohn's diseases and crohn; disease. Parkinson disease, dementia"
    df = spark.createDataFrame([("1", 0, text)], "pmid string, index int, text string")
    got = Dictionary(lexicon).tag(df).first().spans
    assert [(s.text, s.label) for s in got] == [("Crohn's diseases", "Disease"), ("crohn", "Gene"), ("dementia", "Gene")]


def test_an_empty_vocabulary(spark):
    empty = spark.createDataFrame([], S.LEXICON)
    df = spark.createDataFrame([("1", 0, "a b")], "pmid string, index int, text string")
    assert Dictionary(empty).tag(df).first().spans == [] == Dictionary(empty, -1).tag(df).first().spans


def test_a_large_vocabulary_in_flat_arrays(spark):
    """Bytes of the arrays grow with the names, about 40 each."""
    lexicon = spark.range(200_000).select(F.lit("Gene").alias("type"), F.concat(F.lit("name "), F.col("id").cast("string"), F.lit(" x")).alias("surface"), F.col("id").cast("string").alias("entity_id"), F.lit("n").alias("name"), F.lit(0).alias("priority"), F.col("id").alias("ordinal"))
    dictionary = Dictionary(lexicon)
    t = dictionary.table.value
    assert dictionary.n_keys == 200_000 and t.hashes.nbytes + t.offsets.nbytes + len(t.spelling) + t.types.nbytes < 40 * 200_000
    df = spark.createDataFrame([("1", 0, "name 7 x, x 199999 name or name 200000 x")], "pmid string, index int, text string")
    assert [s.text for s in dictionary.tag(df).first().spans] == ["name 7 x", "x 199999 name"]
