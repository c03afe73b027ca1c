import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions import spans as SP
from quillweave.functions.abbreviations import definitions
from quillweave.functions.keys import candidate_keys, lookup_keys, normalize_key, spelled
from quillweave.functions.language import guess_language, nlp_scope
from quillweave.functions.sentences import ABBREVIATIONS, document_sentences, sentence_spans


def values(spark, make, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").select("v").collect()]


def sentences(spark, *texts):
    return [[t[s.start : s.end] for s in spans] for t, spans in zip(texts, values(spark, sentence_spans, texts), strict=True)]


def test_sentences(spark):
    got = sentences(
        spark, "One ends. Two begins.", "Seen in vitro (e.g. APOE) by Dr. Smith. It works.", "A dose of 2.5 mg was given. then nothing. 5 more.", 'He said "no." Then left.',
        "  \n ", "Is it? Yes! (Perhaps.) [Maybe.] End", "Vitamin B. Next one.", "😀 face. Next 😀. End.", "a b. C d.",
    )
    assert got == [
        ["One ends.", "Two begins."], ["Seen in vitro (e.g. APOE) by Dr. Smith.", "It works."], ["A dose of 2.5 mg was given. then nothing. 5 more."], ['He said "no."', "Then left."],
        [], ["Is it?", "Yes!", "(Perhaps.)", "[Maybe.]", "End"], ["Vitamin B. Next one."], ["😀 face.", "Next 😀.", "End."], ["a b. C d."],
    ]


def plain_sentences(text):
    """A second form of the rules, letter by letter."""
    out, start = [], 0
    for m in re.finditer(r"[.!?][\"')\]]?\s+", text):
        after = text[m.end() : m.end() + 1]
        before = re.search(r"\S*$", text[: m.start()])[0].lstrip("([").lower()
        short = text[m.start()] == "." and (before in ABBREVIATIONS.split() or (len(before) == 1 and before.isalpha()))
        if after and (after.isupper() or after in "([\"'") and not short:
            out.append((start, m.end()))
            start = m.end()
    return [s for a, b in [*out, (start, len(text))] if (s := text[a:b].strip())]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="Aab.!? \n)\"('[é😀\x01\x1c", max_size=40), min_size=1, max_size=30))
def test_sentences_agree_with_plain_rules(spark, texts):
    assert sentences(spark, *texts) == [plain_sentences(t) for t in texts]


def test_long_text_has_many_sentences(spark):
    text = "Word one. " * 3000
    spans = values(spark, sentence_spans, [text])[0]
    assert len(spans) == 3000 and spans[-1].start == 29990


def test_sentences_take_time_in_proportion_to_the_text(spark):
    """Words of one long text are looked at where a full stop ends them, and its sentences are cut out of it once: a text of one long word,
    of blanks only between two words, or of many sentences costs no square of its length."""
    import time

    many = "One (e.g. This) ends. " * 30_000
    texts = ["x" * 200_000 + ". Y", "a." + " " * 200_000 + "b.", "(" * 200_000 + "p. Q", many]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    start = time.time()
    got = [r.v for r in df.select(document_sentences(F.lit(""), F.col("t")).alias("v")).collect()]
    assert time.time() - start < 60
    assert [len(v) for v in got] == [2, 1, 1, 30_000] and {s.text for s in got[3]} == {"One (e.g. This) ends."}
    assert all(s.text == t[s.start - 1 : s.end - 1] for t, v in zip(texts[:3], got, strict=False) for s in v)


def test_brackets_before_short_words(spark):
    texts = ["x(e.g. A", "(e.g. A", "x ([(p. A", "x[](Dr. A", "\u0130. A", "a\x02b. C\x01 (e.g. D) e. F"]
    assert sentences(spark, *texts) == [plain_sentences(t) for t in texts]


def test_document_sentences(spark):
    df = spark.createDataFrame([("APOE in AD", "It binds. It acts.")], "a string, b string")
    got = df.select(document_sentences(F.col("a"), F.col("b"))).first()[0]
    assert [(s["index"], s.start, s.end, s.text) for s in got] == [(0, 0, 10, "APOE in AD"), (1, 11, 20, "It binds."), (2, 21, 29, "It acts.")]


def test_language(spark):
    english = "We show that the gene is associated with the disease in patients and controls."
    french = "Nous montrons que le gène est associé à la maladie chez les patients suivis."
    assert values(spark, guess_language, [english, french, "", "APOE e4", None]) == ["en", "non-en", "unknown", "unknown", "unknown"]
    df = spark.createDataFrame([(english, french), (french, english), (french, french), ("short", ""), ("", "")], "t string, a string")
    assert [r[0] for r in df.select(nlp_scope(F.col("t"), F.col("a"))).collect()] == ["title", "title+abstract", "none", "title", "none"]


def test_keys(spark):
    names = ["alpha-synuclein", "α-synuclein", "Synuclein alpha", "Parkinson's disease", "Lewy bodies", "--", "Ménière", "µm", None]
    assert values(spark, normalize_key, names) == ["alpha synuclein"] * 3 + ["disease parkinson", "bodies lewy", "", "meniere", "m", ""]
    assert values(spark, lookup_keys, ["Lewy bodies", "glass", "gas", "APOE"]) == [["bodies lewy", "body lewy"], ["glass"], ["gas"], ["apoe"]]
    df = spark.createDataFrame([("AD", "Alzheimer's disease"), ("factor (x)", None)], "s string, l string")
    assert [r[0] for r in df.select(candidate_keys(F.col("s"), F.col("l"))).collect()] == [["alzheimer disease", "ad"], ["factor x", "factor"]]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB1 -'s`éα_ß", max_size=12), min_size=1, max_size=40))
def test_ascii_keys_agree_with_the_general_form(spark, texts):
    assert values(spark, normalize_key, texts) == [spelled(t) for t in texts]


def test_abbreviations():
    text = "Crohn's disease (CD) and restless legs syndrome (RLS) with tumour necrosis factor alpha (TNFA) (n = 20) and L-3,4-dihydroxyphenylalanine (L-DOPA). Later control diet (CD)."
    found = definitions(text)
    assert found["CD"] == "Crohn's disease" and found["RLS"] == "restless legs syndrome" and found["TNFA"] == "tumour necrosis factor alpha"
    assert "n = 20" not in found and definitions("Nothing here fits (XYZ).") == {}
    assert definitions("the non-small cell lung (SCL) and heat shock unit ( HSU ) or HSU (HSU)") == {"SCL": "non-small cell lung", "HSU": "heat shock unit"}


def spans_of(rows):
    return [{"start": a, "end": b, "label": k, "text": ""} for a, b, k in rows]


def test_spans(spark):
    df = spark.createDataFrame([(spans_of([(0, 4, "Gene"), (0, 10, "Gene"), (12, 15, "Gene"), (14, 18, "Gene")]),)], f"s {S.SPANS}")
    assert [(x.start, x.end) for x in df.select(SP.remove_overlaps(F.col("s"))).first()[0]] == [(0, 10), (14, 18)]
    token = "array<struct<start:int,end:int>>"
    offsets = [(0, 0), (0, 4), (5, 7), (8, 14), (15, 17), (0, 0)]
    df = spark.createDataFrame([(offsets, spans_of([(0, 7, "Gene"), (15, 17, "Disease")]), [-100, 1, 2, 0, 3, -100], [-100, 2, 4, 0, 4, -100])], f"o {token}, s {S.SPANS}, t array<int>, u array<int>")
    row = df.select(SP.token_tags(F.col("o"), F.col("s")), SP.decode_tags(F.col("o"), F.col("t"), F.lit("APOE e4 raises AD")), SP.decode_tags(F.col("o"), F.col("u"), F.lit("APOE e4 raises AD"))).first()
    assert row[0] == [-100, 1, 2, 0, 3, -100]
    assert [tuple(x) for x in row[1]] == [(0, 7, "Gene", "APOE e4"), (15, 17, "Disease", "AD")]
    assert [tuple(x) for x in row[2]] == [(0, 4, "Gene", "APOE"), (5, 7, "Disease", "e4"), (15, 17, "Disease", "AD")]
    with pytest.raises(Exception, match="as many tags"):
        df.select(SP.decode_tags(F.col("o"), F.array(F.lit(1)), F.lit(""))).collect()


def test_candidate_pairs_and_marks(spark):
    kind = "array<struct<start:int,end:int,label:string,key:string>>"
    rows = [(0, 2, "Disease", "D1"), (5, 7, "Gene", "G1"), (10, 12, "Gene", "G1"), (15, 17, "Gene", "G2"), (20, 22, "Chemical", "C1")]
    df = spark.createDataFrame([(rows,)], f"m {kind}")
    assert [(p.head.key, p.tail.key) for p in df.select(SP.candidate_pairs(F.col("m"))).first()[0]] == [("G1", "C1"), ("G1", "D1"), ("G2", "C1"), ("G2", "D1"), ("C1", "D1")]
    span = lambda a, b: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"))
    text = F.lit("APOE raises AD risk")
    one = spark.range(1).select(SP.mark_entities(text, span(0, 4), span(12, 14)), SP.mark_entities(text, span(12, 14), span(0, 4)), SP.mark_entities(F.lit("AAAABBBB"), span(4, 8), span(0, 4))).first()
    assert tuple(one) == ("[E1] APOE [/E1] raises [E2] AD [/E2] risk", "[E2] APOE [/E2] raises [E1] AD [/E1] risk", "[E2] AAAA [/E2][E1] BBBB [/E1]")
    with pytest.raises(Exception, match="overlap"):
        spark.range(1).select(SP.mark_entities(text, span(0, 4), span(2, 6))).collect()


def test_token_tags_work_their_spans_out_once(spark):
    df = spark.sql("SELECT array(struct(0 AS start, 4 AS end), struct(5 AS start, 7 AS end)) AS o, array(1, 2) AS t")
    spans = F.when(F.col("t") != F.array(F.lit(12345)), SP.decode_tags(F.col("o"), F.col("t"), F.lit("APOE e4")))
    tagged = df.select(SP.token_tags(F.col("o"), spans).alias("tags"))
    assert tagged.first()[0] == [1, 2]
    assert tagged._jdf.queryExecution().analyzed().toString().count("12345") == 1
