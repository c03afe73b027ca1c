"""Every query of the catalog against its SQL, over the smallest tables."""

import math
import os
from pathlib import Path

import pytest

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

from quillweave import catalog  # noqa: E402

#: Compared with a scan, golden sentences and golden extractions in other tests.
WITHOUT_SQL = {"abbreviations", "article_sentences", "extract_relations"}

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no tables")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.5f}".replace("-0.00000", "0.00000")
    return str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name not in catalog.SQL:
        assert rows and name in WITHOUT_SQL
        return
    want = duck.sql(catalog.SQL[name])
    assert sorted(want.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert rows == sorted(tuple(map(plain, r)) for r in duck.sql(f"SELECT {quoted} FROM ({catalog.SQL[name]})").fetchall())


def test_every_order_is_upserted(spark):
    got = catalog.QUERIES["upsert_documents"](spark, DATA)
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    assert sorted(r[0] for r in got.select("pmid").collect()) == sorted(str(r[0]) for r in orders.select("o_orderkey").collect())
    assert {(r.query_label, r.extracted) for r in got.select("query_label", "extracted").distinct().collect()} == {("first", True), ("second", False)}
    years = {r.query_label: {x.year for x in got.where(got.query_label == r.query_label).select("year").distinct().collect()} for r in got.select("query_label").distinct().collect()}
    assert {1997, 2000, 2001} <= years["first"] and min(years["second"]) == 2002


def test_every_word_has_its_key(spark, tmp_path):
    rows = [(1, "Größe NIÑO; niño's über", "de"), (2, "The café, CAFÉ 42 caf\u0065\u0301", "en"), (3, None, "fr"), (4, "α-Żółw l'été", None), (5, "12 !", "es")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.word: r.key for r in catalog.QUERIES["word_keys"](spark, str(tmp_path)).collect()}
    assert got == {
        "Größe": "e gro", "NIÑO": "nino", "niño": "nino", "s": "s", "über": "uber", "The": "the", "café": "cafe", "CAFÉ": "cafe", "caf\u0065\u0301": "cafe",
        "α": "alpha", "Żółw": "w zo", "l": "l", "été": "ete",
    }


def test_articles_of_any_text_are_those_of_sql(spark, tmp_path, duck):
    """Blank and null texts, and signs that XML lacks or that the reader takes for blanks."""
    signs = [chr(c) for c in [*range(160), 0x1680, *range(0x2000, 0x2030), 0x205F, 0x3000, 0xFFFE, 0xFFFF, 0x1F600]]
    texts = ["", " ", "&&", "<>& \n", None, "a  b &\n c", "\u3000", " \xa0 x\u2003y \u2028", *(f"{c} x{c}{c}y {c}" for c in signs)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(900 + i, "x", v, w) for i, (v, w) in enumerate([("", None), (None, ""), (" a  b", "<&>"), ("a,b", "x\ny\x01\x0c\x00\xa0")])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    sql = catalog.SQL["parse_articles"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    got, want = catalog.QUERIES["parse_articles"](spark, str(tmp_path)), duck.sql(sql)
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_entry_imports():
    import subprocess
    import sys

    alone = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=Path(__file__).parent.parent, capture_output=True, text=True)
    assert alone.returncode == 0, alone.stderr
    import __spark_entry__ as e

    assert "neighbors" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
