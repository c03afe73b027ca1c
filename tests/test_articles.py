"""Files of articles cut into ranges, wherever those fall."""

import gzip

import pytest

from quillweave.sources import pubmed

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE PubmedArticleSet PUBLIC "-//x" "y.dtd">\n<PubmedArticleSet>\n'


def record(i):
    return f'<PubmedArticle Status="x"><MedlineCitation><PMID>{i}</PMID><Article><ArticleTitle>é {"t" * (i % 37)} <i>{i}</i></ArticleTitle><Language>eng</Language></Article></MedlineCitation></PubmedArticle>\n'


def document(n, start=1):
    return HEAD + "".join(record(i) for i in range(start, start + n)) + "<PubmedBookArticle><PMID>5</PMID></PubmedBookArticle></PubmedArticleSet>\n"


@pytest.fixture
def ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    yield lambda size: [spark.conf.set(names[0], str(size)), spark.conf.set(names[1], "1"), spark.conf.set(names[2], "1")]
    for n in names:
        spark.conf.unset(n)


@pytest.mark.parametrize("size", [97, 211, 256, 1000, 10**9])
def test_each_record_once_wherever_ranges_fall(spark, tmp_path, ranges, size):
    (tmp_path / "a.xml").write_text(document(40))
    ranges(size)
    got = pubmed.read(spark, str(tmp_path))
    assert (got.rdd.getNumPartitions() > 5) == (size < 1000 + 1)
    assert sorted((int(r.pmid), r.title) for r in got.collect()) == sorted((i, f"é {'t' * (i % 37)} {i}".replace("é  ", "é ")) for i in range(1, 41))
    assert pubmed.unclosed(spark, str(tmp_path)).count() == 0


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, ranges):
    n = 100_000
    (tmp_path / "a.xml").write_text(document(n))
    ranges(1 << 20)
    got = pubmed.read(spark, str(tmp_path)).select("pmid")
    assert got.rdd.getNumPartitions() >= 15 and got.count() == n == got.distinct().count()


def test_compressed_files_are_read_whole(spark, tmp_path, ranges):
    for k in range(2):
        with gzip.open(tmp_path / f"{k}.xml.gz", "wt") as f:
            f.write(document(30, 1 + 30 * k))
    ranges(100)
    got = pubmed.read(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() == 2 and sorted(int(r.pmid) for r in got.collect()) == list(range(1, 61))


def test_the_same_as_reading_files_whole(spark, tmp_path):
    (tmp_path / "a.xml").write_text(document(7))
    (tmp_path / "b.xml").write_text("<PubmedArticleSet/>")
    (tmp_path / "c.xml").write_text(HEAD + record(50).replace("</PubmedArticle>", "</PubmedArticle >") + record(51) + "</PubmedArticleSet>")
    one, two = (sorted(map(repr, pubmed.read(spark, str(tmp_path), whole).collect())) for whole in (False, True))
    assert one == two and len(one) == 9


@pytest.mark.parametrize("text", [HEAD + record(1) + "<PubmedArticle><MedlineCitation><PMID>2", HEAD + record(1).replace("</Article>", ""), HEAD.replace('"y.dtd"', '"y.dtd" [<!ENTITY e "boom">]') + record(1).replace("é", "&e;") + "</PubmedArticleSet>"])
def test_broken_records_are_errors(spark, tmp_path, text):
    (tmp_path / "a.xml").write_text(text)
    with pytest.raises(Exception, match="well-formed|not allowed"):
        pubmed.read(spark, str(tmp_path)).collect()


def test_a_file_cut_between_records_is_listed(spark, tmp_path):
    (tmp_path / "cut.xml").write_text(HEAD + record(1) + record(2))
    (tmp_path / "good.xml").write_text(document(2))
    assert [r.file.rsplit("/", 1)[1] for r in pubmed.unclosed(spark, str(tmp_path)).collect()] == ["cut.xml"]
