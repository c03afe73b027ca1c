"""Article records in XML."""

from __future__ import annotations

import re
import xml.parsers.expat
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S

# The years that a date may hold, the language of a record that names none.
YEAR = r"(1[89]\d\d|20\d\d)"
UNDETERMINED = "und"

#: What is read of a record, by path below it.
_CITATION = "PubmedArticle/MedlineCitation/"
_ARTICLE = _CITATION + "Article/"
FIELDS = {
    _CITATION + "PMID": "pmid", _ARTICLE + "ArticleTitle": "title", _ARTICLE + "Abstract/AbstractText": "abstract", _ARTICLE + "Language": "language",
    _ARTICLE + "Journal/Title": "journal", _ARTICLE + "Journal/JournalIssue/PubDate/Year": "issued", _ARTICLE + "Journal/JournalIssue/PubDate/MedlineDate": "season",
    _ARTICLE + "ArticleDate/Year": "dated", _ARTICLE + "VernacularTitle": "vernacular", _CITATION + "OtherAbstract/AbstractText": "other",
}
ROWS = 2000
_SCHEMA = pa.schema(
    [("pmid", pa.string()), ("title", pa.string()), ("abstract", pa.string()), ("year", pa.int32()), ("languages", pa.list_(pa.string())), ("journal", pa.string()), ("vernacular_title", pa.string()),
     ("other_abstracts", pa.list_(pa.struct([("language", pa.string()), ("text", pa.string())])))]
)


class RecordError(ValueError):
    """The file is no well-formed XML, or declares entities of its own."""


def parse_year(date: Column) -> Column:
    """The first plausible year in a date's text, or null."""
    return F.nullif(F.regexp_extract(date, YEAR, 1), F.lit("")).cast("int")


class Reader:
    """Takes the events of one parse. While an element of FIELDS is open, all text goes to it, that of elements inside too;
    when it closes, its text (white space as single blanks) and label join the record's values of that field."""

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.path, self.depth = [], 0
        self.found: defaultdict[str, list] = defaultdict(list)
        self.field, self.text, self.label, self.tongue, self.nth = None, [], None, UNDETERMINED, 0

    def opened(self, tag: str, given: dict[str, str]) -> None:
        if tag == "PubmedArticle":
            self.path, self.found = [], defaultdict(list)
        self.path.append(tag)
        place = "/".join(self.path)
        if place == _ARTICLE[:-1]:
            self.found["article"].append(True)
        if tag == "OtherAbstract":
            self.tongue, self.nth = given.get("Language", UNDETERMINED), self.nth + 1
        if self.field is None and place in FIELDS:
            self.field, self.depth, self.text, self.label = FIELDS[place], len(self.path), [], given.get("Label")

    def said(self, text: str) -> None:
        if self.field is not None:
            self.text.append(text)

    def closed(self, tag: str) -> None:
        if self.field is not None and len(self.path) == self.depth:
            body = " ".join("".join(self.text).split())
            labelled = f"{self.label}: {body}" if self.label and body else body
            self.found[self.field].append((self.nth, self.tongue, labelled) if self.field == "other" else labelled if self.field == "abstract" else body)
            self.field = None
        if self.path:
            self.path.pop()
        if tag == "PubmedArticle":
            self.record()

    def record(self) -> None:
        """A record without citation, number or article, or whose number isn't digits, is left out."""
        first = {k: v[0] for k, v in self.found.items()}
        if not first.get("article") or not first.get("pmid", "").isdigit():
            return
        year_in = lambda text: next((int(y) for y in re.findall(YEAR, text or "")), None)
        years = [year_in(first.get("issued")) or year_in(first.get("season")), *map(year_in, self.found["dated"])]
        others: dict[int, dict[str, str]] = {}
        for nth, tongue, part in self.found["other"]:
            if part:
                others.setdefault(nth, {"language": tongue, "text": ""})["text"] += f" {part}"
        bracketed = re.fullmatch(r"\[(.*?)\]+\.?", first.get("title", ""), re.S)  # a translated title stands in brackets
        self.rows.append({
            "pmid": first["pmid"], "title": f"{bracketed[1]}." if bracketed else first.get("title", ""), "abstract": " ".join(filter(None, self.found["abstract"])),
            "year": min(filter(None, years), default=None), "languages": [x for x in self.found["language"] if x] or [UNDETERMINED], "journal": first.get("journal", ""),
            "vernacular_title": first.get("vernacular", ""), "other_abstracts": [o | {"text": o["text"].strip()} for o in others.values()],
        })


def records(xml_text: str) -> list[dict]:
    """The articles of a file, in one pass."""

    def refuse(*_):
        raise RecordError("entity declarations are not allowed")

    reader, parser = Reader(), xml.parsers.expat.ParserCreate("utf-8")
    parser.buffer_text = True
    parser.EntityDeclHandler, parser.StartElementHandler, parser.CharacterDataHandler, parser.EndElementHandler = refuse, reader.opened, reader.said, reader.closed
    try:
        parser.Parse(xml_text.lstrip().encode("utf-8"), True)
    except xml.parsers.expat.ExpatError as e:
        raise RecordError(f"not well-formed: {e}") from e
    return reader.rows


def parse(files: DataFrame) -> DataFrame:
    """Articles (schemas.ARTICLES) of files (value), one file a row; a broken file is an error. The XML source of the
    engine loses the order of mixed content, so the standard library parses, a file at a time, within the executors."""
    return files.select("value").mapInArrow(lambda batches: _articles(batches, records), S.ARTICLES)


def _articles(batches: Iterator[pa.RecordBatch], read_rows: Callable[[str], list[dict]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[dict] = []
        for text in batch.column(0).to_pylist():
            rows += read_rows(text or "")
            if len(rows) >= ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


RECORD_END, SET_END = "</PubmedArticle>", "</PubmedArticleSet>"
_RECORD = re.compile(r"<PubmedArticle(?=[\s>/])")


def piece_records(piece: str) -> list[dict]:
    """The articles of what stands before one end of a record, and after the one before."""
    begin = _RECORD.search(piece)
    before = piece[: begin.start()] if begin else piece
    if "<!ENTITY" in before:
        raise RecordError("entity declarations are not allowed")
    return records(f"<PubmedArticleSet>{piece[begin.start() :]}{RECORD_END}{SET_END}") if begin else []


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): files cut at the ends of records. Ranges of a large file are read by different tasks; a piece belongs to the range it
    begins in, wherever the ranges fall. Files that are compressed as a whole are read by one task each, a piece at a time."""
    return spark.read.text(path, lineSep=RECORD_END).select(F.col("_metadata.file_path").alias("file"), "value")


def read(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Articles of files in UTF-8. A record that is broken or breaks off is an error; a file that ends after a record without closing the set
    isn't noticed here, see `unclosed`. `whole` reads each file as one document instead, for files whose comments or CDATA
    sections hold ends of records."""
    if whole:
        return parse(spark.read.text(path, wholetext=True))
    return pieces(spark, path).select("value").mapInArrow(lambda batches: _articles(batches, piece_records), S.ARTICLES)


def unclosed(spark: SparkSession, path: str) -> DataFrame:
    """(file): files that hold a record and don't close the set: what was lost in a transfer."""
    closed = F.col("value").contains(SET_END).cast("int")
    return pieces(spark, path).groupBy("file").agg(F.max(closed).alias("closed")).where(F.col("closed") == 0).select("file")
