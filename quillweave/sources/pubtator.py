"""Annotated corpora in PubTator format: blocks of a title, an abstract, entities and relations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.functions.spans import in_scope


@dataclass
class Corpus:
    """documents (pmid, title, abstract), entities (pmid, ordinal, start, end, text, label, ids) and relations (pmid,
    ordinal, id1, id2, label); blocks (pmid, title, abstract, rows) is all of it, a document a row, for what needs no more than one."""

    documents: DataFrame
    entities: DataFrame
    relations: DataFrame
    blocks: DataFrame


def _check(ok: Column, value: Column, message: Column, kind: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(message).cast(kind))


def _mapped(column: Column, names: dict[str, str]) -> Column:
    out = None
    for raw, name in names.items():
        out = F.when(column == raw, name) if out is None else out.when(column == raw, name)
    return out


def parse(files: DataFrame) -> Corpus:
    """The corpus of files (value), one file a row; other types are left out. A block without title and abstract lines, a
    line of neither 6 nor 5 fields, or a surface that isn't at its offsets is an error, raised when rows are made.

    A relation stays if its type is known, both ids are those of entities of the document, and the pair of types (of the
    last entity with the id) is in scope.
    """
    blocks = files.select(F.explode(F.split("value", r"\n(?U)\s*\n")).alias("block")).where(F.col("block").rlike(r"(?U)\S"))
    lines = F.split(F.regexp_replace("block", r"^\n+|\n+$", ""), "\n")
    cut = lambda i, mark, k: F.get(F.split(F.get(F.col("lines"), F.lit(i)), rf"\|{mark}\|", 2), F.lit(k))
    good = (F.size("lines") >= 2) & F.get(F.col("lines"), F.lit(0)).contains("|t|") & F.coalesce(F.get(F.col("lines"), F.lit(1)), F.lit("")).contains("|a|")
    odd = F.filter(F.slice("lines", 3, F.greatest(F.size("lines"), F.lit(1))), lambda r: ~F.size(F.split(r, "\t")).isin(5, 6))
    rows = _check(F.size(odd) == 0, F.slice("lines", 3, F.greatest(F.size("lines"), F.lit(1))), F.concat(F.lit("malformed line: "), F.substring(F.get(odd, F.lit(0)), 1, 80)), "array<string>")
    heads = blocks.select(lines.alias("lines")).select(
        _check(good, cut(0, "t", 0), F.lit("a block must begin with |t| and |a| lines"), "string").alias("pmid"), cut(0, "t", 1).alias("title"), cut(1, "a", 1).alias("abstract"), rows.alias("rows")
    )
    fields = heads.select("pmid", F.concat("title", F.lit(" "), "abstract").alias("text"), F.posexplode("rows").alias("ordinal", "row")).select("*", F.split("row", "\t").alias("f"))
    size = F.size("f")
    at = lambda i: F.get("f", F.lit(i))
    start, end, surface = F.try_to_number(at(1), F.lit("999999999")).cast("int"), F.try_to_number(at(2), F.lit("999999999")).cast("int"), at(3)
    label = _mapped(at(4), S.CORPUS_ENTITY_TYPES)
    raw = fields.where(size == 6).select("pmid", "ordinal", start.alias("start"), end.alias("end"), surface.alias("text"), label.alias("label"), F.filter(F.split(at(5), ","), lambda i: ~i.isin("", "-")).alias("ids"), F.col("text").alias("whole")).where(F.col("label").isNotNull())
    there = F.substring("whole", F.col("start") + 1, F.col("end") - F.col("start"))
    entities = raw.select("pmid", "ordinal", "start", "end", _check(there == F.col("text"), F.col("text"), F.concat(F.lit("not at its offsets: "), "text"), "string").alias("text"), "label", "ids")
    types = entities.select("pmid", "ordinal", "label", F.explode("ids").alias("id")).groupBy("pmid", "id").agg(F.max_by("label", "ordinal").alias("type"))
    known = lambda k: types.select("pmid", F.col("id").alias(f"id{k}"), F.col("type").alias(f"type{k}"))
    named = fields.where(size == 5).select("pmid", "ordinal", at(2).alias("id1"), at(3).alias("id2"), _mapped(at(1), S.CORPUS_RELATION_TYPES).alias("label")).where(F.col("label").isNotNull())
    relations = named.join(known(1), ["pmid", "id1"]).join(known(2), ["pmid", "id2"]).where(in_scope(F.col("type1"), F.col("type2"))).select("pmid", "ordinal", "id1", "id2", "label")
    return Corpus(heads.select("pmid", "title", "abstract"), entities, relations, heads)


@dataclass
class Annotations:
    """entities (start, end, label, key) of a document, one for each id, in order, and relations {pair of ids: label}, the first of each."""

    entities: list[tuple[int, int, str, str]]
    relations: dict[frozenset[str], str]


def annotations(text: str, rows: list[str]) -> Annotations:
    """The annotations in a block's rows, by the rules of `parse`, in time that grows with their number."""
    entities, raw, types = [], [], {}
    for row in rows:
        f = row.split("\t")
        if len(f) == 5:
            raw.append(f)
        elif label := S.CORPUS_ENTITY_TYPES.get(f[4]):
            if not all(n.isascii() and n.isdigit() and len(n) < 10 for n in f[1:3]) or text[int(f[1]) : int(f[2])] != f[3]:
                raise ValueError(f"not at its offsets: {f[3]}")
            for key in f[5].split(","):
                if key not in ("", "-"):
                    entities.append((int(f[1]), int(f[2]), label, key))
                    types[key] = label
    relations: dict[frozenset[str], str] = {}
    for _, kind, a, b, _ in raw:
        if (label := S.CORPUS_RELATION_TYPES.get(kind)) and a in types and b in types and types[a] != types[b]:
            relations.setdefault(frozenset((a, b)), label)
    return Annotations(entities, relations)


_PIECES = "file string, at long, whole boolean, value string"


def _cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Lines (file, at, value), in order within each range `at` of a file, as pieces: with `whole` what stands between two blank lines of a
    range, otherwise one row a range, with what stands before its first blank line and after its last one (all, without one)."""
    join = lambda parts: "\n".join(t for p in parts for t in p.to_pylist())
    now, head, open_ = None, None, []  # the range, what stood before its first blank line, lines since the last one

    def edge() -> list[tuple]:
        return [] if whole or now is None else [(*now, False, join(open_) if head is None else f"{head}\n\n{join(open_)}")]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.bool_(), pa.string()), strict=True)], ["file", "at", "whole", "value"])

    for batch in batches:
        files, at, lines = (batch.column(i) for i in range(3))
        places = at.to_numpy()
        moved = np.flatnonzero((places[1:] != places[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)) + 1
        for i, j in zip([0, *moved.tolist()], [*moved.tolist(), len(places)], strict=True):
            if i == j:
                continue
            if now != (here := (files[i].as_py(), int(places[i]))):
                if found := edge():
                    yield rows(found)
                now, head, open_ = here, None, []
            empty = pc.equal(pc.utf8_trim_whitespace(lines[i:j]), "")
            part = pc.if_else(empty, "", lines[i:j])
            blank = np.flatnonzero(empty.to_numpy(zero_copy_only=False))
            if not len(blank):
                open_.append(part)
                continue
            open_.append(part[: blank[0]])
            done = [(*now, True, join(open_))] if whole and head is not None else []
            if head is None:
                head = join(open_)
            if done:
                yield rows(done)
            if whole and len(blank) > 1:
                between = pa.ListArray.from_arrays(pa.array(blank, pa.int32()), part)
                texts = pc.binary_join(between, "\n")
                n = len(texts)
                yield pa.RecordBatch.from_arrays([pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array([True] * n), texts], ["file", "at", "whole", "value"])
            open_ = [part[blank[-1] + 1 :]]
    if found := edge():
        yield rows(found)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(value): files cut at blank lines, so that a task holds a few blocks at a time, however large a file is. Ranges of a file are read by
    different tasks; what reaches over their borders, a few lines a range, is put together by file. Files that are compressed as a whole are read
    by one task each. Ends of lines are those that Python knows."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    inner = lines.mapInArrow(lambda batches: _cut(batches, True), _PIECES).select("value")
    edges = lines.mapInArrow(lambda batches: _cut(batches, False), _PIECES)
    return inner.unionByName(edges.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("e")).select(F.array_join(F.col("e.value"), "\n").alias("value")))


def read(spark: SparkSession, path: str) -> Corpus:
    return parse(pieces(spark, path))


def read_split(spark: SparkSession, split: str, folder: str) -> Corpus:
    S.check_choice(split, S.CORPUS_SPLITS, "split")
    return read(spark, f"{folder.rstrip('/')}/BioRED/{split}.PubTator")


def as_documents(corpus: Corpus) -> DataFrame:
    """Articles without a year."""
    return corpus.documents.select("pmid", "title", "abstract", F.lit(None).cast("int").alias("year"))
