"""Vocabularies of genes, diseases and chemicals as rows of schemas.LEXICON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillweave import schemas as S

# Columns of the files, and priorities of names (0), synonyms (1) and aliases (2).
GENE_COLUMNS = ("hgnc_id", "symbol", "name", "alias_symbol", "alias_name", "prev_symbol", "entrez_id")
GENE_LISTS = (("prev_symbol", 1), ("alias_symbol", 2), ("alias_name", 2), ("prev_name", 2))
SYNONYM_COLUMNS = ("Synonyms", "MESHSynonyms", "CTDCuratedSynonyms")
GENE_FILE, DISEASE_FILE, CHEMICAL_FILE = "hgnc_complete_set.txt", "CTD_diseases.tsv.gz", "CTD_chemicals.tsv.gz"
#: Surfaces of a record that its ordinal leaves room for.
ROOM = 1 << 20


class LexiconError(ValueError):
    """A vocabulary file lacks its columns."""


def _listed(cell: Column) -> Column:
    """The items of a cell: quotes around it dropped, parted by '|', blanks trimmed, empty ones left out."""
    bare = F.regexp_replace(F.trim(cell), '^"+|"+$', "")
    return F.filter(F.transform(F.split(bare, r"\|"), lambda v: F.trim(v)), lambda v: v != "")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, value): the lines with a number that grows with their place. Compressed and small files are read as one
    partition, larger ones keep the order of their splits."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("n"), "value")


def _entries(rows: DataFrame, kind: str, entity: Column, name: Column, surfaces: Column) -> DataFrame:
    """One row per struct<surface,priority> of an array, numbered by line and place."""
    flat = rows.select(entity.alias("entity_id"), name.alias("name"), "n", F.posexplode(surfaces).alias("k", "s"))
    return flat.select(F.lit(kind).alias("type"), "s.surface", "entity_id", "name", "s.priority", (F.col("n") * ROOM + F.col("k")).alias("ordinal"))


def _surface(surface: Column, priority: int) -> Column:
    return F.struct(surface.alias("surface"), F.lit(priority).alias("priority"))


def _surfaces(cell: Column, priority: int) -> Column:
    return F.transform(_listed(cell), lambda v: _surface(v, priority))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """Symbols and names of genes, then former symbols, then aliases. The id is the NCBI one where there is one."""
    lines = _lines(spark, path)
    head = spark.read.text(path).first()
    header = (head["value"] if head else "").split("\t")
    if missing := [c for c in GENE_COLUMNS if c not in header]:
        raise LexiconError(f"the gene file lacks {', '.join(missing)}")
    f = F.split("value", "\t")
    cell = lambda c: F.coalesce(F.get(f, F.lit(header.index(c))), F.lit(""))
    entrez = F.trim(cell("entrez_id"))
    entity = F.when(entrez != "", F.concat(F.lit("NCBIGene:"), entrez)).otherwise(cell("hgnc_id"))
    lists = [_surfaces(cell(c), p) for c, p in GENE_LISTS if c in header]
    first = F.array(_surface(cell("symbol"), 0), _surface(cell("name"), 0))
    return _entries(lines.where(F.col("value") != "\t".join(header)), S.GENE, entity, cell("symbol"), F.concat(first, *lists))


def read_ctd(spark: SparkSession, path: str, kind: str, id_column: str, name_column: str) -> DataFrame:
    """Names of records, then their synonyms. The header is the comment line after `# Fields:`."""
    header, before = None, ""
    for row in spark.read.text(path).where(F.col("value").startswith("#")).take(500):
        if before.strip() == "# Fields:":
            header = row["value"].lstrip("#").strip().split("\t")
            break
        before = row["value"]
    if header is None:
        raise LexiconError("the file names no fields")
    synonyms = [c for c in SYNONYM_COLUMNS if c in header]
    if id_column not in header or name_column not in header or not synonyms:
        raise LexiconError(f"the file needs {id_column}, {name_column} and synonyms")
    f = F.split("value", "\t")
    cell = lambda c: F.coalesce(F.get(f, F.lit(header.index(c))), F.lit(""))
    rows = _lines(spark, path).where(~F.col("value").startswith("#"))
    lists = [_surfaces(cell(c), 1) for c in synonyms]
    return _entries(rows, kind, cell(id_column), cell(name_column), F.concat(F.array(_surface(cell(name_column), 0)), *lists))


def read_all(spark: SparkSession, folder: str) -> DataFrame:
    """The three vocabularies of a folder; a missing file is an error."""
    folder = folder.rstrip("/")
    return (
        read_genes(spark, f"{folder}/{GENE_FILE}")
        .unionByName(read_ctd(spark, f"{folder}/{DISEASE_FILE}", S.DISEASE, "DiseaseID", "DiseaseName"))
        .unionByName(read_ctd(spark, f"{folder}/{CHEMICAL_FILE}", S.CHEMICAL, "ChemicalID", "ChemicalName"))
    )
