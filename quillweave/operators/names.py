"""Substring search over entity names by an inverted index of their trigrams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 3
COLUMNS = ("entity_id", "type", "name", "matched")


def gram_rows(entities: DataFrame) -> DataFrame:
    """(gram, entity_id, type, name, matched): each name under each run of three characters of its lower case. Names that are shorter or
    null have no rows."""
    low = F.lower("name")
    grams = F.transform(F.sequence(F.lit(1), F.length(low) - SIZE + 1), lambda i: F.substring(low, i, F.lit(SIZE)))
    return entities.where(F.length(low) >= SIZE).select(F.explode(F.array_distinct(grams)).alias("gram"), *COLUMNS)


def like(term: str):
    """Whether a name in any case is LIKE %term%: `%` and `_` are wildcards, a backslash is itself."""
    return F.like(F.lower("name"), F.lower(F.lit("%" + term.replace("\\", "\\\\") + "%")))


def term_grams(low: str) -> list[str]:
    """The trigrams that a name must have to match a term in lower case: those of what stands between its wildcards."""
    return sorted({run[i : i + SIZE] for run in re.split("[%_]", low) for i in range(len(run) - SIZE + 1)})


def search(index: DataFrame, term: str, grams: list[str]) -> DataFrame:
    """The names of the index that match a term: those in the posting lists of all its grams, each looked at in the end."""
    hits = index.where(F.col("gram").isin(*grams)).groupBy(*COLUMNS).agg(F.count_distinct("gram").alias("n"))
    return hits.where((F.col("n") == len(grams)) & like(term)).select(*COLUMNS)
