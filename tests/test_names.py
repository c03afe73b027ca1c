"""Substring search by trigrams against LIKE."""

import pytest
from pyspark.sql import functions as F

from quillweave import schemas as S
from quillweave.operators import names
from quillweave.operators.store import Store

NAMES = ["APOE", "apolipoprotein E", "Crohn Disease", "a_b%c", "ab", "", None, "back\\slash", "É tude", "aaaa", "aaa bbb", "Disease 100%", "ünï"]
TERMS = ["apo", "APO", "o_i", "apo%in", "%ein", "dis%00", "a_b", "ab", "k\\s", "é t", "aaaa", "aaa%bbb", "bbb%aaa", "none", "ünï", "sea%crohn", "%", "100%"]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("names") / "db"), 16)
    store.save(entities=spark.createDataFrame([(f"e{i}", "Gene", n, i % 2 == 0) for i, n in enumerate(NAMES)], S.ENTITIES))
    store.index_names()
    return store


def test_the_same_rows_as_like(store):
    for term in TERMS:
        want = store.table("entities").where(names.like(term)).select(*names.COLUMNS)
        assert sorted(store.search_names(term).collect()) == sorted(want.collect()), term
    with pytest.raises(ValueError):
        store.search_names(" ")


def test_only_index_rows_of_the_term_are_read(store):
    files = {f.split("/data/")[1].split("/")[0] for f in store.search_names("apo%in").inputFiles()}
    assert files == {"name_grams"}
    used = {f.rsplit("/", 2)[1] for f in store.search_names("apo").inputFiles()}
    assert len(used) == 1 < len(store.snapshot().entry("name_grams")["parts"])
    assert names.term_grams("apo%in_disease") == ["apo", "ase", "dis", "eas", "ise", "sea"]
    assert {f.split("/data/")[1].split("/")[0] for f in store.search_names("ab").inputFiles()} == {"entities"}


def test_a_stale_index_is_not_used(store, spark):
    seen = spark.createDataFrame([("new", "Gene", "apollo", True, "0")], S.ENTITIES + ", ordinal string")
    empty = lambda schema: spark.createDataFrame([], schema)
    store.save_extraction(empty("pmid string, nlp_scope string"), empty(S.MENTIONS), empty(S.RELATIONS), seen)
    assert {r.name for r in store.search_names("apo").collect()} == {"APOE", "apolipoprotein E", "apollo"}
    store.index_names()
    got = store.search_names("apo")
    assert {r.name for r in got.collect()} == {"APOE", "apolipoprotein E", "apollo"} and got.select(F.max("entity_id")).first()[0] == "new"
