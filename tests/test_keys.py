"""Keys in the JVM against the same rules in Python, for every character and for names of them."""

import random
import sys

from pyspark.sql import functions as F

from quillweave.functions.keys import lookup_keys, normalize_key, spelled


def differ(spark, names, size):
    got = spark.createDataFrame([(n,) for n in names], "n string").repartition(size).select("n", normalize_key(F.col("n")).alias("k")).collect()
    return [(r.n, r.k, spelled(r.n)) for r in got if r.k != spelled(r.n)]


def test_every_character(spark):
    """Each alone, between letters, and after a possessive: forty to a name, so that each stands in several surroundings."""
    every = [chr(n) for n in range(sys.maxunicode + 1) if not 0xD800 <= n < 0xE000]
    names = ["".join(f"a{c}b's{c} " for c in every[i : i + 40]) for i in range(0, len(every), 40)]
    assert differ(spark, names, 8) == []


def test_random_names(spark):
    draw = random.Random(2)
    odd = ["α", "Β", "ς", "İ", "ß", "ﬁ", "½", "Ⅷ", "é", "é", "ñ", "µ", "'s", "’S", "`s", "_", "日", "🧬", " ", "-", "A", "s", "‍", "ﷺ"]
    names = ["".join(draw.choice(odd) for _ in range(draw.randrange(12))) for _ in range(3000)]
    assert differ(spark, names, 4) == []


def test_no_python_in_the_plan(spark, capsys):
    df = spark.createDataFrame([("α-synuclein",), (None,), ("",)], "n string").select(lookup_keys(F.col("n")).alias("k"))
    df.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
    assert [r.k for r in df.collect()] == [["alpha synuclein"], [""], [""]]
