"""Helpers on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that are summed by one fold; more are done in steps, so that no list is copied once per element.
STEP = 256


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once: what a lambda refers to from outside is worked out for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_starts(lengths: Column) -> Column:
    """For an array of lengths, the sum of those before each element (array<int>)."""
    return let(lengths, _starts)


def _starts(lengths: Column) -> Column:
    steps = F.sequence(F.lit(0), F.floor(F.greatest(F.size(lengths) - 1, F.lit(0)) / STEP).cast("int"))
    chunk = lambda i: F.slice(lengths, i * STEP + 1, STEP)
    nothing = F.array().cast("array<int>")

    def fold(values: Column, base: Column) -> Column:
        zero = F.struct(base.cast("int").alias("at"), nothing.alias("out"))
        return F.aggregate(values, zero, lambda acc, n: F.struct((acc["at"] + n).cast("int").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    sums = F.transform(steps, lambda i: F.aggregate(chunk(i), F.lit(0), lambda a, n: (a + n).cast("int")))
    return let(fold(sums, F.lit(0)), lambda bases: F.flatten(F.transform(steps, lambda i: fold(chunk(i), F.element_at(bases, i + 1)))))
