"""Running sums, minima and maxima over arrays, with DataFrame functions only.

A fold that appends to its list copies the list for each element. Here arrays are folded in
blocks of `BLOCK` elements, so that the copies of an element are bounded by the block, and only
the blocks' totals are folded over the whole array: time is in proportion to the array up to
tens of millions of elements.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
Step = Callable[[Column, Column], Column]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, start: Column, step: Step, kind: str) -> Column:
    """For each element what `step` makes of `start` and all elements before it (of type `kind`).
    `step` must be associative, and `start` its neutral element."""
    none = F.array().cast(f"array<{kind}>")

    def fold(some: Column, first: Column) -> Column:
        walked = F.aggregate(some, F.struct(first.cast(kind).alias("at"), none.alias("out")), lambda a, v: F.struct(step(a["at"], v).cast(kind).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))
        return walked["out"]

    def blocked(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, fold(F.transform(bs, lambda b: F.aggregate(b, start.cast(kind), lambda a, v: step(a, v).cast(kind))), start), fold)))

    return let(values, lambda v: F.when(F.size(v) > 0, blocked(v)).otherwise(none))


def sums_before(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, v: a + v, "bigint")
