"""Array expressions that Spark has no function for: a value made once, running states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value made once however often body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, start: Column, plus: Callable[[Column, Column], Column], kind: str = "int") -> Column:
    """start, and the state after each value: plus(state, value).

    States are collected in blocks of the square root of their number, so that no long array is
    copied for each of them.
    """

    def block(at: Column, part: Column) -> Column:
        first = F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        step = lambda acc, x: let(plus(acc["at"], x).cast(kind), lambda now: F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out")))
        return F.aggregate(part, first, step)

    def over(all_of: Column, n: Column) -> Column:
        first = F.struct(start.cast(kind).alias("at"), F.array(F.array(start.cast(kind))).alias("out"))
        step = lambda acc, i: let(block(acc["at"], F.slice(all_of, i, n)), lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(all_of), F.lit(1)), n), first, step, lambda acc: F.flatten(acc["out"]))

    return let(values, lambda all_of: let(F.greatest(F.ceil(F.sqrt(F.size(all_of))).cast("int"), F.lit(1)), lambda n: over(all_of, n)))
