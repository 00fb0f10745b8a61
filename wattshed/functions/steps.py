"""Computations of many steps, each of which reads the one before several times.

Written into one expression, such steps would grow without end. Over a DataFrame each
step is a projection in generated code; within a single column, where there are no
projections, each is bound to a lambda variable, which Spark interprets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ColumnLike, col, let

#: What a step reads: a value of the steps before, by name.
Get = Callable[[str], Column]
Step = dict[str, Callable[[Get], Column]]


#: Steps of one Java method.
TOGETHER = 10


def _read(steps: list[Step], results: set[str]) -> list[str]:
    """The values that steps read, and those that are results."""
    names = set(results)
    for step in steps:
        for make in step.values():
            make(lambda name: names.add(name) or F.col(name))
    return sorted(names)


def staged(df: DataFrame, given: dict[str, ColumnLike], steps: list[Step], results: dict[str, str]) -> DataFrame:
    """df with the results of steps, each step a projection of its own.

    A step reads each value before it several times, so Spark keeps the projections
    apart and computes every value once, in generated code. What it must not do is
    to move a filter on a result below them, or a constant up through them: either
    would write all steps into one expression. Rows generated at both ends stop
    that. Rows are also generated every ``TOGETHER`` steps, with the values that are
    still read: what stands between two such places becomes one Java method, and a
    method of over 8,000 bytes is interpreted and never compiled. results: name of
    the column by name of the value; columns that have the name are replaced.
    """
    names = {f"_g_{k}" for step in [given, *steps] for k in step}
    clash = names & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns are named as the steps' own: {sorted(clash)}")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in results]
    get: Get = lambda name: F.col(f"_g_{name}")
    start = F.struct(*[col(v).alias(f"_g_{k}") for k, v in given.items()])
    df = df.select("*", F.inline(F.array(start)))
    for i, step in enumerate(steps):
        if i and i % TOGETHER == 0:
            live = F.struct(*[get(k) for k in _read(steps[i:], set(results)) if f"_g_{k}" in df.columns])
            df = df.select(*kept, F.inline(F.array(live)))
        df = df.withColumns({f"_g_{k}": make(get) for k, make in step.items()})
    return df.select(*kept, F.inline(F.array(F.struct(*[get(v).alias(c) for c, v in results.items()]))))


def bound(given: dict[str, Column], steps: list[Step], result: Callable[[Column], Column]) -> Column:
    """The same within one column: each step bound to a variable, which Spark interprets."""
    row = F.struct(*[c.alias(k) for k, c in given.items()])
    have = list(given)
    for step in steps:
        have += [k for k in step if k not in have]
        row = let(row, _one_step(step, list(have)))
    return let(row, result)


def _one_step(step: Step, names: list[str]) -> Callable[[Column], Column]:
    def made(row: Column) -> Column:
        get: Get = lambda name: row[name]
        return F.struct(*[(step[k](get) if k in step else row[k]).alias(k) for k in names])

    return made
