"""A data-driven build: named steps, in the order of what they need.

Every step and input has a fingerprint: an input's says which files it has, a
step's follows from its name, its version and the fingerprints of what it needs. A
step whose fingerprint has been written before, by a published run or by one that
failed later on, is not made again. Outputs become visible together, when the last
of them is written.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import commit_run, publish_views, stage_output, staged_outputs

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """``version`` is to be raised when what the step makes of the same inputs changes."""

    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    version: str = "1"


def manifest(steps: list[Step]) -> list[str]:
    """The inputs a build needs from outside, derived from the steps themselves."""
    made = {s.name for s in steps}
    return sorted({n for s in steps for n in s.needs} - made)


def check_inputs(steps: list[Step], inputs: Inputs) -> None:
    missing = [n for n in manifest(steps) if n not in inputs]
    if missing:
        raise LookupError(f"missing inputs: {missing}")


def in_order(steps: list[Step]) -> list[Step]:
    """Each step behind those it needs, otherwise as given; an error if steps need one another."""
    names = [s.name for s in steps]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"steps of one name: {twice}")
    left, done, out = list(steps), set(), []
    made = set(names)
    while left:
        ready = next((s for s in left if all(n in done or n not in made for n in s.needs)), None)
        if ready is None:
            raise ValueError(f"steps that need one another: {sorted(s.name for s in left)}")
        left.remove(ready)
        done.add(ready.name)
        out.append(ready)
    return out


def build(steps: list[Step], inputs: Inputs) -> Inputs:
    """Every step's DataFrame, still lazy."""
    check_inputs(steps, inputs)
    frames = dict(inputs)
    for step in in_order(steps):
        frames[step.name] = step.make(*[frames[n] for n in step.needs])
    return {s.name: frames[s.name] for s in steps}


def input_print(df: DataFrame) -> str:
    """Fingerprint of the files that df reads: their paths, sizes and times, without reading them.

    It follows the files and not what df does with them, so a changed query over the
    same files wants a fingerprint of its own. A table that is not from files never
    looks the same twice.
    """
    files = df.inputFiles()
    if not files:
        return uuid.uuid4().hex
    listed = df.sparkSession.read.format("binaryFile").load(sorted({f.rsplit("/", 1)[0] for f in files}))
    hashed = listed.select(F.xxhash64("path", "length", F.unix_micros("modificationTime")).alias("h"))
    n, both, total = hashed.agg(F.count("h"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"{n}-{both}-{total}"


def prints_of(steps: list[Step], given: dict[str, str]) -> dict[str, str]:
    """Fingerprint of each step from those of the inputs."""
    known = dict(given)
    for step in in_order(steps):
        parts = [step.name, step.version, *[known[n] for n in step.needs]]
        known[step.name] = hashlib.sha256("\0".join(parts).encode()).hexdigest()
    return {s.name: known[s.name] for s in steps}


def run(
    spark: SparkSession, steps: list[Step], inputs: Inputs, root: str, prints: dict[str, str] | None = None
) -> str:
    """Build what has changed, publish all tables together, then refresh their views.

    A step reads what earlier steps have written, so nothing is computed twice and no
    plan grows with the number of steps. ``prints`` names fingerprints of inputs
    that the caller knows; others are taken from the files. A failing step publishes
    nothing, and the next run takes up the steps that were whole by then.
    """
    check_inputs(steps, inputs)
    given = {n: (prints or {}).get(n) or input_print(inputs[n]) for n in manifest(steps)}
    mine = prints_of(steps, given)
    have = staged_outputs(spark, root)
    run_id = uuid.uuid4().hex
    frames, paths = dict(inputs), {}
    for step in in_order(steps):
        if mine[step.name] in have:
            paths[step.name] = have[mine[step.name]]
            frames[step.name] = spark.read.parquet(paths[step.name])
        else:
            made = step.make(*[frames[n] for n in step.needs])
            frames[step.name] = stage_output(made, root, run_id, step.name, mine[step.name])
    names = [s.name for s in steps]
    commit_run(spark, root, run_id, names, paths, mine)
    publish_views(spark, root, names)
    return run_id
