"""Repeatable pseudo-random draws: a pure function of key, stream name and seed.

Unlike rand(), the value does not depend on how rows are partitioned or retried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from keepwell.functions.ladders import ladder

_HEX_DIGITS = 12
_RANGE = float(16**_HEX_DIGITS)


def digest(key: Column, stream: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(stream), F.lit(str(seed))))


def uniform(key: Column, stream: str, seed: int = 42) -> Column:
    """A double in [0, 1)."""
    head = F.substring(digest(key, stream, seed), 1, _HEX_DIGITS)
    return F.conv(head, 16, 10).cast("double") / F.lit(_RANGE)


def whole(draw: Column, low: int, high: int) -> Column:
    """An integer in [low, high] from a uniform draw."""
    return (F.floor(draw * F.lit(high - low + 1)) + F.lit(low)).cast("int")


def real(draw: Column, low: float, high: float) -> Column:
    return draw * F.lit(high - low) + F.lit(low)


def pick(draw: Column, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), whole(draw, 1, len(values)))


def pick_weighted(draw: Column, weighted: Sequence[tuple[object, float]]) -> Column:
    total = float(sum(weight for _, weight in weighted))
    steps, running = [], 0.0
    for value, weight in weighted[:-1]:
        running += weight
        steps.append((draw < F.lit(running / total), value))
    return ladder(steps, weighted[-1][0])
