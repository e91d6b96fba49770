"""Rule ladders: ordered (condition, value) steps compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _value(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def ladder(steps: Iterable[tuple[Column, Any]], otherwise: Any) -> Column:
    """The value of the first step whose condition is true; NULL conditions do not match."""
    first, *rest = steps
    chain = reduce(
        lambda built, step: built.when(step[0], _value(step[1])),
        rest,
        F.when(first[0], _value(first[1])),
    )
    return chain.otherwise(_value(otherwise))


def above(column: Column, steps: Iterable[tuple[float, Any]], otherwise: Any) -> Column:
    return ladder(((column > limit, value) for limit, value in steps), otherwise)


def at_least(column: Column, steps: Iterable[tuple[float, Any]], otherwise: Any) -> Column:
    return ladder(((column >= limit, value) for limit, value in steps), otherwise)


def at_most(column: Column, steps: Iterable[tuple[float, Any]], otherwise: Any) -> Column:
    return ladder(((column <= limit, value) for limit, value in steps), otherwise)


def lookup(column: Column, table: Mapping[Any, Any], otherwise: Any = None) -> Column:
    return ladder(((column == key, value) for key, value in table.items()), otherwise)
