"""Text clean-up, masking and templates."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def title(column: Column) -> Column:
    return F.initcap(F.trim(column))


def full_name() -> Column:
    return F.concat_ws(" ", F.col("first_name"), F.col("last_name"))


def mask_tail(column: Column, keep: int = 4) -> Column:
    """Everything but the last characters hidden."""
    return F.concat(F.lit("***"), F.right(column, F.lit(keep)))


def _pieces(template: str) -> list[tuple[str, str | None]]:
    return [(text, name) for text, name, _, _ in Formatter().parse(template)]


def fill(template: str, parts: Mapping[str, Column]) -> Column:
    """Template with columns put in; one NULL part makes the whole text NULL."""
    columns: list[Column] = []
    for text, name in _pieces(template):
        if text:
            columns.append(F.lit(text))
        if name:
            columns.append(parts[name])
    return F.concat(*columns)


def fill_skipping_nulls(template: str, parts: Mapping[str, Column]) -> Column:
    """Template whose NULL parts vanish together with one blank."""
    columns: list[Column] = []
    for text, name in _pieces(template):
        if text.strip():
            columns.append(F.lit(text.strip()))
        if name:
            columns.append(parts[name])
    return F.concat_ws(" ", *columns)
