"""Typing of text records by a column specification; a failed cast is NULL, never an error."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions.text import MISSING_MARKERS, is_missing


@dataclass(frozen=True)
class Text:
    """Take the text under ``key`` (default: the name itself)."""

    name: str
    key: str | None = None
    trim: bool = True


@dataclass(frozen=True)
class Cast:
    """Safe cast of an earlier column."""

    name: str
    of: str
    to: str


@dataclass(frozen=True)
class Missing:
    """Flag an earlier text column that holds no value."""

    name: str
    of: str
    markers: tuple[str, ...] = MISSING_MARKERS


def from_map(column: str = "fields") -> Callable[[str], Column]:
    """Cells live in a MAP<STRING,STRING>; an absent key is NULL."""
    return lambda key: F.col(column)[key]


def from_json(column: str) -> Callable[[str], Column]:
    """Cells live in a JSON object held as text, which is parsed once to a map; keys may hold any character."""
    cells = F.from_json(F.col(column), "MAP<STRING, STRING>")
    return lambda key: cells[key]


def from_columns() -> Callable[[str], Column]:
    """Cells are ordinary columns."""
    return lambda key: F.col(key).cast("string")


def conform(
    df: DataFrame,
    spec: Sequence[Text | Cast | Missing],
    cell: Callable[[str], Column] = from_map(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Apply ``spec`` in order; a Cast may replace the text column it reads."""
    texts = [s for s in spec if isinstance(s, Text)]
    out = df.select(
        *keep,
        *[(F.trim(cell(t.key or t.name)) if t.trim else cell(t.key or t.name)).alias(t.name) for t in texts],
    )
    for step in spec:
        if isinstance(step, Cast):
            out = out.withColumn(step.name, F.col(step.of).try_cast(step.to))
        elif isinstance(step, Missing):
            out = out.withColumn(step.name, is_missing(F.col(step.of), step.markers))
    return out
