"""What a landed file must look like, decided by its name."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class SchemaDrift(ValueError):
    """A landed file breaks its contract. ``problems`` holds every case as a frame, where there are any to hold."""

    def __init__(self, message: str, problems: DataFrame | None = None):
        super().__init__(message)
        self.problems = problems


#: Cases that a message spells out; all of them are in the frame beside it.
SPELLED_OUT = 20


def told(what: str, cases: DataFrame, *columns: str) -> str:
    """A message with the first cases."""
    some = cases.select(*columns).limit(SPELLED_OUT).collect()
    return f"{what}: " + "; ".join(": ".join(map(str, row)) for row in some)


@dataclass(frozen=True)
class FileContract:
    """Delimited files whose whole name matches ``pattern`` hold ``kind`` records with at least the
    ``required`` columns; further columns are kept. ``in_parts``: the files are parts of one table, as tasks write them; a part
    may hold its header alone, and only all landed parts together may not be empty."""

    kind: str
    pattern: str
    required: tuple[str, ...]
    may_be_empty: bool = False
    in_parts: bool = False


@dataclass(frozen=True)
class PageContract:
    """JSON page files: ``required`` keys of each element of ``data``; ``columns`` maps an output cell to the
    accepted spellings of its key, the first present one wins; ``defaults`` fills absent keys. ``in_splits``: a document may be
    larger than a task should hold, and is read by many (at the price of shuffles). ``in_parts``: the files are parts of one
    publication, as tasks write them; a part without a byte has no document, and only not all landed parts may be so."""

    kind: str
    pattern: str
    required: tuple[str, ...]
    columns: tuple[tuple[str, tuple[str, ...]], ...]
    defaults: tuple[tuple[str, str], ...] = ()
    in_splits: bool = False
    in_parts: bool = False


def kind_of(name: Column, contracts: Sequence[FileContract | PageContract]) -> Column:
    """The kind of the first contract that matches the file's own name (below any folders), NULL for files that are
    only kept."""
    name = F.element_at(F.split(name, "/"), -1)
    out = F.lit(None).cast("string")
    for contract in reversed(contracts):
        out = F.when(name.rlike(rf"\A(?:{contract.pattern})\z"), F.lit(contract.kind)).otherwise(out)
    return out
