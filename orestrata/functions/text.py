"""Column expressions for text cells: trimming, missing markers, labels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space characters of Unicode and the four ASCII separators.
WHITESPACE = (
    " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of "no value" in the source files.
MISSING_MARKERS = ("", "-")


def strip(cell: Column) -> Column:
    """Trim every kind of white space (``trim`` alone removes only blanks)."""
    return F.btrim(cell, F.lit(WHITESPACE))


def is_missing(cell: Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """True for a missing marker and for NULL (an absent key)."""
    return F.coalesce(cell.isin(*markers), F.lit(True))


def joined_label(parts: Sequence[str], separator: str = " | ", suffix: Column | None = None) -> Column:
    """Join label columns; NULL parts and a NULL suffix are left out."""
    columns = [F.col(p) for p in parts]
    if suffix is not None:
        columns.append(suffix)
    return F.concat_ws(separator, *columns)


def prefixed_unless_missing(column: str, prefix: str, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """``prefix || column`` where the column holds a real value, NULL elsewhere."""
    return F.when(~F.col(column).isin(*markers), F.concat(F.lit(prefix), F.col(column)))
