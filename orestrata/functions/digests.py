"""Content identities."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_digest(content: Column) -> Column:
    """SHA-256 of the bytes: has the content changed?"""
    return F.sha2(content, 256)


def object_id(name: Column, content: Column) -> Column:
    """SHA-256 of name, NUL, bytes: equal bytes under two names are two objects."""
    return F.sha2(F.concat(F.encode(name, "UTF-8"), F.unhex(F.lit("00")), content.cast("binary")), 256)
