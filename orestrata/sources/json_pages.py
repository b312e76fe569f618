"""Paged JSON documents: {"page": {"offset": .., "total": ..}, "data": [{..}, ..]}."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.sources.contracts import PageContract, SchemaDrift, told

# Cells stay text: a map keeps the digits as written and tells an absent key from a null.
PAGE_SCHEMA = "page STRUCT<total: BIGINT, offset: BIGINT>, data ARRAY<MAP<STRING, STRING>>"


@dataclass(frozen=True)
class PageRead:
    """``pages``: one row per document with ``problem``; ``rows``: one per element of sound pages."""

    pages: DataFrame
    rows: DataFrame


def page_documents(spark: SparkSession, paths: str | Sequence[str], per_line: bool = False) -> DataFrame:
    """(path, page, data): one JSON document per file (or per line); broken JSON raises."""
    return (
        spark.read.schema(PAGE_SCHEMA)
        .option("multiLine", str(not per_line).lower())
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .json(paths)
        .select(F.col("_metadata.file_path").alias("path"), "page", "data")
    )


def parse_pages(documents: DataFrame, contract: PageContract, keep: Sequence[str] = ("path",)) -> PageRead:
    """Check each page for completeness and its elements for the required keys, then explode.

    ``documents`` has ``page`` and ``data`` as in :data:`PAGE_SCHEMA` beside the ``keep`` columns.
    """
    pages = _checked(documents, contract)
    rows = (
        pages.filter(F.col("problem").isNull())
        .select(*keep, F.posexplode("data").alias("_position", "_row"))
        .select(*keep, (F.col("_position") + 1).cast("bigint").alias("row_number"), checked_fields(contract).alias("fields"))
    )
    return PageRead(pages.select(*keep, "page", F.size("data").alias("n_rows"), "problem"), rows)


def exploded_pages(documents: DataFrame, contract: PageContract, keep: Sequence[str]) -> DataFrame:
    """(keep.., row_number, fields, problem) in one pass: the elements of sound pages, and one row with its problem for
    each page that isn't."""
    pages = _checked(documents, contract)
    sound = F.when(F.col("problem").isNull(), F.col("data"))
    return pages.select(*keep, "problem", F.posexplode_outer(sound).alias("_position", "_row")).select(
        *keep,
        (F.col("_position") + 1).cast("bigint").alias("row_number"),
        F.when(F.col("problem").isNull(), checked_fields(contract)).alias("fields"),
        "problem",
    )


def _checked(documents: DataFrame, contract: PageContract) -> DataFrame:
    lacking = F.exists("data", lambda row: lacks_keys(row, contract))
    return documents.withColumn("problem", page_problem(F.col("page"), F.when(F.col("data").isNotNull(), F.size("data")), lacking))


def lacks_keys(row: Column, contract: PageContract) -> Column:
    """Whether an element lacks a required key; one that is null lacks all."""
    required = F.array(*[F.lit(key) for key in contract.required])
    return F.coalesce(F.size(F.array_except(required, F.map_keys(row))) > 0, F.lit(True))


def page_problem(page: Column, n_rows: Column, lacking: Column) -> Column:
    """What is wrong with a page of ``n_rows`` elements (NULL without ``data``), or NULL."""
    return (
        F.when(n_rows.isNull() | (n_rows == 0), F.lit("no data"))
        .when(F.coalesce(page["offset"], F.lit(0)) != 0, F.lit("partial page"))
        .when(F.coalesce(page["total"], n_rows) != n_rows, F.lit("partial page"))
        .when(lacking, F.lit("missing keys"))
    )


def checked_fields(contract: PageContract) -> Column:
    """The contract's columns from the element ``_row``."""
    defaults = dict(contract.defaults)
    cells = []
    for name, spellings in contract.columns:
        cells += [F.lit(name), _first_present(F.col("_row"), spellings, defaults.get(name))]
    return F.create_map(*cells)


def _first_present(row: Column, spellings: Sequence[str], default: str | None) -> Column:
    out = F.lit(default).cast("string")
    for key in reversed(spellings):
        out = F.when(F.map_contains_key(row, key), row[key]).otherwise(out)
    return out


def require_pages(pages: DataFrame) -> None:
    """Raise on partial or drifted pages."""
    bad = pages.filter(F.col("problem").isNotNull())
    if not bad.isEmpty():
        raise SchemaDrift(told("pages break their contract", bad, pages.columns[0], "problem"), bad)
