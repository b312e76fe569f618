"""Denormalised dimensions: code columns joined to collapsed lookups, conflicts counted."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.operators.collapse import collapse_lookups


@dataclass(frozen=True)
class Link:
    """Dimension column ``code`` refers to the lookup ``kind``; its text arrives as ``label``."""

    kind: str
    code: str
    label: str


def lookup_entries(records: DataFrame, sources: Mapping[str, tuple[str, str]], cells: str = "fields") -> DataFrame:
    """(kind, code, label) rows of all lookup kinds in one scan. ``sources``: kind -> (code, label) keys."""
    # the codes and texts of one record are picked by its kind
    code, label = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, (code_key, label_key) in sources.items():
        mine = F.col("kind") == kind
        code = F.when(mine, F.col(cells)[code_key]).otherwise(code)
        label = F.when(mine, F.col(cells)[label_key]).otherwise(label)
    return records.filter(F.col("kind").isin(*sources)).select("kind", code.alias("code"), label.alias("label"))


def lookup_table(records: DataFrame, sources: Mapping[str, tuple[str, str]], cells: str = "fields") -> DataFrame:
    """One row per (kind, code) with its label and the number of variants."""
    return collapse_lookups(lookup_entries(records, sources, cells), ["kind", "code"], "label")


def with_versions(df: DataFrame, key: str, versions: str) -> DataFrame:
    """Distinct rows plus how many distinct rows share the key.

    The count is a map-side combined aggregate joined back, not a window: a key that owns a third
    of the rows is then split by the adaptive skew join instead of being buffered by one task.
    """
    rows = df.distinct()
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(versions))
    return rows.join(counts.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def enrich_dimension(
    dimension: DataFrame,
    lookups: DataFrame,
    links: Sequence[Link],
    label: Column | None = None,
    label_name: str = "series_label",
) -> DataFrame:
    """Left join every link. ``lookups`` has one row per (kind, code), see :func:`lookup_table`.

    No hint is given: read from a stored table the lookups are broadcast while they are below
    ``spark.sql.autoBroadcastJoinThreshold`` and joined by shuffle beyond it.
    """
    out = dimension
    for link in links:
        side = lookups.filter(F.col("kind") == link.kind).select(
            F.col("code").alias("_code"),
            F.col("label").alias(link.label),
            F.col("label_versions").alias(f"{link.kind}_versions"),
        )
        out = out.join(side, F.col(link.code) == F.col("_code"), "left").drop("_code")
    return out if label is None else out.withColumn(label_name, label)
