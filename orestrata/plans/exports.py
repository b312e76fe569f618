"""Results for people: CSV files, a run summary and the provenance of the sources."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str, order_by: Sequence[str | Column] = ()) -> None:
    """Headed CSV files in key order (range partitioned: file n precedes file n + 1)."""
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.write.option("header", "true").csv(path)


def export_summary(
    counts: Sequence[tuple[str, DataFrame]], facts: dict[str, str], path: str
) -> None:
    """One JSON record: given facts plus the row count of each named frame."""
    out = None
    for name, df in counts:
        line = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = line if out is None else out.unionByName(line)
    columns = [F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name, _ in counts]
    out.agg(*columns).select(*[F.lit(text).alias(name) for name, text in facts.items()], "*").write.json(path)


def export_provenance(inventory: DataFrame, path: str) -> None:
    """Name, location, digest and size per active source."""
    inventory.select("source_name", F.col("location").alias("url"), "sha256", "bytes").orderBy("source_name").write.json(path)
