"""The stored formats: record envelopes and snapshot manifests, read with explicit schemas."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The published layout of the two formats.
RECORD_SCHEMA = (
    "object_id STRING, source_name STRING, kind STRING, row_number BIGINT, fields MAP<STRING, STRING>"
)
MANIFEST_SCHEMA = (
    "snapshot_id STRING, committed_at STRING, deleted ARRAY<STRING>, "
    "files ARRAY<STRUCT<source_name: STRING, url: STRING, sha256: STRING, object_id: STRING, "
    "raw_relpath: STRING, parsed_relpath: STRING, kind: STRING, etag: STRING, last_modified: STRING, "
    "bytes: BIGINT>>"
)


def read_json_strict(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """JSON lines with a given schema; a malformed line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_json_strict(spark, paths, RECORD_SCHEMA)


def read_manifests(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_json_strict(spark, paths, MANIFEST_SCHEMA)


def latest_inventory(
    manifests: DataFrame, order: str = "snapshot_id", files: str = "files", keep: Sequence[str] = ("committed_at",)
) -> DataFrame:
    """The newest manifest's files as rows. Only the ordering column is aggregated; the wide file
    arrays are neither sorted nor moved, and the newest id reaches the scan as a filter."""
    newest = manifests.agg(F.max(order)).scalar()
    return (
        manifests.filter(F.col(order) == newest)
        .select(order, *keep, F.explode(files).alias("_file"))
        .select(order, *keep, "_file.*")
    )


def active_records(records: DataFrame, active: DataFrame, key: str | Sequence[str] = "object_id") -> DataFrame:
    """Records of active objects only: replaced and deleted objects stop contributing."""
    keys = [key] if isinstance(key, str) else list(key)
    return records.join(active.select(*keys).distinct(), keys, "left_semi")
