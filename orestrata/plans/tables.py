"""Managed tables: written in dependency order, checked while written, published together."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orestrata.operators.quality import Rule, broken, enforce, measure, metric_columns
from orestrata.session import child_folders, delete_folder, literal_rows, time_ordered_id

RELEASES_SCHEMA = "release STRING, published_at STRING"
METRICS_SCHEMA = "dataset STRING, rule STRING, action STRING, total BIGINT, failed BIGINT"


class Release:
    """One refresh of all tables under ``root``; readers see it once :meth:`publish` has run.

    A broken fail rule raises before anything is published, and the previous release stays current.
    """

    def __init__(self, spark: SparkSession, root: str, enforced: bool = True):
        self.spark, self.root, self.enforced = spark, root.rstrip("/"), enforced
        self.name = time_ordered_id()
        self.metrics: list[dict] = []

    def path(self, table: str) -> str:
        return f"{self.root}/release={self.name}/{table}"

    def save(
        self, table: str, df: DataFrame, rules: Sequence[Rule] = (), partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write ``df`` and return the stored table. Rules are counted in the writing pass: the
        observation sits in the result stage, whose retried tasks are not counted twice."""
        observation = Observation() if rules else None
        watched = df.observe(observation, *metric_columns(rules)) if rules else df
        writer = watched.write.partitionBy(*partition_by) if partition_by else watched.write
        writer.parquet(self.path(table))
        stored = self.spark.read.schema(df.schema).parquet(self.path(table))
        if rules:
            self._count(observation, df, table, rules)
        return stored

    def set_aside(self, table: str, df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
        """Count ``rules`` over all of ``df`` under ``dataset`` and store the rows that break one, with the names of
        the broken rules, in the same pass."""
        observation = Observation()
        bad = df.observe(observation, *metric_columns(rules)).withColumn("broken_rules", broken(rules)).filter(F.size("broken_rules") > 0)
        bad.write.parquet(self.path(table))
        self._count(observation, df, dataset, rules)
        return self.spark.read.schema(bad.schema).parquet(self.path(table))

    def _count(self, observation: Observation, df: DataFrame, dataset: str, rules: Sequence[Rule]) -> None:
        seen = observation.get
        if "total" in seen:
            found = [
                {"dataset": dataset, "rule": r.name, "action": r.action, "total": seen["total"], "failed": seen[f"failed_{i}"]}
                for i, r in enumerate(rules)
            ]
        else:  # the plan was empty and the observation optimised away
            found = [row.asDict() for row in measure(df, rules, dataset).collect()]
        self.metrics += found
        if self.enforced:
            enforce(found)

    def publish(self) -> None:
        metrics = [tuple(m[f] for f in ("dataset", "rule", "action", "total", "failed")) for m in self.metrics]
        literal_rows(self.spark, metrics, METRICS_SCHEMA).write.parquet(self.path("quality_metrics"))
        entry = (self.name, datetime.now(timezone.utc).isoformat())
        literal_rows(self.spark, [entry], RELEASES_SCHEMA).write.mode("append").parquet(f"{self.root}/releases")


def current_release(spark: SparkSession, root: str) -> str | None:
    try:
        releases = spark.read.schema(RELEASES_SCHEMA).parquet(f"{root}/releases")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return releases.agg({"release": "max"}).first()[0]


class Tables:
    """The tables of one release, which is looked up once: what is read together belongs together."""

    def __init__(self, spark: SparkSession, root: str, release: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.release = release or current_release(spark, root)
        if self.release is None:
            raise LookupError(f"no release has been published under {root}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/release={self.release}/{table}")

    def register(self, tables: Sequence[str]) -> None:
        """Make tables available to SQL under their names."""
        for table in tables:
            self.read(table).createOrReplaceTempView(table)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A single table of the current release."""
    return Tables(spark, root).read(table)


def expire_releases(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the ``keep`` newest published releases, and of unpublished ones older than those
    (runs that failed). Returns what was deleted. Not to be run while an older release is read."""
    published = sorted(r["release"] for r in spark.read.schema(RELEASES_SCHEMA).parquet(f"{root}/releases").collect())
    oldest = published[-keep:][0]
    gone = [name for name in child_folders(spark, root) if name.startswith("release=") and name.removeprefix("release=") < oldest]
    for name in gone:
        delete_folder(spark, f"{root}/{name}")
    return gone
