"""The Bronze -> Silver -> Gold graph over record envelopes, driven by a specification."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.operators.answers import align_left, best_period, period_stats
from orestrata.operators.collapse import collapse_overlaps, duplicate_keys, universe
from orestrata.operators.conform import Cast, Missing, Text, conform
from orestrata.operators.enrich import Link, enrich_dimension, lookup_table, with_versions
from orestrata.operators.quality import Rule, keep_valid
from orestrata.plans.tables import Release, Tables
from orestrata.session import side_by_side

PROVENANCE = ("source_name", "object_id", "row_number")
TABLES = (
    "quarantine_observations",
    "silver_observations",
    "quarantine_population",
    "silver_population",
    "silver_series",
    "gold_population_stats",
    "gold_best_year",
    "gold_series_population",
)


@dataclass(frozen=True)
class MedallionSpec:
    """Everything that differs between two series collections."""

    observations: Sequence[Text | Cast | Missing]
    observation_rules: Sequence[Rule]
    population: Sequence[Text | Cast | Missing]
    population_rules: Sequence[Rule]
    population_scope: str
    series_columns: Sequence[str]
    series_rule: Rule
    lookups: dict[str, tuple[str, str]]
    links: Sequence[Link]
    label: Callable[[], Column]
    quarters: Sequence[str]
    first_year: int
    last_year: int
    point_series: str
    point_period: str


def type_observations(records: DataFrame, spec: MedallionSpec) -> DataFrame:
    return conform(records.filter(F.col("kind") == "observations"), spec.observations, keep=PROVENANCE)


def type_population(records: DataFrame, spec: MedallionSpec) -> DataFrame:
    return conform(records.filter(F.col("kind") == "population"), spec.population)


def build_series(records: DataFrame, lookups: DataFrame, spec: MedallionSpec) -> DataFrame:
    texts = [Text(c) for c in spec.series_columns]
    rows = conform(records.filter(F.col("kind") == "series"), texts)
    return enrich_dimension(with_versions(rows, spec.series_columns[0], "series_versions"), lookups, spec.links, spec.label())


def collapse_observations(valid: DataFrame, typed: DataFrame | None = None) -> DataFrame:
    return collapse_overlaps(
        valid,
        ["series_id", "year", "period"],
        "value",
        evidence={"footnotes": "footnote_codes", "source_files": "source_name"},
        values_from=typed,
    )


def collapse_population(valid: DataFrame, spec: MedallionSpec) -> DataFrame:
    scoped = valid.filter(spec.population_scope)
    return collapse_overlaps(scoped, ["year"], "population", versions="population_versions", null_is_version=False)


def answer_stats(population: DataFrame, spec: MedallionSpec) -> DataFrame:
    return period_stats(population, "year", "population", spec.first_year, spec.last_year)


def answer_best_year(observations: DataFrame, series: DataFrame, spec: MedallionSpec) -> DataFrame:
    return best_period(
        observations,
        series,
        key="series_id",
        time="year",
        period="period",
        value="value",
        periods=spec.quarters,
        label="series_label",
    )


def answer_alignment(observations: DataFrame, population: DataFrame, spec: MedallionSpec) -> DataFrame:
    where = (F.col("series_id") == spec.point_series) & (F.col("period") == spec.point_period)
    return align_left(
        observations, population, "year", where, ["series_id", "year", "period", "value"], ["population"]
    )


def refresh(
    spark: SparkSession,
    records: DataFrame,
    spec: MedallionSpec,
    out: str,
    inventory: DataFrame | None = None,
    enforced: bool = True,
) -> Release:
    """Recompute all tables from the active record envelopes and publish them as one release.

    Typed rows are not stored: silver collapses the valid ones straight from bronze, and the pass that counts the rules
    keeps only what breaks one, with the names of the broken rules. A rule that is NULL is broken, so the two are
    complements. Silver is sorted by key within its files, so that row-group statistics find single series.

    ``enforced=False`` publishes in spite of broken rules, with their counts: a report on what would be refused.
    """
    run = Release(spark, out, enforced)
    if inventory is not None:
        run.save(
            "bronze_manifest", inventory, [Rule("manifest_keys", "snapshot_id IS NOT NULL AND object_id IS NOT NULL")]
        )
    bronze = run.save(
        "bronze_records",
        records,
        [Rule("record_envelope", "object_id IS NOT NULL AND source_name IS NOT NULL AND kind IS NOT NULL AND fields IS NOT NULL")],
        partition_by=["kind"],
    )

    def observation_tables() -> DataFrame:
        typed = type_observations(bronze, spec)
        run.set_aside("quarantine_observations", typed, "typed_observations", spec.observation_rules)
        return run.save(
            "silver_observations",
            collapse_observations(keep_valid(typed, spec.observation_rules), typed).sortWithinPartitions("series_id", "year", "period"),
            [
                Rule("non_null_keys", "series_id IS NOT NULL AND year IS NOT NULL AND period IS NOT NULL"),
                Rule("consistent_overlap", "value_versions = 1"),
            ],
        )

    def population_tables() -> DataFrame:
        typed = type_population(bronze, spec)
        run.set_aside("quarantine_population", typed, "typed_population", spec.population_rules)
        return run.save(
            "silver_population",
            collapse_population(keep_valid(typed, spec.population_rules), spec),
            [
                Rule("population_keys", "year IS NOT NULL AND population IS NOT NULL"),
                Rule("consistent_population", "population_versions = 1"),
            ],
        )

    def series_tables() -> DataFrame:
        lookups = run.save("silver_lookups", lookup_table(bronze, spec.lookups))
        return run.save(
            "silver_series",
            build_series(bronze, lookups, spec),
            [
                spec.series_rule,
                Rule("unique_series", "series_versions = 1"),
                Rule("complete_labels", " AND ".join(f"{link.label} IS NOT NULL" for link in spec.links)),
                Rule("unique_lookups", " AND ".join(f"{link.kind}_versions = 1" for link in spec.links)),
            ],
        )

    observations, population, series = side_by_side(spark, observation_tables, population_tables, series_tables)

    years = spec.last_year - spec.first_year + 1
    coverage = f"year_count = {years} AND start_year = {spec.first_year} AND end_year = {spec.last_year}"
    side_by_side(
        spark,
        lambda: run.save(
            "gold_population_stats", answer_stats(population, spec), [Rule("full_coverage", coverage)]
        ),
        lambda: run.save(
            "gold_best_year",
            answer_best_year(observations, series, spec),
            [Rule("human_readable_series", "series_label IS NOT NULL")],
        ),
        lambda: run.save("gold_series_population", answer_alignment(observations, population, spec)),
    )
    run.publish()
    return run


def acceptance(tables: Tables, spec: MedallionSpec) -> DataFrame:
    """One row per acceptance check of a release: (check, observed, expected, passed)."""
    t = {name: tables.read(name) for name in TABLES}
    observations, population = t["silver_observations"], t["silver_population"]
    covered = F.col("year").between(spec.first_year, spec.last_year)
    point = (F.col("series_id") == spec.point_series) & (F.col("period") == spec.point_period)

    def rows(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))

    checks = [
        ("covered_years", rows(population.filter(covered)), F.lit(spec.last_year - spec.first_year + 1)),
        ("repeated_observation_keys", rows(duplicate_keys(observations, ["series_id", "year", "period"])), F.lit(0)),
        ("repeated_population_keys", rows(duplicate_keys(population, ["year"])), F.lit(0)),
        ("complete_universe", rows(t["gold_best_year"]), rows(universe("series_id", observations, t["silver_series"]))),
        ("quarantined_observations", rows(t["quarantine_observations"]), F.lit(0)),
        ("quarantined_population", rows(t["quarantine_population"]), F.lit(0)),
        ("aligned_rows", rows(t["gold_series_population"]), rows(observations.filter(point))),
    ]
    return report(checks)


def report(checks: Sequence[tuple[str, DataFrame, Column | DataFrame]]) -> DataFrame:
    """(check, observed, expected, passed); ``observed`` (and ``expected``) are one-row frames with ``n``."""
    unknown = F.lit(None).cast("bigint")
    parts = []
    for name, observed, expected in checks:
        label, n = F.lit(name).alias("check"), F.col("n").cast("bigint")
        if isinstance(expected, DataFrame):
            parts.append(observed.select(label, n.alias("observed"), unknown.alias("expected")))
            parts.append(expected.select(label, unknown.alias("observed"), n.alias("expected")))
        else:
            parts.append(observed.select(label, n.alias("observed"), expected.cast("bigint").alias("expected")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.groupBy("check").agg(F.max("observed").alias("observed"), F.max("expected").alias("expected"))
    return out.withColumn("passed", F.col("observed") == F.col("expected"))
