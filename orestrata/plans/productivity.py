"""Productivity series of a statistics agency beside national population: landed files to answers."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orestrata.functions.text import joined_label, prefixed_unless_missing
from orestrata.operators.conform import Cast, Text
from orestrata.operators.enrich import Link
from orestrata.plans.conventions import OBSERVATION_CELLS, matches, observation_rules, population_rules
from orestrata.plans.exports import export_csv, export_provenance, export_summary
from orestrata.plans.medallion import TABLES, MedallionSpec, acceptance, refresh
from orestrata.plans.tables import Release, Tables
from orestrata.plans.twins import ANSWERS, parity
from orestrata.sources.contracts import FileContract, PageContract
from orestrata.sources.snapshots import (
    IngestResult,
    ingest,
    inventory_at,
    latest_snapshot,
    snapshot_records,
)

# File names, columns and codes of the published source files.
FILES = (
    FileContract("observations", r"pr\.data\..*", ("series_id", "year", "period", "value", "footnote_codes")),
    FileContract(
        "series",
        r"pr\.series",
        (
            "series_id",
            "sector_code",
            "class_code",
            "measure_code",
            "duration_code",
            "seasonal",
            "base_year",
            "footnote_codes",
            "begin_year",
            "begin_period",
            "end_year",
            "end_period",
        ),
    ),
    FileContract("sector", r"pr\.sector", ("sector_code", "sector_name")),
    FileContract("class", r"pr\.class", ("class_code", "class_text")),
    FileContract("measure", r"pr\.measure", ("measure_code", "measure_text")),
    FileContract("duration", r"pr\.duration", ("duration_code", "duration_text")),
    FileContract("seasonal", r"pr\.seasonal", ("seasonal_code", "seasonal_text")),
    FileContract("period", r"pr\.period", ("period", "period_name")),
    FileContract("footnote", r"pr\.footnote", ("footnote_code", "footnote_text"), may_be_empty=True),
)
PAGES = (
    PageContract(
        "population",
        r"population\.json",
        required=("Year", "Nation", "Population"),
        columns=(
            ("year", ("Year",)),
            ("nation", ("Nation",)),
            ("nation_id", ("Nation ID", "ID Nation")),
            ("population", ("Population",)),
        ),
        defaults=(("nation_id", ""),),
    ),
)
SERIES_ID = "PR[SU][0-9]{8}"

SPEC = MedallionSpec(
    observations=OBSERVATION_CELLS,
    observation_rules=observation_rules(SERIES_ID),
    population=(
        Text("year", trim=False),
        Text("nation", trim=False),
        Text("nation_id", trim=False),
        Text("population", trim=False),
        Cast("year", of="year", to="int"),
        Cast("population_decimal", of="population", to="decimal(24,6)"),
        Cast("population", of="population_decimal", to="bigint"),
    ),
    population_rules=population_rules(),
    population_scope="nation = 'United States' AND nation_id IN ('01000US', '')",
    series_columns=(
        "series_id",
        "sector_code",
        "class_code",
        "measure_code",
        "duration_code",
        "seasonal",
        "base_year",
    ),
    series_rule=matches("series_keys", "series_id", SERIES_ID, "fail"),
    lookups={
        "sector": ("sector_code", "sector_name"),
        "class": ("class_code", "class_text"),
        "measure": ("measure_code", "measure_text"),
        "duration": ("duration_code", "duration_text"),
        "seasonal": ("seasonal_code", "seasonal_text"),
    },
    links=(
        Link("sector", "sector_code", "sector_name"),
        Link("class", "class_code", "class_text"),
        Link("measure", "measure_code", "measure_text"),
        Link("duration", "duration_code", "duration_text"),
        Link("seasonal", "seasonal", "seasonal_text"),
    ),
    label=lambda: joined_label(
        ["sector_name", "class_text", "measure_text", "duration_text", "seasonal_text"],
        suffix=prefixed_unless_missing("base_year", "Index base: "),
    ),
    quarters=("Q01", "Q02", "Q03", "Q04"),
    first_year=2013,
    last_year=2018,
    point_series="PRS30006032",
    point_period="Q01",
)


def ingest_landed(spark: SparkSession, landing: str, store: str) -> IngestResult:
    """Take in the landed files; publishes a snapshot if their set or content changed."""
    return ingest(spark, landing, store, FILES, PAGES)


def refresh_tables(spark: SparkSession, store: str, out: str) -> Release:
    """Bronze, Silver and Gold of the newest snapshot."""
    snapshot = latest_snapshot(spark, store)
    if snapshot is None:
        raise LookupError(f"no snapshot has been published under {store}")
    return refresh(
        spark, snapshot_records(spark, store, snapshot), SPEC, out, inventory_at(spark, store, snapshot)
    )


def validate(spark: SparkSession, out: str) -> DataFrame:
    """Acceptance checks plus, per answer, the differences of the SQL form to both other forms."""
    tables = Tables(spark, out)
    tables.register(["silver_observations", "silver_population", "silver_series"])
    checks = acceptance(tables, SPEC)
    for table in ANSWERS:
        for name, stored in (("dataframe", None), ("stored", tables.read(table))):
            differences = parity(spark, table, SPEC, stored).groupBy().count()
            checks = checks.unionByName(
                differences.selectExpr(
                    f"'{table}: sql vs {name}' AS check", "count AS observed", "0L AS expected", "count = 0 AS passed"
                )
            )
    return checks


def export(spark: SparkSession, store: str, out: str, target: str) -> None:
    """The three answers as CSV, a summary and the source provenance as JSON."""
    snapshot = latest_snapshot(spark, store)
    inventory = inventory_at(spark, store, snapshot)
    tables = Tables(spark, out)
    for table, (_, keys) in ANSWERS.items():
        export_csv(tables.read(table), f"{target}/{table}", keys)
    facts = {"spark": spark.version, "snapshot_id": snapshot, "release": tables.release}
    counts = [("source_files", inventory), *[(name, tables.read(name)) for name in TABLES]]
    export_summary(counts, facts, f"{target}/summary")
    export_provenance(inventory, f"{target}/provenance")
