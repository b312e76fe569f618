"""The SQL forms of the three answers, and their comparison with the DataFrame forms."""
from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from orestrata.operators.compare import keyed_diff
from orestrata.plans.medallion import MedallionSpec, answer_alignment, answer_best_year, answer_stats

SQL_FOLDER = Path(__file__).resolve().parents[1] / "sql"
# table -> (SQL file, key columns)
ANSWERS = {
    "gold_population_stats": ("population_stats.sql", ["start_year", "end_year"]),
    "gold_best_year": ("best_year.sql", ["series_id"]),
    "gold_series_population": ("series_population.sql", ["series_id", "year", "period"]),
}


def run_sql_file(spark: SparkSession, name: str, args: dict) -> DataFrame:
    """Run a statement kept in a file over the registered views, with named parameters."""
    return spark.sql((SQL_FOLDER / name).read_text(encoding="utf-8"), args=args)


def sql_answer(spark: SparkSession, table: str, spec: MedallionSpec) -> DataFrame:
    """The SQL form over the views silver_observations, silver_population and silver_series."""
    args = {
        "gold_population_stats": {"first_year": spec.first_year, "last_year": spec.last_year},
        "gold_best_year": {f"q{n}": quarter for n, quarter in enumerate(spec.quarters, 1)},
        "gold_series_population": {"series": spec.point_series, "period": spec.point_period},
    }
    return run_sql_file(spark, ANSWERS[table][0], args[table])


def dataframe_answer(spark: SparkSession, table: str, spec: MedallionSpec) -> DataFrame:
    observations, population = spark.table("silver_observations"), spark.table("silver_population")
    if table == "gold_population_stats":
        return answer_stats(population, spec)
    if table == "gold_best_year":
        return answer_best_year(observations, spark.table("silver_series"), spec)
    return answer_alignment(observations, population, spec)


def parity(spark: SparkSession, table: str, spec: MedallionSpec, stored: DataFrame | None = None) -> DataFrame:
    """Differences between the SQL form and the DataFrame form (or the stored table)."""
    other = dataframe_answer(spark, table, spec) if stored is None else stored
    return keyed_diff(other, sql_answer(spark, table, spec), ANSWERS[table][1])
