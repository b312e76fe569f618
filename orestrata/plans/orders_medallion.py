"""The medallion graph over order history: customers are series, quarters are periods.

The order table is published the way a statistics agency publishes: quarterly values and an annual
value (period Q05) per series, once in a complete and once in an overlapping recent source, every
cell as text. Bronze to Gold then run as for landed files.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.functions.text import joined_label, prefixed_unless_missing
from orestrata.operators.conform import Cast, Text
from orestrata.operators.enrich import Link
from orestrata.plans.conventions import OBSERVATION_CELLS, matches, observation_rules, population_rules
from orestrata.plans.medallion import MedallionSpec

SERIES_ID = "[0-9]+"

SPEC = MedallionSpec(
    observations=OBSERVATION_CELLS,
    observation_rules=observation_rules(SERIES_ID),
    population=(
        Text("year"),
        Text("nation"),
        Text("population"),
        Cast("year", of="year", to="int"),
        Cast("population_decimal", of="population", to="decimal(24,6)"),
        Cast("population", of="population_decimal", to="bigint"),
    ),
    population_rules=population_rules(),
    population_scope="nation = 'ALL'",
    series_columns=("series_id", "nation_code", "segment_code", "base_year"),
    series_rule=matches("series_keys", "series_id", SERIES_ID, "fail"),
    lookups={"nation": ("nation_code", "nation_name"), "segment": ("segment_code", "segment_text")},
    links=(Link("nation", "nation_code", "nation_name"), Link("segment", "segment_code", "segment_text")),
    label=lambda: joined_label(
        ["nation_name", "segment_text"], suffix=prefixed_unless_missing("base_year", "Credit since: ")
    ),
    quarters=("Q01", "Q02", "Q03", "Q04"),
    first_year=1996,
    last_year=2000,
    point_series="1",
    point_period="Q01",
)


def _records(df: DataFrame, kind: str, source: Column, cells: dict[str, Column]) -> DataFrame:
    flat = [x for name, cell in cells.items() for x in (F.lit(name), cell.cast("string"))]
    return df.select(
        F.sha2(source.cast("string"), 256).alias("object_id"),
        source.alias("source_name"),
        F.lit(kind).alias("kind"),
        F.lit(None).cast("bigint").alias("row_number"),
        F.create_map(*flat).alias("fields"),
    )


def published_records(orders: DataFrame, customer: DataFrame, nation: DataFrame, damaged: bool = False) -> DataFrame:
    """The record envelopes of all sources, derived from the three tables.

    ``damaged`` spoils cells by a rule on their keys, so that each quality rule meets rows that break it: values that
    are no number, periods and years out of range, series ids with letters, figures that differ between overlapping
    sources, series with two descriptions, without a known nation or without any, series with letters in their ids,
    populations that are not whole or differ, a nation with two names, and nations whose records name no object.
    """
    value = F.col("o_totalprice").cast("decimal(14,2)")
    sales = orders.select(
        F.col("o_custkey").alias("series"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("o_orderdate")).alias("period"),
        value.alias("value"),
    )
    quarterly = sales.groupBy("series", "year", "period").agg(F.sum("value").alias("value"))
    # each quarter goes to the complete source, recent ones to the overlapping source as well, and
    # its value into the annual row: one pass over the small quarterly sums
    sources = F.when(F.col("year") >= 1999, F.array(F.lit("orders.1.All"), F.lit("orders.0.Current"))).otherwise(
        F.array(F.lit("orders.1.All"))
    )
    annual = quarterly.groupBy("series", "year").agg(F.lit("Q05").alias("period"), F.sum("value").alias("value"))
    points = quarterly.unionByName(annual).withColumn("source", F.explode(sources))
    series_id, year, period, shown = F.col("series").cast("string"), F.col("year").cast("string"), F.col("period"), F.col("value").cast("string")
    last = F.col("series") % 10
    if damaged:
        shown = F.when((last == 1) & (period == "Q02"), F.lit("n/a")).when(
            (last == 2) & (F.col("source") == "orders.0.Current"), (F.col("value") + 1).cast("string")
        ).otherwise(shown)
        period = F.when((last == 3) & (period == "Q03"), F.lit("Q13")).otherwise(period)
        year = F.when((last == 4) & (F.col("year") == 1997), F.lit("19970")).otherwise(year)
        series_id = F.when((last == 5) & (F.col("period") == "Q04"), F.concat(series_id, F.lit("X"))).otherwise(series_id)
    observations = _records(
        points,
        "observations",
        F.col("source"),
        {
            "series_id": F.concat(F.lit(" "), series_id),
            "year": year,
            "period": period,
            "value": shown,
            "footnote_codes": F.lit(""),
        },
    )
    if damaged:
        tail = F.col("c_custkey") % 10
        twice = F.when(tail == 6, F.array(F.lit(0), F.lit(1))).when(tail == 7, F.array()).otherwise(F.array(F.lit(0)))
        customer = customer.withColumn("_again", F.explode(twice.cast("array<int>"))).withColumn(
            "c_acctbal", F.when(F.col("_again") == 1, -F.col("c_acctbal")).otherwise(F.col("c_acctbal"))
        ).withColumn("c_nationkey", F.when(tail == 8, F.lit(-1)).otherwise(F.col("c_nationkey")))
    series = _records(
        customer,
        "series",
        F.lit("customer.series"),
        {
            "series_id": F.concat(F.col("c_custkey").cast("string"), F.when(F.lit(damaged) & (F.col("c_custkey") % 10 == 9), F.lit("S")).otherwise(F.lit(""))),
            "nation_code": F.col("c_nationkey"),
            "segment_code": F.lower("c_mktsegment"),
            "base_year": F.when(F.col("c_acctbal") < 0, F.lit("1995")).otherwise(F.lit("-")),
        },
    )
    if damaged:
        names = F.when(F.col("n_nationkey") == 3, F.array("n_name", F.concat("n_name", F.lit(" II")))).otherwise(F.array("n_name"))
        nation = nation.withColumn("n_name", F.explode(names))
    nations = _records(
        nation, "nation", F.lit("customer.nation"), {"nation_code": F.col("n_nationkey"), "nation_name": F.col("n_name")}
    )
    if damaged:
        nations = nations.withColumn("object_id", F.when(F.col("fields")["nation_code"].cast("int") % 7 != 0, F.col("object_id")))
    segments = _records(
        customer.select("c_mktsegment").distinct(),
        "segment",
        F.lit("customer.segment"),
        {"segment_code": F.lower("c_mktsegment"), "segment_text": F.col("c_mktsegment")},
    )
    people = sales.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    if damaged:
        counts = F.when(F.col("year") == 1998, F.array(F.col("n"), F.col("n") + 1)).otherwise(F.array("n"))
        people = people.withColumn("n", F.explode(counts))
    population = _records(
        people,
        "population",
        F.lit("orders.json"),
        {
            "year": F.col("year"),
            "nation": F.lit("ALL"),
            "population": F.concat(F.col("n"), F.when(F.lit(damaged) & (F.col("year") == 1997), F.lit(".5")).otherwise(F.lit(".0"))),
        },
    )
    out = observations
    for part in (series, nations, segments, population):
        out = out.unionByName(part)
    return out


def order_records(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return published_records(table("orders"), table("customer"), table("nation"), damaged)
