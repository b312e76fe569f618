"""The time-series answers: period statistics, best period, alignment, latest record."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def period_stats(df: DataFrame, time: str, value: str, first, last, prefix: str | None = None) -> DataFrame:
    """Count, first, last, mean and both standard deviations over a closed range of periods."""
    noun = prefix or value
    return df.filter(F.col(time).between(first, last)).agg(
        F.count(F.lit(1)).alias(f"{time}_count"),
        F.min(time).alias(f"start_{time}"),
        F.max(time).alias(f"end_{time}"),
        F.avg(value).alias(f"mean_{noun}"),
        F.stddev_pop(value).alias(f"stddev_{noun}"),
        F.stddev_samp(value).alias("stddev_sample"),
    )


def best_period(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    key: str,
    time: str,
    period: str,
    value: str,
    periods: Sequence[str],
    label: str,
    counted: str = "quarters_available",
    empty_status: str = "no_quarterly_observations",
) -> DataFrame:
    """Per key the time with the largest sum over ``periods``; the earliest wins a tie.

    Every key of the facts or the dimension is kept. The dimension's keys join the facts as rows
    without a value, so universe and ranking come from one scan of the facts and one map-side
    combined aggregation; no separate distinct, no join of the facts with themselves.
    """
    types = {f.name: f.dataType for f in facts.schema.fields}
    inside = F.when(F.col(period).isin(*periods), F.col(value))
    points = facts.select(key, time, inside.alias("_value")).unionByName(
        dimension.select(
            key, F.lit(None).cast(types[time]).alias(time), F.lit(None).cast(types[value]).alias("_value")
        )
    )
    sums = points.groupBy(key, time).agg(F.sum("_value").alias("_sum"), F.count("_value").alias("_n"))
    # keys without any value keep one row, ranked last by its NULL sum
    order = Window.partitionBy(key).orderBy(F.col("_sum").desc_nulls_last(), F.col(time).asc_nulls_first())
    top = sums.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1)
    real = (F.col("_n") > 0) & F.col(key).isNotNull()
    best = top.select(
        key,
        F.when(real, F.col(time)).alias(f"best_{time}"),
        F.when(real, F.col("_sum")).alias(f"summed_{value}"),
        F.when(real, F.col("_n")).alias(counted),
    )
    status = F.when(F.col(f"best_{time}").isNull(), F.lit(empty_status)).otherwise(F.lit("ok"))
    return best.join(dimension.select(key, label), key, "left").select(
        key, label, f"best_{time}", f"summed_{value}", counted, status.alias("status")
    )


def align_left(
    left: DataFrame, right: DataFrame, on: str, where: Column, columns: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    """Chosen points of the left series with the right series' columns; no match leaves NULL."""
    points = left.filter(where).select(*columns)
    return points.join(right.select(on, *carry), on, "left").select(*columns, *carry)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; losers are pruned before the shuffle."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
