"""Declared data-quality rules. A rule that evaluates to NULL counts as failed, everywhere."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = "fail"  # "fail" the dataset or "drop" the row

    def __post_init__(self):
        if self.action not in ("fail", "drop"):
            raise ValueError(f"unknown action {self.action!r} of rule {self.name}")


class ExpectationFailed(RuntimeError):
    pass


def holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def all_hold(rules: Sequence[Rule]) -> Column:
    out = F.lit(True)
    for rule in rules:
        out = out & holds(rule.condition)
    return out


def broken(rules: Sequence[Rule]) -> Column:
    """ARRAY<STRING>: the names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(~holds(r.condition), F.lit(r.name)) for r in rules]))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows on which every rule holds."""
    return df.filter(all_hold(rules))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The exact complement of :func:`keep_valid`."""
    return df.filter(~all_hold(rules))


def metric_columns(rules: Sequence[Rule]) -> list[Column]:
    """One aggregate per rule plus the total; usable in ``agg`` and in ``observe``."""
    failed = [F.count_if(~holds(r.condition)).alias(f"failed_{i}") for i, r in enumerate(rules)]
    return [F.count(F.lit(1)).alias("total"), *failed]


def measure(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """All rules in one pass -> rows (dataset, rule, action, total, failed)."""
    lines = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.col("total"),
                F.col(f"failed_{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return df.agg(*metric_columns(rules)).select(F.inline(lines))


def enforce(metrics: Sequence[dict]) -> None:
    """Raise if a fail rule was broken. ``metrics`` holds one entry per rule, never data rows."""
    broken = [m for m in metrics if m["action"] == "fail" and m["failed"]]
    if broken:
        raise ExpectationFailed(
            "; ".join(f"{m['dataset']}.{m['rule']}: {m['failed']} of {m['total']} rows" for m in broken)
        )


def check(df: DataFrame, rules: Sequence[Rule], dataset: str) -> list[dict]:
    """Measure and enforce at once; returns the metrics."""
    metrics = [row.asDict() for row in measure(df, rules, dataset).collect()]
    enforce(metrics)
    return metrics
