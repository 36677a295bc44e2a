"""Field checks over rows, scored with a gate on the critical ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A condition that rows should meet. A row that makes it null fails it."""

    label: str
    condition: Column
    critical: bool = True


def check_results(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Per check: rows tested and rows passed, in one pass over the data."""
    sums = [
        F.count_if(F.coalesce(check.condition, F.lit(False))).alias(f"_{i}")
        for i, check in enumerate(checks)
    ]
    totals = df.agg(F.count("*").alias("_rows"), *sums)
    rows = [
        F.struct(
            F.lit(check.label).alias("label"),
            F.lit(check.critical).alias("critical"),
            F.col("_rows").alias("total"),
            F.col(f"_{i}").alias("passed"),
        )
        for i, check in enumerate(checks)
    ]
    return totals.select(F.inline_outer(F.array(*rows)))


def score(results: DataFrame) -> DataFrame:
    """One row: totals, scores and the gate. Without checks the scores are 1."""
    critical = F.col("critical")
    zero = F.lit(0).cast("bigint")
    totals = results.agg(
        F.coalesce(F.sum("total"), zero).alias("total"),
        F.coalesce(F.sum("passed"), zero).alias("passed"),
        F.coalesce(F.sum(F.when(critical, F.col("total"))), zero).alias("critical_total"),
        F.coalesce(F.sum(F.when(critical, F.col("passed"))), zero).alias("critical_passed"),
    )
    return totals.select(
        "total",
        "passed",
        _ratio("passed", "total").alias("score"),
        "critical_total",
        "critical_passed",
        _ratio("critical_passed", "critical_total").alias("critical_score"),
        (F.col("critical_passed") == F.col("critical_total")).alias("passed_gate"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(1.0))
