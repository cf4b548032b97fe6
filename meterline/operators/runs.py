"""Totals of a run and selection among run records."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.operators.checks import measures, stack


def run_totals(
    bronze: DataFrame, quality: DataFrame, gold: dict[str, DataFrame]
) -> DataFrame:
    """Measures of one run: rows in, rows out per table, warnings and exclusions."""
    def of(status):
        return F.sum(F.when(F.col("quality_status") == status, F.col("trip_count")))

    return stack([
        measures(bronze, input_rows=F.count("*")),
        measures(quality, quality_warnings=of("SUSPICIOUS"), invalid_rows=of("INVALID")),
        *[measures(frame, **{f"gold_{name}": F.count("*")}) for name, frame in gold.items()],
    ])


def earliest_run(runs: DataFrame, qualifies: Column) -> DataFrame:
    """First run by start time among those that qualify."""
    return runs.where(qualifies).orderBy("start_time", "run_id").limit(1)
