"""What has to be rebuilt, as joins between current inputs and the last commit."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def detect_work(
    inputs: DataFrame, committed: DataFrame, forced: DataFrame, rebuild_all: bool = False
) -> DataFrame:
    """Inputs that need a new bronze build: (source, period, reason).

    `inputs`    current (source, period, raw_sha256, bronze_fingerprint); the
                fingerprint is null where no bronze exists
    `committed` the same columns as of the last publication
    `forced`    (period)
    The reasons are tested in order; an input without any is left out.
    """
    before = committed.select(
        "source", "period", F.col("raw_sha256").alias("old_raw"),
        F.col("bronze_fingerprint").alias("old_bronze"))
    marks = forced.select("period", F.lit(True).alias("is_forced")).distinct()
    reason = (
        F.when(F.lit(rebuild_all), "rebuild_all")
        .when(F.col("is_forced"), "forced")
        .when(~F.col("raw_sha256").eqNullSafe(F.col("old_raw")), "raw_changed")
        .when(F.col("bronze_fingerprint").isNull(), "bronze_missing")
        .when(~F.col("bronze_fingerprint").eqNullSafe(F.col("old_bronze")), "bronze_changed")
    )
    return (
        inputs.join(before, ["source", "period"], "left")
        .join(marks, "period", "left")
        .select("source", "period", reason.alias("reason"))
        .where("reason is not null")
    )


def loaded_periods(requested: DataFrame, committed: DataFrame) -> DataFrame:
    """Requested periods and everything already loaded: a run never shrinks the data."""
    return requested.select("period").union(
        committed.where("source = 'trips'").select("period")).distinct()


def changed_periods(work: DataFrame, periods: DataFrame) -> DataFrame:
    """Fact periods to rebuild.

    A trip file changes its own period. Changed zones can alter the validity of
    any trip and so change every period. Changed weather changes none, though
    the marts are rebuilt.
    """
    own = work.where("source = 'trips'").select("period")
    zones_changed = work.where("source = 'zones'").exists()
    return own.union(periods.select("period").where(zones_changed)).distinct()
