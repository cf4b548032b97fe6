"""Trip fact: retained staged rows with usable passengers and exact money."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.expressions import any_of, finite_from, money, whole
from meterline.schemas import FACT, INVALID_FLAGS, SUSPICIOUS_FLAGS


def usable_passengers(count: Column) -> Column:
    """The count itself when finite, whole and not negative; null otherwise."""
    return F.when(finite_from(count, F.lit(0.0)) & whole(count), count)


def trip_fact(staged: DataFrame) -> DataFrame:
    """Rows that show no invalidating flag.

    Filtering on the flags rather than on the status derived from them keeps
    the filter, and the generated code, to the six rules that matter.
    """
    retained = staged.where(~any_of(F.col(flag) for flag in INVALID_FLAGS))
    suspicious = any_of(F.col(flag) for flag in SUSPICIOUS_FLAGS)
    derived = {
        "passenger_count": usable_passengers(F.col("passenger_count")),
        "fare_amount": money(F.col("fare_amount")),
        "tip_amount": money(F.col("tip_amount")),
        "total_amount": money(F.col("total_amount")),
        "quality_status": F.when(suspicious, "SUSPICIOUS").otherwise("ACCEPTED"),
    }
    return retained.select(
        *[derived.get(name, F.col(name)).alias(name) for name in FACT.fieldNames()])


def replace_periods(fact: DataFrame, rebuilt: DataFrame, changed: DataFrame) -> DataFrame:
    """`fact` with every changed period exchanged for its rows in `rebuilt`.

    `changed` has a column `period`. A changed period without rebuilt rows ends
    up empty. The period list is months, so both joins filter without moving
    the trips.
    """
    periods = changed.select(F.col("period").alias("source_period")).distinct()
    kept = fact.join(periods, "source_period", "left_anti")
    added = rebuilt.join(periods, "source_period", "left_semi")
    return kept.unionByName(added).select(*fact.columns)
