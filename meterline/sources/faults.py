"""Variants of the derived tables in which every check finds something.

Faults are planted by rule on keys that both engines know: trips by their row
number, small tables by their day or key. Repeated rows stand beside rows that
show no other fault.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Every row with a number divisible by this occurs twice; other faults spare it.
TWICE = 97
STAGED = ((101, "trip_id", None), (103, "source_period", None), (151, "quality_status", "ODD"),
          (157, "quality_status", None))
FACT = ((101, "trip_id", None), (103, "source_period", None), (107, "pickup_zone_key", None),
        (109, "dropoff_zone_key", None), (113, "pickup_date", None), (127, "pickup_zone_key", 777),
        (131, "dropoff_zone_key", 777), (137, "pickup_date", "1900-01-01"), (139, "quality_status", "INVALID"),
        (149, "trip_distance", -1.0))


def _planted(frame: DataFrame, faults: tuple) -> DataFrame:
    row, changed = F.col("source_row"), frame
    for step, name, value in faults:
        kind = frame.schema[name].dataType
        hit = (row % step == 0) & (row % TWICE != 0)
        changed = changed.withColumn(name, F.when(hit, F.lit(value).cast(kind)).otherwise(F.col(name)))
    return changed.unionByName(frame.where(row % TWICE == 0))


def staged(frame: DataFrame) -> DataFrame:
    return _planted(frame, STAGED)


def fact(frame: DataFrame) -> DataFrame:
    return _planted(frame, FACT)


def small(frame: DataFrame, twice: Column, blank: Column, *names: str) -> DataFrame:
    """`frame` with the rows of `twice` repeated and those of `blank` once more, each name null by turns."""
    out = frame.unionByName(frame.where(twice))
    for name in names:
        kind = frame.schema[name].dataType
        out = out.unionByName(frame.where(blank).withColumn(name, F.lit(None).cast(kind)))
    return out
