"""Month ranges."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

PERIOD = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every month from start to end, both `yyyy-MM` and inclusive."""
    for value in (start, end):
        if not PERIOD.fullmatch(value):
            raise ValueError(f"not a month: {value}")
    if start > end:
        raise ValueError("start must not be after end")
    bounds = spark.range(1).select(
        F.lit(f"{start}-01").cast("date").alias("first"),
        F.lit(f"{end}-01").cast("date").alias("last"))
    return spine_between(bounds)


def spine_between(bounds: DataFrame) -> DataFrame:
    """Months between the dates `first` and `last` of a one-row frame."""
    months = F.sequence(
        F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("month")).select(
        F.date_format("month", "yyyy-MM").alias("period"))
