"""Zone, weather and calendar conformance."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def staged_weather(weather: DataFrame) -> DataFrame:
    """One row per date: the one with the lowest station.

    A minimum over structs keeps partial aggregation, so a date with very many
    observations never gathers in one task as a ranking window would make it.
    Ties on station fall to the smallest remaining values.
    """
    rest = [name for name in weather.columns if name not in ("date", "station")]
    first = F.min(F.struct("station", *rest)).alias("first")
    return weather.groupBy("date").agg(first).select(
        *["date" if name == "date" else f"first.{name}" for name in weather.columns])


def zone_dimension(zones: DataFrame) -> DataFrame:
    return zones.select("*")


def date_dimension(weather: DataFrame) -> DataFrame:
    """Every calendar date from the first to the last weather date."""
    span = weather.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = span.where("first is not null").select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_key")
    )
    weekday = F.dayofweek("date_key") - 1
    return days.select(
        "date_key",
        F.year("date_key").cast("long").alias("year"),
        F.month("date_key").cast("long").alias("month"),
        weekday.cast("long").alias("weekday_number"),
        F.date_format("date_key", "EEEE").alias("weekday_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )
