"""Daily marts and the quality mart.

Trips are aggregated once, to date x zone, before anything is joined to them;
the borough and weather marts roll that result up.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from meterline.functions.expressions import money
from meterline.schemas import FLAGS

TOTAL = "decimal(38,2)"


def _total(name: str):
    return F.sum(name).cast(TOTAL).alias(name)


def zone_daily(fact: DataFrame) -> DataFrame:
    return fact.groupBy(
        F.col("pickup_date").alias("date"), F.col("pickup_zone_key").alias("zone_key")
    ).agg(
        F.count("*").alias("trip_count"),
        F.sum("passenger_count").alias("passenger_count"),
        F.count("passenger_count").alias("trips_with_passenger_count"),
        F.avg("trip_distance").alias("average_trip_distance"),
        F.avg("trip_duration_minutes").alias("average_trip_duration"),
        _total("fare_amount"),
        _total("total_amount"),
        F.count_if(F.col("quality_status") == "SUSPICIOUS").alias("suspicious_trip_count"),
    )


def borough_daily(zone_day: DataFrame, zones: DataFrame) -> DataFrame:
    boroughs = zones.select("zone_key", "borough")
    return zone_day.join(boroughs, "zone_key").groupBy("date", "borough").agg(
        F.sum("trip_count").alias("trip_count"),
        _total("fare_amount"),
        _total("total_amount"),
        F.countDistinct("zone_key").alias("active_pickup_zones"),
    )


def daily_demand(zone_day: DataFrame) -> DataFrame:
    return zone_day.groupBy("date").agg(
        F.sum("trip_count").alias("trip_count"), _total("total_amount"))


def grouped_totals(staged: DataFrame) -> DataFrame:
    """(level, date, zone_key, source_period, quality_status, row_count, trip_count, fare_amount, total_amount).

    One pass over the trips for three levels: zone_day, status (of a period)
    and all. row_count counts all rows; the others the retained ones, with the
    fact's exact money. Every level aggregates partially.
    """
    retained = F.col("quality_status") != "INVALID"
    rows = staged.select(
        F.col("pickup_date").alias("date"), F.col("pickup_zone_key").alias("zone_key"), "source_period",
        "quality_status", retained.alias("retained"),
        *[F.when(retained, money(F.col(n))).alias(n) for n in ("fare_amount", "total_amount")])
    columns = ["date", "zone_key", "source_period", "quality_status"]
    grouped = rows.groupingSets([columns[:2], columns[2:], []], *columns).agg(
        F.grouping_id().alias("level"), F.count("*").alias("row_count"),
        F.count_if("retained").alias("trip_count"), _total("fare_amount"), _total("total_amount"))
    level = F.when(F.col("level") == 0b0011, "zone_day").when(F.col("level") == 0b1100, "status").otherwise("all")
    return grouped.withColumn("level", level)


def observed_dates(calendar: DataFrame, weather: DataFrame) -> DataFrame:
    return calendar.select(F.col("date_key").alias("date")).join(weather, "date")


def weather_demand(zone_day: DataFrame, calendar: DataFrame, weather: DataFrame) -> DataFrame:
    """Observed weather dates with demand (zero when there was none).

    The two windows run over the ordered list of dates: one row per calendar
    day whatever the trip volume, so a single ordered task is the right size.
    They count rows, not days, and so bridge gaps in the calendar.
    """
    daily = observed_dates(calendar, weather).join(daily_demand(zone_day), "date", "left").select(
        "date",
        F.coalesce("trip_count", F.lit(0)).alias("trip_count"),
        F.coalesce("total_amount", F.lit(0)).cast(TOTAL).alias("total_amount"),
        "precipitation_mm", "snowfall_mm", "min_temperature_c", "max_temperature_c",
        "quality_flagged_values",
    )
    by_date = Window.orderBy("date")
    return daily.select(
        "*",
        (F.col("trip_count") - F.lag("trip_count").over(by_date))
        .alias("change_from_previous_day"),
        F.avg("trip_count").over(by_date.rowsBetween(-6, 0)).alias("trailing_7_day_trips"),
    )


def status_counts(staged: DataFrame) -> DataFrame:
    """Rows, flags and missing trip ids per source period and status, in one pass."""
    return staged.groupBy("source_period", "quality_status").agg(
        F.count("*").alias("trip_count"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in FLAGS],
        F.count_if(F.col("trip_id").isNull()).alias("missing_trip_id"),
    )


def quality_mart(staged: DataFrame) -> DataFrame:
    return status_counts(staged).drop("missing_trip_id")
