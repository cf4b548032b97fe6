"""Roll-ups for report readers and their consistency with the recorded run."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.functions.expressions import period_of
from meterline.operators.checks import duplicate_keys, gather, measures, stack
from meterline.schemas import STATUSES

MISSING_LABEL = "(missing label)"


def monthly_trips(weather_day: DataFrame) -> DataFrame:
    return weather_day.groupBy(period_of(F.col("date")).alias("period")).agg(
        F.sum("trip_count").cast("long").alias("trips"))


def location_trips(borough_day: DataFrame) -> DataFrame:
    location = F.coalesce("borough", F.lit(MISSING_LABEL)).alias("location")
    return borough_day.groupBy(location).agg(
        F.sum("trip_count").cast("long").alias("trips")
    ).orderBy(F.desc("trips"), "location")


def status_trips(quality: DataFrame) -> DataFrame:
    return quality.groupBy("quality_status").agg(
        F.sum("trip_count").cast("long").alias("trips"))


def date_range(weather_day: DataFrame) -> DataFrame:
    return weather_day.agg(
        F.min("date").alias("date_start"), F.max("date").alias("date_end"),
        F.count("date").alias("days"), F.countDistinct("date").alias("distinct_days"))


def consistency(
    weather_day: DataFrame, borough_day: DataFrame, quality: DataFrame,
    expected_periods: DataFrame, expected: DataFrame,
) -> DataFrame:
    """(requirement, holds) for a published generation against its run record.

    `expected_periods` has (source_period, row_count); `expected` is one row
    with fact_rows, input_rows and weather_days. Inputs are marts, so
    everything joined here is a handful of rows.
    """
    months = monthly_trips(weather_day)
    trips = F.col("trips")
    month_pairs = months.join(
        expected_periods, F.col("period") == F.col("source_period"), "full_outer")
    found = gather([
        measures(
            status_trips(quality),
            retained=F.sum(F.when(F.col("quality_status") != "INVALID", trips)),
            source_rows=F.sum(trips),
            unknown_statuses=F.count_if(~F.col("quality_status").isin(*STATUSES))),
        measures(months, monthly_total=F.sum(trips)),
        measures(location_trips(borough_day), location_total=F.sum(trips)),
        measures(
            weather_day, days=F.count("date"), distinct_days=F.countDistinct("date")),
        measures(
            month_pairs,
            unmatched_periods=F.count_if(
                F.col("period").isNull() | F.col("source_period").isNull()),
            differing_periods=F.count_if(trips != F.col("row_count"))),
        measures(
            stack([
                duplicate_keys(borough_day, "date", "borough").select("occurrences"),
                duplicate_keys(quality, "source_period", "quality_status").select("occurrences"),
            ]),
            repeated=F.count("*")),
        measures(expected, fact_rows=F.sum("fact_rows"), input_rows=F.sum("input_rows"),
                 weather_days=F.sum("weather_days")),
    ], (
        "retained", "source_rows", "unknown_statuses", "monthly_total", "location_total", "days",
        "distinct_days", "unmatched_periods", "differing_periods", "repeated", "fact_rows",
        "input_rows", "weather_days"))
    requirements = {
        "statuses_known": F.col("unknown_statuses") == 0,
        "grains_unique": F.col("repeated") == 0,
        "dates_unique": (F.col("days") > 0) & (F.col("days") == F.col("distinct_days")),
        "monthly_equals_retained": F.col("monthly_total") == F.col("retained"),
        "locations_equal_retained": F.col("location_total") == F.col("retained"),
        "retained_equals_fact": F.col("retained") == F.col("fact_rows"),
        "source_equals_input": F.col("source_rows") == F.col("input_rows"),
        "days_as_recorded": F.col("days") == F.col("weather_days"),
        "periods_as_recorded": F.col("unmatched_periods") == 0,
        "period_totals_as_recorded": F.col("differing_periods") == 0,
    }
    return found.select(*[rule.alias(name) for name, rule in requirements.items()]).unpivot(
        [], list(requirements), "requirement", "holds")
