"""First-look profile of raw trips, in one pass."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.functions.expressions import period_of, wall_clock_second


def profile_trips(raw: DataFrame, period: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts behind the quality policy, for one month or per claimed `source_period`."""
    c = F.col
    pickup, dropoff = c("tpep_pickup_datetime"), c("tpep_dropoff_datetime")
    claimed = c("source_period") if period is None else F.lit(period)

    def minute(ts):
        return F.floor(wall_clock_second(ts) / F.lit(60).cast("long")).cast("long")

    return raw.groupBy(*by).agg(
        F.count("*").alias("source_rows"),
        F.count_if(pickup.isNull() | dropoff.isNull()).alias("null_timestamps"),
        F.count_if(dropoff < pickup).alias("backwards"),
        F.count_if(period_of(pickup) != claimed).alias("outside_month"),
        F.count_if(c("trip_distance") < 0).alias("negative_distance"),
        F.count_if(c("fare_amount") < 0).alias("negative_fare"),
        F.count_if(c("passenger_count").isNull()).alias("null_passengers"),
        F.count_if(c("trip_distance") == 0).alias("zero_distance"),
        F.max(minute(dropoff) - minute(pickup)).alias("max_duration"),
    )


def column_listing(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
