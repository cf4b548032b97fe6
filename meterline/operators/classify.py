"""Row classification: bronze trips -> staged trips with eleven flags and a status."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.functions.expressions import (
    all_of, any_of, finite, finite_from, minutes_between, or_false, period_of, unless, whole,
)
from meterline.schemas import (
    INVALID_FLAGS, KNOWN_PAYMENT_TYPES, LONG_TRIP_MINUTES, SUSPICIOUS_FLAGS,
)

MONEY_COLUMNS = ("fare_amount", "total_amount", "tip_amount")


def conform(bronze: DataFrame) -> DataFrame:
    """Business names, row identity, pickup date and duration."""
    c = F.col
    return bronze.select(
        "source_period", "source_sha256", "source_row",
        F.concat_ws(":", "source_sha256", c("source_row").cast("string")).alias("trip_id"),
        c("tpep_pickup_datetime").alias("pickup_datetime"),
        c("tpep_dropoff_datetime").alias("dropoff_datetime"),
        c("tpep_pickup_datetime").cast("date").alias("pickup_date"),
        c("PULocationID").alias("pickup_zone_key"),
        c("DOLocationID").alias("dropoff_zone_key"),
        "passenger_count", "trip_distance", *MONEY_COLUMNS, "payment_type",
        minutes_between(c("tpep_pickup_datetime"), c("tpep_dropoff_datetime"))
        .alias("trip_duration_minutes"),
    )


def mark_known_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Add two nullable markers: pickup / dropoff key found in the zone table.

    Two left equi-joins on de-duplicated keys, so a trip is never multiplied
    and a null key simply finds nothing. No broadcast hint: Spark broadcasts the
    zone keys while they are under its size threshold, and beyond it runs a
    shuffle join whose hot zones AQE can split.
    """
    keys = zones.select("zone_key").where("zone_key is not null").distinct()
    for side in ("pickup", "dropoff"):
        known = keys.select(
            F.col("zone_key").alias(f"{side}_zone_key"), F.lit(True).alias(f"{side}_known")
        )
        trips = trips.join(known, f"{side}_zone_key", "left")
    return trips


def classify(
    bronze: DataFrame,
    zones: DataFrame,
    long_trip_minutes: float = LONG_TRIP_MINUTES,
    payment_types: tuple[int, ...] = KNOWN_PAYMENT_TYPES,
) -> DataFrame:
    """Staged trips: every source row, independent non-null flags, one status."""
    c = F.col
    staged = conform(bronze)
    marked = mark_known_zones(staged, zones)
    passengers = c("passenger_count")
    flags = {
        "missing_timestamp": c("pickup_datetime").isNull() | c("dropoff_datetime").isNull(),
        "reversed_timestamp": or_false(c("dropoff_datetime") < c("pickup_datetime")),
        "outside_source_month": or_false(
            period_of(c("pickup_datetime")) != c("source_period")),
        "invalid_distance": unless(finite_from(c("trip_distance"), F.lit(0.0))),
        "invalid_money": unless(all_of(finite(c(m)) for m in MONEY_COLUMNS)),
        "unknown_zone": c("pickup_known").isNull() | c("dropoff_known").isNull(),
        "long_duration": or_false(c("trip_duration_minutes") > long_trip_minutes),
        "zero_distance": or_false(c("trip_distance") == 0),
        "negative_money": or_false(F.least(*MONEY_COLUMNS) < 0),
        "unusual_passengers": unless(
            (passengers > 0) & finite(passengers) & whole(passengers)),
        "unusual_payment": unless(c("payment_type").isin(*payment_types)),
    }
    status = (
        F.when(any_of(c(f) for f in INVALID_FLAGS), "INVALID")
        .when(any_of(c(f) for f in SUSPICIOUS_FLAGS), "SUSPICIOUS")
        .otherwise("ACCEPTED")
    )
    return (
        marked.select(*staged.columns, *[rule.alias(name) for name, rule in flags.items()])
        .withColumn("quality_status", status)
    )


def quarantine(staged: DataFrame) -> DataFrame:
    """Rows kept out of the fact, with their reasons."""
    return staged.where(F.col("quality_status") == "INVALID")
