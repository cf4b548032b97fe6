"""Contracts, table schemas and policy constants."""
from __future__ import annotations

from pyspark.sql import types as T

# Raw trip columns that must be present, with their type family.
REQUIRED = {
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "PULocationID": "number",
    "DOLocationID": "number",
    "passenger_count": "number",
    "trip_distance": "number",
    "fare_amount": "number",
    "tip_amount": "number",
    "total_amount": "number",
    "payment_type": "number",
}

# Which required numbers are whole in bronze (the rest are double).
WHOLE_NUMBERS = ("PULocationID", "DOLocationID", "payment_type")

# Weather measurement column -> bronze column.
MEASUREMENTS = {
    "PRCP": "precipitation_mm",
    "SNOW": "snowfall_mm",
    "TMIN": "min_temperature_c",
    "TMAX": "max_temperature_c",
}

# Expected weather station and row classification policy.
STATION = "USW00094728"
LONG_TRIP_MINUTES = 180
KNOWN_PAYMENT_TYPES = (0, 1, 2, 3, 4, 5, 6)

# Flags that exclude a row, and flags that only mark it.
INVALID_FLAGS = (
    "missing_timestamp",
    "reversed_timestamp",
    "outside_source_month",
    "invalid_distance",
    "invalid_money",
    "unknown_zone",
)
SUSPICIOUS_FLAGS = (
    "long_duration",
    "zero_distance",
    "negative_money",
    "unusual_passengers",
    "unusual_payment",
)
FLAGS = INVALID_FLAGS + SUSPICIOUS_FLAGS
STATUSES = ("INVALID", "SUSPICIOUS", "ACCEPTED")

MONEY = T.DecimalType(18, 2)

TRIPS = T.StructType(
    [
        T.StructField(
            name,
            T.TimestampNTZType() if family == "timestamp"
            else T.LongType() if name in WHOLE_NUMBERS
            else T.DoubleType(),
        )
        for name, family in REQUIRED.items()
    ]
    + [
        T.StructField("source_row", T.LongType()),
        T.StructField("source_period", T.StringType()),
        T.StructField("source_sha256", T.StringType()),
    ]
)

ZONES = T.StructType(
    [
        T.StructField("zone_key", T.LongType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("station", T.StringType()),
        T.StructField("quality_flagged_values", T.LongType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in MEASUREMENTS.values()]
)

FACT = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("source_period", T.StringType()),
        T.StructField("source_sha256", T.StringType()),
        T.StructField("source_row", T.LongType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pickup_zone_key", T.LongType()),
        T.StructField("dropoff_zone_key", T.LongType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("trip_duration_minutes", T.DoubleType()),
        T.StructField("fare_amount", MONEY),
        T.StructField("tip_amount", MONEY),
        T.StructField("total_amount", MONEY),
        T.StructField("payment_type", T.LongType()),
        T.StructField("quality_status", T.StringType()),
    ]
)
