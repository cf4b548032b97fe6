"""Zone lookup CSV and its key contract."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.schemas import ZONES
from meterline.sources.contracts import ContractError

# Raw zone column -> bronze column.
ZONE_COLUMNS = {
    "LocationID": "zone_key", "Borough": "borough", "Zone": "zone", "service_zone": "service_zone",
}


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Typed lookup rows; an empty label stays an empty text."""
    text = spark.read.csv(path, header=True, inferSchema=False)
    for name in ZONE_COLUMNS:
        if name not in text.columns:
            raise ContractError(f"zones: required field missing: {name}", "zones")
    return text.select(
        F.col("LocationID").cast("long").alias("zone_key"),
        *[
            F.coalesce(F.col(raw), F.lit("")).alias(name)
            for raw, name in ZONE_COLUMNS.items() if name != "zone_key"
        ],
    ).to(ZONES)


def duplicate_zone_keys(zones: DataFrame, *by: str) -> DataFrame:
    return (
        zones.groupBy(*by, "zone_key").agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )


def checked_zones(spark: SparkSession, path: str) -> DataFrame:
    zones = read_zones(spark, path)
    counts = zones.agg(F.count("*").alias("n"), F.count("zone_key").alias("keys"),
                       F.countDistinct("zone_key").alias("distinct_keys")).first()
    if not counts["n"] or not counts["n"] == counts["keys"] == counts["distinct_keys"]:
        raise ContractError("zone lookup with blank, empty or duplicate zone keys", "zones", "zones")
    return zones
