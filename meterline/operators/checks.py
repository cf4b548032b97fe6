"""Data-quality checks as DataFrames.

A check yields findings: (check_name, severity, violations), optionally per
source period. Row rules of a table are counted together in one pass; key
checks aggregate on the map side before anything is shuffled.
"""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.functions.expressions import or_false, period_of
from meterline.schemas import STATUSES
from meterline.session import settle

# Columns that must never be null.
NOT_NULL = {
    "stg_trips": ("trip_id", "source_period", "quality_status"),
    "stg_zones": ("zone_key",),
    "stg_weather": ("date",),
    "dim_zone": ("zone_key", "borough"),
    "dim_date": ("date_key",),
    "fct_trips": (
        "trip_id", "source_period", "pickup_zone_key", "dropoff_zone_key", "pickup_date"),
    "mart_zone_daily": ("date", "zone_key"),
    "mart_borough_daily": ("date", "borough"),
    "mart_weather_demand": ("date",),
    "mart_quality": ("source_period", "quality_status"),
}

# Single-column keys besides the trip identity.
UNIQUE = {
    "stg_zones": "zone_key",
    "stg_weather": "date",
    "dim_zone": "zone_key",
    "dim_date": "date_key",
    "mart_weather_demand": "date",
}

# The signature under which two rides look alike.
LOOK_ALIKE = (
    "source_period", "pickup_datetime", "dropoff_datetime", "pickup_zone_key",
    "dropoff_zone_key", "trip_distance", "total_amount",
)


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def measures(frame: DataFrame, **aggregates: Column) -> DataFrame:
    """Grand totals of a frame as rows (measure, value); zero where nothing was counted."""
    one_row = frame.agg(*[
        F.coalesce(total, F.lit(0)).cast("long").alias(name)
        for name, total in aggregates.items()])
    return one_row.unpivot([], list(aggregates), "measure", "value")


def gather(frames: Iterable[DataFrame], names: Iterable[str]) -> DataFrame:
    """Measures of several frames side by side in one row, without a join."""
    return stack(frames).agg(*[
        F.sum(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name in names])


def _finding(name, violations: Column, severity: str = "error") -> list[Column]:
    name = name if isinstance(name, Column) else F.lit(name)
    return [
        name.alias("check_name"), F.lit(severity).alias("severity"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
    ]


def row_findings(
    frame: DataFrame, rules: dict[str, Column], by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows breaking each rule, all rules in one pass."""
    counted = frame.groupBy(*by).agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot(list(by), list(rules), "check_name", "violations").select(
        *by, *_finding(F.col("check_name"), F.col("violations")))


def not_null_rules(table: str) -> dict[str, Column]:
    return {f"not_null_{table}_{name}": F.col(name).isNull() for name in NOT_NULL[table]}


def accepted_rule(table: str, values: Iterable[str]) -> dict[str, Column]:
    return {
        f"accepted_values_{table}_quality_status":
            or_false(~F.col("quality_status").isin(*values))}


def validity_rules() -> dict[str, Column]:
    """What no retained trip may show."""
    return {
        "reversed": or_false(F.col("dropoff_datetime") < F.col("pickup_datetime")),
        "negative_distance": or_false(F.col("trip_distance") < 0),
        "wrong_month": or_false(period_of(F.col("pickup_datetime")) != F.col("source_period")),
    }


def staged_rules() -> dict[str, Column]:
    return not_null_rules("stg_trips") | accepted_rule("stg_trips", STATUSES)


def fact_rules() -> dict[str, Column]:
    broken = reduce(lambda a, b: a | b, validity_rules().values())
    return (
        not_null_rules("fct_trips")
        | accepted_rule("fct_trips", [s for s in STATUSES if s != "INVALID"])
        | {"fact_validity": broken}
    )


def duplicate_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Key groups that occur more than once."""
    return frame.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def unique_findings(frame: DataFrame, table: str, key: str) -> DataFrame:
    repeated = duplicate_keys(frame.where(F.col(key).isNotNull()), key)
    return repeated.agg(F.count("*").alias("n")).select(
        *_finding(f"unique_{table}_{key}", F.col("n")))


def trip_id_findings(staged: DataFrame, by: tuple[str, ...] = (), scratch: str | None = None) -> DataFrame:
    """Repeated trip ids among staged and among retained rows.

    Ids are 70 characters long and practically never repeat, so 64-bit hashes
    are counted first; only rows whose hash repeats are compared by the id
    itself. The repeated hashes are settled: knowing their size, Spark
    broadcasts few, shuffles many, and reads no trip again when there are none.
    """
    ids = staged.where(F.col("trip_id").isNotNull()).withColumn("id_hash", F.xxhash64("trip_id"))
    suspects = settle(duplicate_keys(ids, "id_hash").select("id_hash"), "repeated-ids", scratch)
    retained = F.col("quality_status") != "INVALID"
    per_id = ids.join(suspects, "id_hash", "left_semi").groupBy("trip_id", *by).agg(
        F.count("*").alias("staged"), F.count_if(retained).alias("retained"))
    return row_findings(per_id, {
        "unique_stg_trips_trip_id": F.col("staged") > 1,
        "unique_fct_trips_trip_id": F.col("retained") > 1,
    }, by)


def status_findings(statuses: DataFrame) -> DataFrame:
    """The staged row rules, read off the counts per period and status.

    `statuses` is the quality mart with a count of missing trip ids, so the
    staged rows need no pass of their own.
    """
    counted = {name: F.when(rule, F.col("trip_count")) for name, rule in staged_rules().items()}
    counted["not_null_stg_trips_trip_id"] = F.col("missing_trip_id")
    totals = statuses.groupBy("source_period").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in counted.items()])
    return totals.unpivot(["source_period"], list(counted), "check_name", "violations").select(
        "source_period", *_finding(F.col("check_name"), F.col("violations")))


def orphans(
    fact: DataFrame, zones: DataFrame, calendar: DataFrame | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Fact rows per foreign key value without parent: (relation, key, row_count).

    Each row contributes its keys to one partially aggregated count, so only
    distinct (relation, key) pairs are shuffled and joined, never the trips.
    """
    relations = {"pickup_zone_key": zones, "dropoff_zone_key": zones}
    if calendar is not None:
        relations["pickup_date"] = calendar
    keys = F.array(*[
        F.struct(F.lit(name).alias("relation"), F.col(name).cast("string").alias("key"))
        for name in relations])
    used = fact.select(*by, F.inline(keys)).where("key is not null").groupBy(
        *by, "relation", "key").agg(F.count("*").alias("row_count"))
    parents = stack(
        parent.select(
            F.lit(name).alias("relation"),
            F.col("date_key" if name == "pickup_date" else "zone_key").cast("string").alias("key"))
        for name, parent in relations.items())
    return used.join(parents, ["relation", "key"], "left_anti")


def relationship_findings(orphaned: DataFrame, names: Iterable[str], by=()) -> DataFrame:
    per_relation = orphaned.groupBy(*by).agg(*[
        F.sum(F.when(F.col("relation") == name, F.col("row_count"))).alias(name)
        for name in names])
    return per_relation.unpivot(list(by), list(names), "relation", "violations").select(
        *by, *_finding(F.concat(F.lit("relationships_fct_trips_"), "relation"),
                       F.col("violations")))


def look_alike_trips(fact: DataFrame, scratch: str | None = None) -> DataFrame:
    """Retained rides sharing one signature: evidence to look at, not an error.

    Signatures seldom repeat, so their hashes are counted first and only rows
    whose hash repeats are compared by the signature itself.
    """
    hashed = fact.select(*LOOK_ALIKE, F.xxhash64(*LOOK_ALIKE).alias("signature"))
    suspects = settle(duplicate_keys(hashed, "signature").select("signature"), "look-alikes", scratch)
    return duplicate_keys(hashed.join(suspects, "signature", "left_semi"), *LOOK_ALIKE)


def look_alike_findings(fact: DataFrame, by: tuple[str, ...] = (), scratch: str | None = None) -> DataFrame:
    return look_alike_trips(fact, scratch).groupBy(*by).agg(F.count("*").alias("n")).select(
        *by, *_finding("duplicate_observations", F.col("n"), "warn"))


def reconciliation(
    fact: DataFrame, bronze: DataFrame, zone_day: DataFrame, borough_day: DataFrame,
    weather_day: DataFrame, quality: DataFrame,
) -> DataFrame:
    """One row of totals that must agree when no join lost or multiplied trips."""
    trips = F.sum("trip_count")
    return balance([
        measures(fact, facts=F.count("*")),
        measures(zone_day, zone_trips=trips),
        measures(borough_day, borough_trips=trips),
        measures(weather_day, weather_trips=trips),
        status_totals(quality),
        measures(bronze, input_rows=F.count("*")),
    ])


def status_totals(quality: DataFrame) -> DataFrame:
    """Measures classified and retained from trip counts per status."""
    return measures(quality, classified=F.sum("trip_count"),
                    retained=F.sum(F.when(F.col("quality_status") != "INVALID", F.col("trip_count"))))


def balance(found: list[DataFrame]) -> DataFrame:
    """One row of the measures, and whether they agree."""
    one_row = gather(found, ("facts", "zone_trips", "borough_trips", "weather_trips", "retained", "input_rows",
                             "classified"))
    agree = (F.col("input_rows") == F.col("classified"))
    for name in ("zone_trips", "borough_trips", "weather_trips", "retained"):
        agree = agree & (F.col("facts") == F.col(name))
    return one_row.withColumn("balanced", agree)


def grain_duplicates(grains: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Per model: its key groups and how many of them are repeated."""
    return stack(
        frame.groupBy(*keys).agg(F.count("*").alias("n")).agg(
            F.lit(model).alias("model"),
            F.count("*").alias("key_groups"),
            F.count_if(F.col("n") > 1).alias("repeated"))
        for model, (frame, keys) in grains.items())


def uncovered_dates(fact: DataFrame, weather: DataFrame, date: str = "pickup_date") -> DataFrame:
    """Dates with retained trips but no weather row.

    Dates are made distinct before the join, so it compares days, not trips.
    """
    observed = weather.select(F.col("date").alias("pickup_date"))
    return fact.select(F.col(date).alias("pickup_date")).distinct().join(
        observed, "pickup_date", "left_anti")


# --- the whole suite ---------------------------------------------------------------------


def trip_findings(
    staged: DataFrame, fact: DataFrame, zones: DataFrame, statuses: DataFrame,
    scratch: str | None = None,
) -> DataFrame:
    """Checks that read trips, per source period.

    Every one of them decomposes by period: trip ids carry the digest of their
    file, and the ledger rejects equal bytes under two periods. So a run checks
    the periods it rebuilt and carries the findings of the others forward.
    """
    by = ("source_period",)
    return stack([
        status_findings(statuses),
        row_findings(fact, fact_rules(), by),
        trip_id_findings(staged, by, scratch),
        relationship_findings(
            orphans(fact, zones, by=by), ("pickup_zone_key", "dropoff_zone_key"), by),
        look_alike_findings(fact, by, scratch),
    ])


def table_findings(
    raw_zones: DataFrame, raw_weather: DataFrame, zones: DataFrame, weather: DataFrame,
    calendar: DataFrame, zone_day: DataFrame, borough_day: DataFrame, weather_day: DataFrame,
    quality: DataFrame, reconciled: DataFrame,
) -> DataFrame:
    """Checks that read dimensions and marts only."""
    tables = {
        "stg_zones": raw_zones, "stg_weather": weather, "dim_zone": zones, "dim_date": calendar,
        "mart_zone_daily": zone_day, "mart_borough_daily": borough_day,
        "mart_weather_demand": weather_day, "mart_quality": quality,
    }
    grains = ("mart_zone_daily", "mart_borough_daily", "mart_quality")
    known_days = calendar.select(F.col("date_key").alias("date"))
    dateless = zone_day.where("date is not null").join(known_days, "date", "left_anti")
    uncovered = uncovered_dates(zone_day, weather, "date")
    return stack([
        *[keyed_findings(frame, name, "grains" if name in grains else f"unique_{name}_{key}")
          for name, frame in tables.items() for key in NOT_NULL[name][:1]],
        *[_repeats(frame.groupBy(key).agg(F.count("*").alias("n")), "source_unique")
          for frame, key in ((raw_zones, "zone_key"), (raw_weather, "date"))],
        dateless.agg(F.sum("trip_count").alias("n")).select(
            *_finding("relationships_fct_trips_pickup_date", F.col("n"))),
        reconciled.select(
            *_finding("reconciliation", F.when(~F.col("balanced"), 1))),
        uncovered.agg(F.count("*").alias("n")).select(
            *_finding("weather_coverage", F.col("n"))),
    ])


def _repeats(groups: DataFrame, name: str) -> DataFrame:
    return groups.agg(F.count_if(F.col("n") > 1).alias("v")).select(*_finding(name, F.col("v")))


def keyed_findings(frame: DataFrame, table: str, repeat_check: str) -> DataFrame:
    """Null and repeated keys of one small table, from one count per key.

    The key is every column the table must not have null, except the label of
    the zone dimension, which only rides along.
    """
    keys = NOT_NULL[table][:1] if table == "dim_zone" else NOT_NULL[table]
    others = [name for name in NOT_NULL[table] if name not in keys]
    groups = frame.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in others])
    nulls = {
        f"not_null_{table}_{name}":
            F.sum(f"null_{name}") if name in others
            else F.sum(F.when(F.col(name).isNull(), F.col("n")))
        for name in NOT_NULL[table]}
    complete = F.lit(True)
    if repeat_check.startswith("unique_"):
        complete = F.col(keys[0]).isNotNull()
    return measures(
        groups, **nulls, **{repeat_check: F.count_if(complete & (F.col("n") > 1))}
    ).select(*_finding(F.col("measure"), F.col("value")))


def outcomes(*findings: DataFrame) -> DataFrame:
    """Findings added up per check, with the resulting status."""
    merged = stack(f.select("check_name", "severity", "violations") for f in findings)
    return merged.groupBy("check_name", "severity").agg(
        F.sum("violations").alias("violations")
    ).withColumn(
        "status",
        F.when(F.col("violations") == 0, "pass")
        .when(F.col("severity") == "warn", "warn").otherwise("fail"),
    )


def outcome_totals(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy("status").agg(F.count("*").alias("checks"))


# Checks whose findings are kept per source period, with severity.
TRIP_CHECKS = (
    *[(f"not_null_stg_trips_{name}", "error") for name in NOT_NULL["stg_trips"]],
    *[(f"not_null_fct_trips_{name}", "error") for name in NOT_NULL["fct_trips"]],
    ("accepted_values_stg_trips_quality_status", "error"),
    ("accepted_values_fct_trips_quality_status", "error"),
    ("fact_validity", "error"),
    ("unique_stg_trips_trip_id", "error"),
    ("unique_fct_trips_trip_id", "error"),
    ("relationships_fct_trips_pickup_zone_key", "error"),
    ("relationships_fct_trips_dropoff_zone_key", "error"),
    ("duplicate_observations", "warn"),
)


def no_findings(spark: SparkSession) -> DataFrame:
    """Every trip check with zero violations, so that a clean check is still reported."""
    return spark.createDataFrame(
        [(name, severity, 0) for name, severity in TRIP_CHECKS],
        "check_name string, severity string, violations long")
