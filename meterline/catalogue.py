"""Named queries over the provided tables, one per operator or group of operators.

Each takes (spark, sf_dir) and returns a DataFrame. Where several results build
on the trips, bronze is settled once in the shared folder, so the joins behind
it run once per query.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.operators import checks, compare, reports, runs
from meterline.operators.classify import classify, conform, quarantine as quarantined
from meterline.operators.dimensions import date_dimension, staged_weather, zone_dimension
from meterline.operators.fact import trip_fact
from meterline.operators import marts
from meterline.operators.profile import profile_trips
from meterline.plans import commits, generations, ledger, worklist
from meterline.plans.refresh import RUNS
from meterline.plans.store import ENTRY, Commit, Store
from meterline.plans.tables import append_rows, local_rows, read_rows
from meterline.schemas import FACT, FLAGS, STATUSES
from meterline.session import settle, shared_folder
from meterline.sources import faults, tables
from meterline.sources.digests import content_digests, file_digests
from meterline.sources.weather import observations, weather_contract
from meterline.sources.zones import duplicate_zone_keys

STATION = "STATION-A"


class Inputs:
    """The derived inputs of one query and the tables built from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def bronze(self) -> DataFrame:
        return tables.bronze_trips(self.spark, self.sf_dir)

    @cached_property
    def zones(self) -> DataFrame:
        return tables.bronze_zones(self.spark, self.sf_dir)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return tables.bronze_weather(self.spark, self.sf_dir)

    @cached_property
    def weather(self) -> DataFrame:
        return staged_weather(self.raw_weather)

    @cached_property
    def calendar(self) -> DataFrame:
        return date_dimension(self.weather)

    @cached_property
    def staged(self) -> DataFrame:
        return classify(self.bronze, self.zones)

    @cached_property
    def fact(self) -> DataFrame:
        return trip_fact(self.staged)

    @cached_property
    def zone_day(self) -> DataFrame:
        return marts.zone_daily(self.fact)

    def settled(self) -> Inputs:
        """The same with bronze trips and weather written once; classifying again is map-only."""
        same = Inputs(self.spark, self.sf_dir)
        same.zones = self.zones
        same.bronze = settle(self.bronze, "bronze")
        same.weather = settle(self.weather, "weather")
        return same

    def marts(self) -> dict[str, DataFrame]:
        """All marts, with zone-days settled: the others are roll-ups of them."""
        zone_day = settle(self.zone_day, "zone-day")
        return {
            "mart_zone_daily": zone_day,
            "mart_borough_daily": marts.borough_daily(zone_day, self.zones),
            "mart_weather_demand": marts.weather_demand(zone_day, self.calendar, self.weather),
            "mart_quality": settle(marts.quality_mart(self.staged), "quality"),
        }


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Averages to six places: their last bits depend on the order of summation."""
    return df.select(*[
        F.round(n, 6).alias(n) if n in names else F.col(n) for n in df.columns])


# --- rows --------------------------------------------------------------------------------


def bronze_identity(spark, d):
    return conform(tables.bronze_trips(spark, d)).select(
        "source_period", "source_sha256", "source_row", "trip_id", "pickup_datetime",
        "dropoff_datetime", "pickup_date", "pickup_zone_key", "dropoff_zone_key",
        "trip_duration_minutes")


def row_ordinals(spark, d):
    return tables.line_items(spark, d).select("source_file", "source_row", "l_orderkey")


def trip_flags(spark, d):
    return Inputs(spark, d).staged.select("trip_id", *FLAGS, "quality_status")


def quality_status_counts(spark, d):
    return Inputs(spark, d).staged.groupBy("quality_status").agg(
        F.count("*").alias("trip_count"))


def quarantine(spark, d):
    return quarantined(Inputs(spark, d).staged).select(
        "trip_id", "source_period", "pickup_datetime", "dropoff_datetime", "pickup_zone_key",
        "dropoff_zone_key", *FLAGS)


def fact_trips(spark, d):
    return Inputs(spark, d).fact


def profile_month(spark, d):
    return profile_trips(tables.bronze_trips(spark, d), by=("source_period",))


# --- dimensions and marts -----------------------------------------------------------------


def dim_zone(spark, d):
    return zone_dimension(tables.bronze_zones(spark, d))


def dim_date(spark, d):
    return Inputs(spark, d).calendar


def zone_daily(spark, d):
    return _rounded(Inputs(spark, d).zone_day, "average_trip_distance", "average_trip_duration")


def borough_daily(spark, d):
    data = Inputs(spark, d)
    return marts.borough_daily(data.zone_day, data.zones)


def weather_demand(spark, d):
    data = Inputs(spark, d)
    return _rounded(
        marts.weather_demand(data.zone_day, data.calendar, data.weather), "trailing_7_day_trips")


def quality_mart(spark, d):
    return marts.quality_mart(Inputs(spark, d).staged)


# --- source contracts ---------------------------------------------------------------------


def weather_dedup(spark, d):
    return staged_weather(tables.bronze_weather(spark, d))


def weather_masking(spark, d):
    return observations(tables.raw_weather(spark, d))


def weather_month_coverage(spark, d):
    raw = tables.raw_weather(spark, d)
    return weather_contract(
        raw.select("period", F.col("STATION").alias("station"),
                   F.col("DATE").cast("date").alias("date")), STATION)


def zone_contract(spark, d):
    return duplicate_zone_keys(tables.zone_lookups(spark, d), "lookup")


def month_spine(spark, d):
    return tables.order_months(spark, d)


def file_digest_listing(spark, d):
    listing = file_digests(spark, d)
    return listing.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "length", "sha256")


def page_digests(spark, d):
    """Tree digests of the pages as if each were a landed file, with leaves small enough for several levels."""
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.encode("html", "utf-8").alias("content"))
    return content_digests(pages, "page_id", F.col("content"), leaf_bytes=256, fan_out=4)


# --- reports --------------------------------------------------------------------------------


def report_monthly(spark, d):
    data = Inputs(spark, d)
    return reports.monthly_trips(
        marts.weather_demand(data.zone_day, data.calendar, data.weather))


def report_locations(spark, d):
    data = Inputs(spark, d)
    return reports.location_trips(marts.borough_daily(data.zone_day, data.zones))


def report_quality_totals(spark, d):
    return reports.status_trips(quality_mart(spark, d))


def report_consistency(spark, d):
    data = Inputs(spark, d).settled()
    built = data.marts()
    fact = data.fact
    expected = checks.gather([
        checks.measures(fact, fact_rows=F.count("*")),
        checks.measures(data.bronze, input_rows=F.count("*")),
        checks.measures(data.weather, weather_days=F.count("*")),
    ], ("fact_rows", "input_rows", "weather_days"))
    return reports.consistency(
        built["mart_weather_demand"], built["mart_borough_daily"], built["mart_quality"],
        fact.groupBy("source_period").agg(F.count("*").alias("row_count")), expected)


def run_totals(spark, d):
    data = Inputs(spark, d).settled()
    built = data.marts()
    first = runs.earliest_run(
        tables.run_records(spark, d),
        (F.col("status") == "success") & (F.col("input_rows") > 1))
    return runs.run_totals(
        data.bronze, built["mart_quality"],
        built | {"fct_trips": data.fact, "dim_zone": data.zones, "dim_date": data.calendar},
    ).unionByName(checks.measures(first, earliest_run_input_rows=F.sum("input_rows")))


# --- checks -----------------------------------------------------------------------------------


def check_unique(spark, d):
    data = Inputs(spark, d).settled()
    frames = {
        "stg_zones": data.zones, "stg_weather": data.weather, "dim_zone": data.zones,
        "dim_date": data.calendar,
        # Demand is joined to these by a grouped date, which cannot repeat one.
        "mart_weather_demand": marts.observed_dates(data.calendar, data.weather),
    }
    return checks.stack([
        checks.trip_id_findings(data.staged),
        *[checks.unique_findings(frames[t], t, key) for t, key in checks.UNIQUE.items()],
    ]).select("check_name", "violations")


def check_not_null(spark, d):
    data = Inputs(spark, d).settled()
    frames = data.marts() | {
        "stg_trips": data.staged, "stg_zones": data.zones, "stg_weather": data.weather,
        "dim_zone": data.zones, "dim_date": data.calendar, "fct_trips": data.fact,
    }
    return checks.stack(
        checks.row_findings(frames[table], checks.not_null_rules(table))
        for table in checks.NOT_NULL
    ).select("check_name", "violations")


def check_accepted(spark, d):
    # Both rules look at the status only, so one pass over the staged rows tells.
    staged = Inputs(spark, d).staged
    retained = F.col("quality_status") != "INVALID"
    fact_rule = checks.accepted_rule("fct_trips", [s for s in STATUSES if s != "INVALID"])
    return checks.row_findings(
        staged,
        checks.accepted_rule("stg_trips", STATUSES)
        | {name: retained & rule for name, rule in fact_rule.items()},
    ).select("check_name", "violations")


def check_relationships(spark, d):
    data = Inputs(spark, d)
    relations = ("pickup_zone_key", "dropoff_zone_key", "pickup_date")
    return checks.relationship_findings(
        checks.orphans(data.fact, data.zones, data.calendar), relations
    ).select("check_name", "violations")


def check_reconciliation(spark, d):
    """Totals of one pass over the trips, and of the marts rolled up from its groups."""
    data = Inputs(spark, d)
    weather = settle(data.weather, "weather")
    totals = settle(marts.grouped_totals(data.staged), "totals")
    zone_day = totals.where("level = 'zone_day' and trip_count > 0")
    whole = totals.where("level = 'all'")
    return checks.balance([
        checks.measures(whole, facts=F.sum("trip_count"), input_rows=F.sum("row_count")),
        checks.measures(zone_day, zone_trips=F.sum("trip_count")),
        checks.measures(marts.borough_daily(zone_day, data.zones), borough_trips=F.sum("trip_count")),
        checks.measures(marts.weather_demand(zone_day, date_dimension(weather), weather),
                        weather_trips=F.sum("trip_count")),
        checks.status_totals(totals.where("level = 'status'").select(
            "quality_status", F.col("row_count").alias("trip_count"))),
    ])


def check_grains(spark, d):
    built = Inputs(spark, d).marts()  # reads trips twice, writes none
    return checks.grain_duplicates({
        "zone_day": (built["mart_zone_daily"], ("date", "zone_key")),
        "borough_day": (built["mart_borough_daily"], ("date", "borough")),
        "quality": (built["mart_quality"], ("source_period", "quality_status")),
    })


def check_source_unique(spark, d):
    return checks.grain_duplicates({
        "zone": (tables.bronze_zones(spark, d), ("zone_key",)),
        "weather": (tables.bronze_weather(spark, d), ("date",)),
    })


def check_fact_validity(spark, d):
    """The fact rules on retained rows (none may break) and on all staged rows."""
    staged = Inputs(spark, d).staged
    retained = F.col("quality_status") != "INVALID"
    rules = checks.validity_rules()
    return checks.row_findings(
        staged,
        {f"staged_{name}": rule for name, rule in rules.items()}
        | {f"fact_{name}": retained & rule for name, rule in rules.items()},
    ).select("check_name", "violations")


def check_weather_coverage(spark, d):
    data = Inputs(spark, d)
    return checks.uncovered_dates(data.fact, data.weather)


def check_duplicate_observations(spark, d):
    return checks.look_alike_trips(Inputs(spark, d).fact)


def check_summary(spark, d):
    data = Inputs(spark, d).settled()
    built = data.marts()
    fact = data.fact
    reconciled = checks.reconciliation(
        fact, data.bronze, built["mart_zone_daily"], built["mart_borough_daily"],
        built["mart_weather_demand"], built["mart_quality"])
    outcome = checks.outcomes(
        checks.trip_findings(
            data.staged, fact, data.zones, marts.status_counts(data.staged)),
        checks.no_findings(spark),
        checks.table_findings(
            data.zones, data.raw_weather, data.zones, data.weather, data.calendar,
            built["mart_zone_daily"], built["mart_borough_daily"],
            built["mart_weather_demand"], built["mart_quality"], reconciled))
    return checks.outcome_totals(outcome)


def check_faults(spark, d):
    """Every check on tables with planted faults: none of them may pass."""
    data = Inputs(spark, d)
    staged = settle(faults.staged(data.staged), "faulty-staged")
    fact = settle(faults.fact(data.fact), "faulty-fact")
    weather = settle(data.weather, "weather")
    calendar, zones = date_dimension(weather), data.zones
    day = F.dayofmonth
    zone_day = settle(marts.zone_daily(fact), "faulty-zone-day")
    borough_day = marts.borough_daily(zone_day, zones)
    demand = marts.weather_demand(zone_day, calendar, weather)
    quality = marts.quality_mart(staged)
    inside = (F.year("date") == 1995) & (F.month("date") == 5)
    bad_zones = faults.small(zones, F.col("zone_key") == 3, F.col("zone_key") == 4, "zone_key", "borough")
    bad_weather = faults.small(weather, day("date") == 3, day("date") == 4, "date").where(
        ~F.coalesce(inside, F.lit(False)))
    bad_calendar = faults.small(calendar, day("date_key") == 5, day("date_key") == 6, "date_key")
    bad_zone_day = faults.small(zone_day, inside & (F.col("zone_key") == 2), inside & (F.col("zone_key") == 5))
    bad_borough_day = faults.small(
        borough_day, inside & (F.col("borough") == "ASIA"), inside & (F.col("borough") == "AFRICA"), "borough")
    bad_demand = faults.small(demand, day("date") == 7, day("date") == 8, "date")
    invalid = F.col("quality_status") == "INVALID"
    bad_quality = faults.small(quality, invalid, invalid, "quality_status")
    reconciled = checks.reconciliation(
        fact, data.bronze, bad_zone_day, bad_borough_day, bad_demand, bad_quality)
    return checks.outcomes(
        checks.trip_findings(staged, fact, bad_zones, marts.status_counts(staged)),
        checks.no_findings(spark),
        checks.table_findings(
            bad_zones, data.raw_weather, bad_zones, bad_weather, bad_calendar, bad_zone_day,
            bad_borough_day, bad_demand, bad_quality, reconciled),
    ).select("check_name", "violations", "status")


# --- incremental processing -----------------------------------------------------------------


def _work(spark, d, rebuild_all=False):
    records = tables.registrations(spark, d)
    inputs = tables.run_inputs(records)
    december = inputs.where(F.col("period").endswith("-12")).select("period").distinct()
    return worklist.detect_work(inputs, tables.last_committed(records), december, rebuild_all)


def work_detection(spark, d):
    return checks.stack(
        _work(spark, d, everything).select(
            F.lit(name).alias("scenario"), "source", "period", "reason")
        for name, everything in (("incremental", False), ("rebuild_all", True)))


def change_propagation(spark, d):
    """Fact periods to rebuild, without and with a changed zone table."""
    work = settle(_work(spark, d), "work")
    committed = tables.last_committed(tables.registrations(spark, d))
    periods = settle(
        worklist.loaded_periods(tables.order_months(spark, d), committed), "periods")
    zones = tables.bronze_zones(spark, d).select(
        F.lit("zones").alias("source"), F.lit("zones").alias("period"),
        F.lit("raw_changed").alias("reason")).distinct()
    scenarios = {"trips_only": work, "zones_too": work.unionByName(zones)}
    return checks.stack(
        worklist.changed_periods(found, periods).select(F.lit(name).alias("scenario"), "period")
        for name, found in scenarios.items())


def ledger_current(spark, d):
    return ledger.current(tables.registrations(spark, d)).select(
        "source", "period", "path", "length", "sha256", "row_count", "schema_fingerprint")


def ledger_history(spark, d):
    return ledger.history(tables.registrations(spark, d)).select(
        "source", "period", "sha256", "path", "length", "row_count")


def ledger_duplicate_bytes(spark, d):
    return ledger.duplicate_bytes(ledger.current(tables.registrations(spark, d)))


def registration_outcomes(spark, d):
    """Versions R, and in June once more N, registered on top of the others.

    Some paths are named twice and some digests are missing; digests that
    collide belong to two periods.
    """
    versions = tables.registrations(spark, d)
    late = F.col("path").endswith("-R") | (F.col("path").endswith("-N") & F.col("period").endswith("-06"))
    known = settle(ledger.current(versions.where(~F.col("path").endswith("-R"))), "known")
    copies = F.when(F.col("row_count") % 11 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    incoming = settle(versions.where(late).withColumn(
        "sha256", F.when(F.col("length") % 13 != 0, F.col("sha256"))).withColumn("copy", F.explode(copies)), "incoming")
    return ledger.judged(known, incoming).select("source", "period", "path", "sha256", "copy", "outcome")


def _replacement(spark, d) -> DataFrame:
    """The fact after the corrected periods replaced the old ones.

    The orders carry a mark of the corrected periods, so line items join them
    once, and each row is classified once, as its old or its corrected self.
    """
    trips = tables.bronze_trips(spark, d, tables.corrected_periods(spark, d))
    return trip_fact(classify(
        tables.corrected_trips(trips, F.col("marked")).drop("marked"), tables.bronze_zones(spark, d)))


def period_replacement(spark, d):
    return _replacement(spark, d).select(
        "trip_id", "source_period", "quality_status", "trip_distance", "total_amount")


def snapshot_equivalence(spark, d):
    """Tables before and after the replacement, compared cell by cell.

    The fact is compared through per-period fingerprints, the marts on their grain.
    """
    before, after = (settle(fact, "fact") for fact in (Inputs(spark, d).fact, _replacement(spark, d)))
    zones = tables.bronze_zones(spark, d)
    days = [settle(marts.zone_daily(fact), "zone-day") for fact in (before, after)]
    boroughs = [marts.borough_daily(day, zones) for day in days]
    prints = [compare.content_fingerprint(fact) for fact in (before, after)]
    report = checks.stack([
        compare.compare_tables(*prints, ["source_period"], "fct_trips"),
        compare.compare_tables(*days, ["date", "zone_key"], "mart_zone_daily"),
        compare.compare_tables(*boroughs, ["date", "borough"], "mart_borough_daily"),
    ])
    return _rounded(report, "max_float_gap")


# --- stored generations ---------------------------------------------------------------------


class Published:
    """Generations in a store of the shared folder, each with its run record.

    `before` holds all trips; `after` the corrected periods built anew and the
    folders of all others; `tampered` is `after` with rows of one mart lost.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.data = Inputs(spark, sf_dir).settled()
        self.store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
        self.build("before", self.data.bronze)
        periods = tables.corrected_periods(spark, sf_dir).select(F.col("period").alias("source_period"))
        self.build("after", tables.corrected_trips(self.data.bronze.join(periods, "source_period", "left_semi")))

    def build(self, run_id: str, bronze: DataFrame) -> None:
        store, before = self.store, self.store.latest()
        staged = classify(bronze, self.data.zones)
        inside = bronze.groupBy("source_period").agg(F.count("*").alias("n")).collect()  # months
        entries = [{n: None for n in ENTRY.fieldNames()} | {
            "source": "trips", "period": r["source_period"], "bronze_rows": r["n"]} for r in inside]
        entries, fact, _ = generations.write_trips(store, run_id, staged, entries)
        generations.write_days(store, run_id, fact)
        self.publish(run_id, before.entries | {("trips", e["period"]): e for e in entries}, before)

    def publish(self, run_id, entries, before, change=lambda plans: plans) -> None:
        store, live = self.store, list(entries.values())
        marts = generations.Marts(store, run_id, change(generations.mart_plans(
            store.read_gold("mart_zone_daily", live), store.read_gold("mart_quality", live),
            self.data.zones, self.data.weather)))
        marts.write()
        marts.close()
        record = {n: None for n in RUNS.fieldNames()} | {
            "run_id": run_id, "status": "success", "start_time": datetime(2025, 1, 1 + before.sequence),
            "input_rows": sum(marts.statuses.values()), "quality_warnings": marts.statuses["SUSPICIOUS"],
            "invalid_rows": marts.statuses["INVALID"],
            "gold_rows": marts.counts | {"fct_trips": sum(e["fact_rows"] for e in live)}}
        append_rows(local_rows(self.spark, [record], RUNS), f"{store.root}/runs")
        store.publish(Commit(before.sequence + 1, run_id, "1", entries), before)

    def tamper(self) -> None:
        last = self.store.latest()
        self.publish("tampered", last.entries, last, lambda plans: plans | {
            "mart_borough_daily": plans["mart_borough_daily"].where("borough <> 'ASIA'")})

    def runs(self) -> DataFrame:
        return read_rows(self.spark, f"{self.store.root}/runs", RUNS)


def generation_differences(spark, d):
    """Every row in which two stored generations differ, over the fact and all exports."""
    return generations.differences(Published(spark, d).store, "before", "after")


def recorded_run(spark, d):
    """The counts that a run observed while it wrote, read back from its stored record."""
    return generations.recorded_totals(Published(spark, d).runs(), "after")


def stored_consistency(spark, d):
    """Stored generations against their run records; one of them has lost rows of a mart."""
    published = Published(spark, d)
    published.tamper()
    return checks.stack(
        generations.stored_consistency(published.store, published.runs(), run_id).select(
            F.lit(run_id).alias("run_id"), "requirement", "holds") for run_id in ("after", "tampered"))


def _versions(spark, d) -> DataFrame:
    """Registrations as a commit log: a commit a day and file version."""
    place = F.instr(F.lit("ANR"), F.substring("path", -1, 1))
    day = F.datediff(F.col("registered_at").cast("date"), F.lit("1992-01-01").cast("date"))
    return tables.registrations(spark, d).select(
        (day * 4 + place).cast("long").alias("sequence"), "source", "period", "path", "sha256")


def commit_states(spark, d):
    """What the generations of three points of the log consist of."""
    versions = _versions(spark, d)
    return checks.stack(commits.state(versions, upto).select(
        F.lit(upto).cast("long").alias("upto"), "source", "period", "sequence", "path", "sha256")
        for upto in (3000, 6000, None))


def vacuum_plan(spark, d):
    """File versions that no generation from a point of the log on consists of."""
    versions = _versions(spark, d)
    return commits.unreferenced(versions.select("path", "source", "period"), commits.live(versions, 6000), "path")


def content_fingerprint(spark, d):
    return compare.content_fingerprint(Inputs(spark, d).fact.select(*FACT.fieldNames()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_identity": bronze_identity,
    "row_ordinals": row_ordinals,
    "trip_flags": trip_flags,
    "quality_status_counts": quality_status_counts,
    "quarantine": quarantine,
    "fact_trips": fact_trips,
    "profile_month": profile_month,
    "dim_zone": dim_zone,
    "dim_date": dim_date,
    "zone_daily": zone_daily,
    "borough_daily": borough_daily,
    "weather_demand": weather_demand,
    "quality_mart": quality_mart,
    "weather_dedup": weather_dedup,
    "weather_masking": weather_masking,
    "weather_month_coverage": weather_month_coverage,
    "zone_contract": zone_contract,
    "month_spine": month_spine,
    "file_digests": file_digest_listing,
    "page_digests": page_digests,
    "report_monthly": report_monthly,
    "report_locations": report_locations,
    "report_quality_totals": report_quality_totals,
    "report_consistency": report_consistency,
    "run_totals": run_totals,
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_accepted": check_accepted,
    "check_relationships": check_relationships,
    "check_reconciliation": check_reconciliation,
    "check_grains": check_grains,
    "check_source_unique": check_source_unique,
    "check_fact_validity": check_fact_validity,
    "check_weather_coverage": check_weather_coverage,
    "check_duplicate_observations": check_duplicate_observations,
    "check_summary": check_summary,
    "check_faults": check_faults,
    "work_detection": work_detection,
    "change_propagation": change_propagation,
    "ledger_current": ledger_current,
    "ledger_history": ledger_history,
    "ledger_duplicate_bytes": ledger_duplicate_bytes,
    "registration_outcomes": registration_outcomes,
    "period_replacement": period_replacement,
    "snapshot_equivalence": snapshot_equivalence,
    "content_fingerprint": content_fingerprint,
    "generation_differences": generation_differences,
    "recorded_run": recorded_run,
    "stored_consistency": stored_consistency,
    "commit_states": commit_states,
    "vacuum_plan": vacuum_plan,
}
