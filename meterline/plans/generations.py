"""One generation of marts: written in order, counted on the way, compared with another and held to its record."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from meterline.functions.expressions import period_of
from meterline.operators import compare, reports
from meterline.operators.checks import stack
from meterline.operators.dimensions import date_dimension, zone_dimension
from meterline.operators.fact import trip_fact
from meterline.operators.marts import borough_daily, status_counts, weather_demand, zone_daily
from meterline.plans.store import STATUS_COUNTS, Store
from meterline.plans.tables import local_rows, together
from meterline.schemas import STATUSES

# Tables of a published report generation, with the key of each.
EXPORT_KEYS = {
    "dim_date": ("date_key",), "dim_zone": ("zone_key",), "mart_zone_daily": ("date", "zone_key"),
    "mart_borough_daily": ("date", "borough"), "mart_weather_demand": ("date",),
    "mart_quality": ("source_period", "quality_status"),
}
EXPORTS = tuple(EXPORT_KEYS)
EXPECTED = T.StructType([
    T.StructField(n, T.LongType()) for n in ("fact_rows", "input_rows", "weather_days")])
PERIOD_ROWS = T.StructType([
    T.StructField("source_period", T.StringType()), T.StructField("row_count", T.LongType())])


def write_trips(
    store: Store, run_id: str, staged: DataFrame, entries: list[dict],
) -> tuple[list[dict], DataFrame, DataFrame]:
    """Fact and quality rows of the periods in `entries`; the entries with their new folders and counts, fact, statuses."""
    by_period = F.col("source_period").alias("period")
    together(
        # Tasks read bronze files of a period each, which are large or were rebalanced: no shuffle.
        lambda: store.write_gold("fct_trips", run_id, trip_fact(staged).select("*", by_period), rebalance=False),
        lambda: store.write_gold("mart_quality", run_id, status_counts(staged).select("*", by_period)),
    )
    entries = [e | {"gold_run": run_id} for e in entries]
    statuses = store.read_gold("mart_quality", entries, STATUS_COUNTS)
    retained = {
        r["source_period"]: r["rows"] for r in statuses.where("quality_status <> 'INVALID'")
        .groupBy("source_period").agg(F.sum("trip_count").alias("rows")).collect()}
    entries = [e | {"fact_rows": retained.get(e["period"], 0)} for e in entries]
    return entries, store.read_gold("fct_trips", entries), statuses


def write_days(store: Store, run_id: str, fact: DataFrame) -> None:
    days = zone_daily(fact).withColumn("period", period_of(F.col("date")))
    store.write_gold("mart_zone_daily", run_id, days)


def mart_plans(zone_day: DataFrame, quality: DataFrame, raw_zones: DataFrame, weather: DataFrame) -> dict[str, DataFrame]:
    zones, calendar = zone_dimension(raw_zones), date_dimension(weather)
    return {
        "dim_date": calendar, "dim_zone": zones, "mart_zone_daily": zone_day,
        "mart_borough_daily": borough_daily(zone_day, zones),
        "mart_weather_demand": weather_demand(zone_day, calendar, weather),
        "mart_quality": quality,
    }


class Marts:
    """The marts of one run. `write` makes the Parquet files, `write_csv` the same rows as CSV.

    Each mart is range-partitioned and sorted once and kept until both kinds of
    files exist, so part files of either kind follow each other in order. Rows
    are counted by the write itself. `close` lets go of the sorted rows.
    """

    def __init__(self, store: Store, run_id: str, plans: dict[str, DataFrame]):
        self.store, self.run_id = store, run_id
        self.ordered = {
            name: plan.orderBy(*[F.asc_nulls_last(c) for c in plan.columns[:2]]).persist()
            for name, plan in plans.items()}
        self.tables: dict[str, DataFrame] = {}
        self.counts: dict[str, int] = {}
        self.statuses: dict[str, int] = {}

    def write(self) -> dict[str, DataFrame]:
        def one(name):
            rows, seen = self.ordered[name], Observation()
            folder = self.store.report_folder(self.run_id, name, "parquet")
            measures = [F.count(F.lit(1)).alias("rows")]
            if name == "mart_quality":
                measures += [F.sum(F.when(F.col("quality_status") == s, F.col("trip_count"))).alias(s) for s in STATUSES]
            rows.observe(seen, *measures).write.option("compression", "zstd").parquet(folder)
            found = dict(seen.get)
            self.counts[name] = found.pop("rows")
            self.statuses |= {s: n or 0 for s, n in found.items()}
            return self.store.spark.read.schema(rows.schema).parquet(folder)
        self.tables = dict(zip(self.ordered, together(*[lambda n=n: one(n) for n in self.ordered])))
        return self.tables

    def write_csv(self, name: str) -> None:
        self.ordered[name].write.option("header", "true").csv(self.store.report_folder(self.run_id, name, "csv"))

    def close(self) -> None:
        for rows in self.ordered.values():
            rows.unpersist()


# --- two generations --------------------------------------------------------------------------


def differences(store: Store, before: str, after: str, buckets: int = compare.BUCKETS) -> DataFrame:
    """(table_name, key, kind) of every row in which two published generations differ.

    A period whose fact folder both share is not read at all. Everything else
    is compared from the top down, see `compare.differing_keys`.
    """
    old, new = store.generation(before).entries, store.generation(after).entries
    periods = [k for k in sorted(old.keys() | new.keys()) if k[0] == "trips" and (
        (old.get(k) or {}).get("gold_run") != (new.get(k) or {}).get("gold_run"))]
    facts = [store.read_gold("fct_trips", [side[k] for k in periods if k in side]) for side in (old, new)]
    return stack([
        compare.differing_keys(*facts, ["trip_id"], "fct_trips", F.col("source_period"), buckets),
        *[compare.differing_keys(store.table(name, before), store.table(name, after), list(keys), name, buckets=buckets)
          for name, keys in EXPORT_KEYS.items()],
    ])


# --- a generation and its run record ----------------------------------------------------------


def recorded_totals(runs: DataFrame, run_id: str) -> DataFrame:
    """(measure, value) as the run `run_id` recorded them."""
    row = runs.where((F.col("run_id") == run_id) & (F.col("status") == "success"))
    plain = [F.struct(F.lit(n).alias("measure"), F.col(n).alias("value"))
             for n in ("input_rows", "quality_warnings", "invalid_rows")]
    gold = F.transform(F.map_entries("gold_rows"), lambda e: F.struct(
        F.concat(F.lit("gold_"), e["key"]).alias("measure"), e["value"].alias("value")))
    return row.select(F.inline(F.concat(F.array(*plain), gold)))


def stored_consistency(store: Store, runs: DataFrame, run_id: str) -> DataFrame:
    """(requirement, holds) of a published generation: its stored marts against its commit and its run record."""
    commit = store.generation(run_id)
    expected_periods = local_rows(store.spark, [
        (period, e["fact_rows"]) for (source, period), e in commit.entries.items()
        if source == "trips" and e["fact_rows"]], PERIOD_ROWS)
    record = recorded_totals(runs, run_id)
    wanted = {"fact_rows": "gold_fct_trips", "input_rows": "input_rows", "weather_days": "gold_mart_weather_demand"}
    expected = record.agg(*[
        F.sum(F.when(F.col("measure") == source, F.col("value"))).alias(name) for name, source in wanted.items()])
    marts = [store.table(n, run_id) for n in ("mart_weather_demand", "mart_borough_daily", "mart_quality")]
    return reports.consistency(*marts, expected_periods, expected)
