"""The incremental run: detect changed inputs, rebuild those periods, check, publish."""
from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from meterline.operators import checks
from meterline.operators.classify import classify
from meterline.operators.dimensions import staged_weather
from meterline.plans import generations
from meterline.plans.generations import EXPORTS, Marts
from meterline.plans.ledger import LEDGER, Ledger, period_digests
from meterline.plans.store import EMPTY, ENTRY, Commit, Store
from meterline.plans.tables import append_rows, local_rows, read_rows, together
from meterline.plans.worklist import changed_periods, detect_work, loaded_periods
from meterline.schemas import STATION
from meterline.session import remove
from meterline.sources.contracts import ContractError
from meterline.sources.files import qualified
from meterline.sources.periods import month_spine
from meterline.sources.trips import TripFile, bronze_files
from meterline.sources.weather import checked_weather
from meterline.sources.zones import checked_zones

# Raise this whenever a rule or schema changes: the next run then rebuilds every period.
LOGIC_VERSION = "1"

#: Files smaller than this on average are brought together when bronze is written.
SMALL_FILE = 32 * 1024 * 1024

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("run_mode", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("periods_requested", T.ArrayType(T.StringType())),
    T.StructField("partitions_processed", T.ArrayType(T.StringType())),
    T.StructField("input_rows", T.LongType()),
    T.StructField("bronze_rows", T.LongType()),
    T.StructField("gold_rows", T.MapType(T.StringType(), T.LongType())),
    T.StructField("checks", T.MapType(T.StringType(), T.LongType())),
    T.StructField("quality_warnings", T.LongType()),
    T.StructField("invalid_rows", T.LongType()),
    T.StructField("build_skipped", T.BooleanType()),
    T.StructField("error", T.StructType([
        T.StructField("stage", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("reason", T.StringType()),
    ])),
])

INPUTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("raw_sha256", T.StringType()),
    T.StructField("bronze_fingerprint", T.StringType()),
])
SCHEMAS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("schema", T.StringType()),
])
MONTHS = T.StructType([T.StructField("period", T.StringType())])


def _schema(row: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(row["schema_json"]))


def many_small(lengths: list[int], periods: int) -> bool:
    """Whether raw files are so many and small that copying them file by file would give small bronze files."""
    return len(lengths) > 2 * periods and sum(lengths) < SMALL_FILE * len(lengths)


class ChecksFailed(RuntimeError):
    """A check of severity error found violations; nothing was published."""


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Refresh:
    """Runs over one data root; `register` files first, then `run` a range of months."""

    def __init__(
        self, spark: SparkSession, root: str, station: str = STATION,
        logic_version: str = LOGIC_VERSION,
    ):
        self.spark = spark
        self.store = Store(spark, qualified(spark, root))
        self.ledger = Ledger(spark, self.store.root)
        self.station = station
        self.logic_version = logic_version

    def register(self, files: list[tuple[str, str, str]]) -> int:
        return self.ledger.register(files)

    def runs(self) -> DataFrame:
        return read_rows(self.spark, f"{self.store.root}/runs", RUNS)

    # --- one run -----------------------------------------------------------------------

    def run(
        self, start: str, end: str, full_refresh: bool = False, force: tuple[str, ...] = ()
    ) -> dict:
        requested = [r["period"] for r in month_spine(self.spark, start, end).collect()]
        if not set(force) <= set(requested):
            raise ValueError("forced months must lie inside the requested range")
        clock = time.monotonic()
        report = {name: None for name in RUNS.fieldNames()} | {
            "run_id": uuid.uuid4().hex, "start_time": _now(), "status": "running",
            "run_mode": "full_refresh" if full_refresh else "incremental",
            "periods_requested": requested, "build_skipped": False,
        }
        where = {"stage": "initialize"}
        try:
            self._run(report, where, requested, full_refresh, force)
            report["status"] = "success"
        except Exception as problem:
            report["status"] = "failed"
            report["error"] = {
                "stage": where["stage"], "source": getattr(problem, "source", None),
                "period": getattr(problem, "period", None), "reason": str(problem)}
            raise
        finally:
            remove(self.spark, self._scratch(report["run_id"]))
            report["end_time"] = _now()
            report["duration_seconds"] = round(time.monotonic() - clock, 3)
            append_rows(local_rows(self.spark, [report], RUNS), f"{self.store.root}/runs")
        return report

    def _run(self, report, where, requested, full_refresh, force) -> None:
        spark, store = self.spark, self.store
        run_id = report["run_id"]
        before = store.latest()
        rebuild_all = (
            full_refresh or before.run_id is None or before.logic_version != self.logic_version)
        committed = local_rows(spark, list(before.entries.values()), ENTRY)
        periods_df = loaded_periods(self._months(requested), committed)
        periods = sorted(r["period"] for r in periods_df.collect())

        where["stage"] = "ingestion"
        inputs = self._inputs(periods)
        report["input_rows"] = report["bronze_rows"] = sum(
            row["row_count"] for (source, _), row in inputs.items() if source == "trips")

        where["stage"] = "bronze_validation"
        work = self._work(inputs, before, force, rebuild_all)
        keys = sorted((r["source"], r["period"]) for r in work.collect())
        changed = sorted({r["period"] for r in changed_periods(work, periods_df).collect()}
                         | self._lost_periods(before, periods))
        if rebuild_all:
            changed = periods
        report["partitions_processed"] = changed
        if not keys and not changed and not self._lost_reports(before):
            self._repeat_counts(report)
            return
        entries = self._build_bronze(run_id, inputs, before, keys)

        where["stage"] = "model_build"
        entries = self._build_gold(run_id, entries, changed)
        marts, tables = self._build_marts(run_id, entries)
        try:
            where["stage"] = "checks"
            outcome = self._check(entries, tables)
            statuses = [r["status"] for r in outcome]
            report["checks"] = {s: statuses.count(s) for s in ("pass", "warn", "fail")}
            failed = sorted(r["check_name"] for r in outcome if r["status"] == "fail")
            if failed:
                raise ChecksFailed(f"checks failed: {', '.join(failed)}")

            where["stage"] = "export_reporting"
            report.update(self.export(run_id, entries, marts))
        finally:
            marts.close()

        where["stage"] = "publication"
        store.publish(Commit(before.sequence + 1, run_id, self.logic_version, entries), before)

    def _scratch(self, run_id: str) -> str:
        return f"{self.store.root}/scratch/run={run_id}"

    # --- ingestion ---------------------------------------------------------------------

    def _inputs(self, periods: list[str]) -> dict[tuple[str, str], dict]:
        """Registered files of the run by (source, period), verified against their digests."""
        wanted = [("zones", "zones")] + [(s, p) for p in periods for s in ("trips", "weather")]
        frame = self.ledger.current().where(F.col("period").isin([p for _, p in wanted]))
        frame = local_rows(self.spark, frame.collect(), LEDGER)
        inputs = {
            (r["source"], r["period"]): {"sha256": r["raw_sha256"], "row_count": r["row_count"], "files": []}
            for r in period_digests(frame).collect()}
        for row in frame.collect():
            inputs[row["source"], row["period"]]["files"].append(row)
        for source, period in wanted:
            if (source, period) not in inputs:
                raise ContractError(
                    f"source not registered: {source}/{period}", source, period)
            if source != "trips" and len(inputs[source, period]["files"]) > 1:
                raise ContractError(f"{source} of {period} must be one file", source, period)
        self.ledger.verify(frame, [r["path"] for key in wanted for r in inputs[key]["files"]])
        return {key: inputs[key] for key in wanted}

    def _lost_periods(self, before, periods) -> set[str]:
        """Loaded periods of which a gold folder of the last publication is gone."""
        folders = {}
        for (source, period), e in before.entries.items():
            if source != "trips" or period not in periods or e["gold_run"] is None:
                continue
            tables = ["mart_quality", "trip_findings"] if e["bronze_rows"] else []
            tables += ["fct_trips", "mart_zone_daily"] if e["fact_rows"] else []
            folders |= {self.store.gold_folder(t, e["gold_run"], period): period for t in tables}
        return {folders[f] for f in self.store.missing(list(folders))}

    def _lost_reports(self, before) -> bool:
        if before.run_id is None:
            return False
        kinds = [(n, k) for n in EXPORTS for k in ("parquet", "csv")] + [
            (n, "json") for n in ("schemas", "quality", "sources")]
        return bool(self.store.missing([self.store.report_folder(before.run_id, n, k) for n, k in kinds]))

    def _work(self, inputs, before, force, rebuild_all) -> DataFrame:
        live = {
            key: self.store.bronze_folder(key[0], e["bronze_run"], key[1])
            for key, e in before.entries.items() if key in inputs and e["bronze_rows"] != 0}
        found = {} if rebuild_all else self._existing_fingerprints(live)
        rows = [
            (source, period, row["sha256"], found.get((source, period), EMPTY if (
                (source, period) in before.entries
                and before.entries[source, period]["bronze_rows"] == 0) else None))
            for (source, period), row in inputs.items()]
        committed = local_rows(self.spark, list(before.entries.values()), ENTRY)
        work = detect_work(
            local_rows(self.spark, rows, INPUTS), committed, self._months(force), rebuild_all)
        return local_rows(self.spark, work.collect(), work.schema)  # it has two readers

    def _months(self, periods) -> DataFrame:
        return local_rows(self.spark, [(p,) for p in periods], MONTHS)

    def _existing_fingerprints(self, folders):
        try:
            return self.store.fingerprints(folders)
        except AnalysisException:
            # Some folder is gone; ask one by one so that only that input is rebuilt.
            found = {}
            for key, folder in folders.items():
                try:
                    found |= self.store.fingerprints({key: folder})
                except AnalysisException:
                    continue
            return found

    # --- bronze ------------------------------------------------------------------------

    def _build_bronze(self, run_id, inputs, before, keys) -> dict[tuple[str, str], dict]:
        """New bronze for `keys`; entries of all inputs, old or new."""
        spark, store = self.spark, self.store
        trips = [TripFile(p, f["path"], f["sha256"], _schema(f)) for s, p in keys if s == "trips"
                 for f in inputs[s, p]["files"]]
        weather = [(p, f["path"], _schema(f)) for s, p in keys if s == "weather" for f in inputs[s, p]["files"]]
        jobs, seen = [], Observation()
        if trips:
            rows = bronze_files(spark, trips).withColumn("period", F.col("source_period")).observe(
                seen, F.count(F.lit(1)).alias("rows"))
            jobs.append(lambda: store.write_bronze("trips", run_id, rows, many_small([
                f["length"] for s, p in keys if s == "trips" for f in inputs[s, p]["files"]],
                sum(s == "trips" for s, _ in keys))))
        if weather:
            jobs.append(lambda: store.write_bronze(
                "weather", run_id,
                checked_weather(spark, weather, self.station), rebalance=True))
        if ("zones", "zones") in keys:
            path = inputs["zones", "zones"]["files"][0]["path"]
            jobs.append(lambda: store.write_bronze(
                "zones", run_id,
                checked_zones(spark, path).withColumn("period", F.lit("zones")).coalesce(1)))
        together(*jobs)

        rows = {key: inputs[key]["row_count"] for key in keys}
        registered = sum(n for (source, _), n in rows.items() if source == "trips")
        if trips and (written := seen.get["rows"]) != registered:
            raise ContractError(f"{written} trips were written to bronze, {registered} are registered", "trips")
        prints = store.fingerprints({
            key: store.bronze_folder(key[0], run_id, key[1]) for key in keys if rows[key] != 0})
        entries = {}
        for key, row in inputs.items():
            if key in rows:
                old = before.entries.get(key, {})
                entries[key] = {
                    "source": key[0], "period": key[1], "raw_sha256": row["sha256"],
                    "bronze_run": run_id, "bronze_fingerprint": prints.get(key, EMPTY),
                    "bronze_rows": rows[key], "gold_run": old.get("gold_run"),
                    "fact_rows": old.get("fact_rows")}
            else:
                entries[key] = before.entries[key]
        return entries

    # --- gold --------------------------------------------------------------------------

    def _build_gold(self, run_id, entries, changed) -> dict[tuple[str, str], dict]:
        """Fact, zone-day and quality rows and trip findings of the changed periods.

        All of them decompose by source period: a retained trip lies in the
        month of its file, so a date belongs to one period only. Other periods
        keep their folders and are not read.
        """
        if not changed:
            return entries
        store = self.store
        zones = store.read_bronze("zones", [entries["zones", "zones"]])
        rebuilt = [entries["trips", p] for p in changed]
        staged = classify(store.read_bronze("trips", rebuilt), zones)
        rebuilt, fact, statuses = generations.write_trips(store, run_id, staged, rebuilt)
        entries = entries | {("trips", e["period"]): e for e in rebuilt}
        findings = checks.trip_findings(staged, fact, zones, statuses, self._scratch(run_id))
        together(
            lambda: generations.write_days(store, run_id, fact),
            lambda: store.write_gold(
                "trip_findings", run_id,
                findings.withColumn("period", F.col("source_period"))),
        )
        return entries

    def _build_marts(self, run_id, entries) -> tuple[Marts, dict[str, DataFrame]]:
        """Dimensions and marts over everything retained, as a new report generation; they and what checks read."""
        store = self.store
        trips = [e for (s, _), e in sorted(entries.items()) if s == "trips"]
        raw_zones = store.read_bronze("zones", [entries["zones", "zones"]])
        raw_weather = store.read_bronze(
            "weather", [e for (s, _), e in sorted(entries.items()) if s == "weather"])
        weather = staged_weather(raw_weather)
        marts = Marts(store, run_id, generations.mart_plans(
            store.read_gold("mart_zone_daily", trips), store.read_gold("mart_quality", trips), raw_zones, weather))
        return marts, marts.write() | {
            "raw_zones": raw_zones, "raw_weather": raw_weather, "stg_weather": weather}

    # --- checks ------------------------------------------------------------------------

    def _check(self, entries, tables) -> list[Row]:
        store = self.store
        trips = [e for (s, _), e in entries.items() if s == "trips"]
        reconciled = checks.reconciliation(
            store.read_gold("fct_trips", trips), store.read_bronze("trips", trips),
            tables["mart_zone_daily"], tables["mart_borough_daily"],
            tables["mart_weather_demand"], tables["mart_quality"])
        outcome = checks.outcomes(
            store.read_gold("trip_findings", trips),
            checks.no_findings(self.spark),
            checks.table_findings(
                tables["raw_zones"], tables["raw_weather"], tables["dim_zone"],
                tables["stg_weather"], tables["dim_date"], tables["mart_zone_daily"],
                tables["mart_borough_daily"], tables["mart_weather_demand"],
                tables["mart_quality"], reconciled))
        return outcome.collect()  # one row per check

    # --- export and counts ---------------------------------------------------------------

    def export(self, run_id, entries, marts) -> dict:
        """CSV beside Parquet for every mart and sidecar documents; row counts come from the writes."""
        spark, store = self.spark, self.store

        def sidecars():
            schemas = local_rows(
                spark, [(n, marts.tables[n].schema.json()) for n in EXPORTS], SCHEMAS)
            schemas.coalesce(1).write.json(store.report_folder(run_id, "schemas", "json"))
            marts.tables["mart_quality"].orderBy("source_period", "quality_status").coalesce(1) \
                .write.json(store.report_folder(run_id, "quality", "json"))
            self.ledger.current().orderBy("source", "period").coalesce(1).write.json(
                store.report_folder(run_id, "sources", "json"))

        together(*[lambda n=n: marts.write_csv(n) for n in EXPORTS], sidecars)
        fact_rows = sum(e["fact_rows"] for (s, _), e in entries.items() if s == "trips")
        return {
            "gold_rows": marts.counts | {"fct_trips": fact_rows},
            "quality_warnings": marts.statuses.get("SUSPICIOUS", 0),
            "invalid_rows": marts.statuses.get("INVALID", 0),
        }

    def _repeat_counts(self, report) -> None:
        last = self.runs().where("status = 'success'").orderBy(F.desc("end_time")).first()
        for name in ("gold_rows", "checks", "quality_warnings", "invalid_rows"):
            report[name] = last[name]
        report["build_skipped"] = True
