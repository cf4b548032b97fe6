"""Times the headline queries and the incremental run; prints one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_COPIES  how often each trip occurs in the raw files of the run (default 1)
BENCH_ONLY    "queries" or "run" to time one part alone

Queries are run twice and the second time counts, as the first one mostly
measures compilation. The operations of the incremental run are single
observations, in the order first load, unchanged rerun, forced month, full
refresh.
"""
from __future__ import annotations

import calendar
import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

from meterline import catalogue
from meterline.plans.refresh import Refresh
from meterline.schemas import REQUIRED
from meterline.session import local_session
from meterline.sources import tables

HEADLINE = (
    "trip_flags", "quarantine", "fact_trips", "zone_daily", "borough_daily", "weather_demand",
    "quality_mart", "weather_dedup", "weather_masking", "report_locations", "check_unique",
    "check_relationships", "check_reconciliation", "check_duplicate_observations",
    "work_detection", "period_replacement", "content_fingerprint",
)
MONTHS = [f"2025-{m:02d}" for m in range(1, 7)]


def time_queries(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def landing(spark: SparkSession, sf_dir: str, folder: Path, copies: int) -> list[tuple]:
    """Six monthly raw files made of the derived trips, with zones and weather."""
    trips = tables.bronze_trips(spark, sf_dir).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    month = F.lit(1) + ((F.col("source_row") + F.col("copy")) % 6).cast("int")
    moved = F.make_date(F.lit(2025), month, F.dayofmonth("tpep_pickup_datetime") % 28 + 1)
    shift = F.datediff(moved, F.col("tpep_pickup_datetime").cast("date"))
    by_days = F.make_dt_interval(days=shift)
    raw = trips.withColumn("month", month).select(
        "month", *[
            (F.col(n) + by_days).alias(n) if kind == "timestamp" else F.col(n)
            for n, kind in REQUIRED.items()])
    raw.repartition("month").write.option("parquet.block.size", 16 * 1024 * 1024) \
        .partitionBy("month").parquet(str(folder / "trips"))
    files = []
    for number, period in enumerate(MONTHS, 1):
        part, = (folder / "trips" / f"month={number}").glob("*.parquet")
        files.append(("trips", period, str(part)))
        year, m = map(int, period.split("-"))
        lines = ["STATION,DATE,PRCP,SNOW,TMIN,TMAX,PRCP_ATTRIBUTES"] + [
            f'USW00094728,{period}-{d:02d},{d / 10},0,1,9,",,W,"'
            for d in range(1, calendar.monthrange(year, m)[1] + 1)]
        weather = folder / f"weather-{period}.csv"
        weather.write_text("\n".join(lines) + "\n")
        files.append(("weather", period, str(weather)))
    zones = folder / "zones.csv"
    rows = tables.bronze_zones(spark, sf_dir).collect()
    zones.write_text("LocationID,Borough,Zone,service_zone\n" + "".join(
        f"{r['zone_key']},{r['borough']},{r['zone']},{r['service_zone']}\n" for r in rows))
    return [("zones", "zones", str(zones)), *files]


def time_run(spark: SparkSession, sf_dir: str, copies: int) -> tuple[dict[str, float], int]:
    folder = Path(tempfile.mkdtemp(prefix="run-"))
    raw = folder / "landing"
    raw.mkdir()
    files = landing(spark, sf_dir, raw, copies)
    refresh = Refresh(spark, str(folder / "data"))
    start = time.perf_counter()
    refresh.register(files)
    seconds = {"register": round(time.perf_counter() - start, 3)}
    first, last = MONTHS[0], MONTHS[-1]
    operations = {
        "first_load": {}, "unchanged_rerun": {}, "forced_month": {"force": (MONTHS[2],)},
        "full_refresh": {"full_refresh": True},
    }
    for name, options in operations.items():
        report = refresh.run(first, last, **options)
        seconds[name] = report["duration_seconds"]
        if name == "first_load":
            rows = report["input_rows"]
    return seconds, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    only = os.environ.get("BENCH_ONLY", "")
    spark = local_session("bench", cores)
    queries, run, rows = {}, {}, 0
    if only != "run":
        queries = time_queries(spark, sf_dir)
    if only != "queries":
        run, rows = time_run(spark, sf_dir, copies)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(queries.values()), 3),
        "unit": "sec", "queries": queries, "run": run, "run_rows": rows,
        "run_rows_per_sec_full_refresh":
            round(rows / run["full_refresh"]) if run else None,
        "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cores,
    }))


if __name__ == "__main__":
    main()
