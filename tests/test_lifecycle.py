"""The incremental run, step by step, with the published numbers of each step."""
import datetime
import json

import pytest
from pyspark.sql import functions as F

from meterline.plans import refresh as module
from meterline.plans.refresh import EXPORTS, ChecksFailed, Refresh
from meterline.sources.contracts import ContractError
from tests.inputs import register_month, rides, write_rides, write_weather, write_zones


def cells(refresh):
    names = ["fct_trips", *EXPORTS]
    return {
        n: sorted(map(tuple, refresh.store.table(n).collect()), key=repr) for n in names}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture
def refresh(spark, tmp_path):
    return Refresh(spark, str(tmp_path / "data"))


def test_counts_of_a_run(refresh, landing):
    register_month(refresh, landing, "2025-03")
    report = refresh.run("2025-03", "2025-03")
    assert report["partitions_processed"] == ["2025-03"] and not report["build_skipped"]
    assert (report["input_rows"], report["gold_rows"]["fct_trips"]) == (11, 5)
    assert (report["invalid_rows"], report["quality_warnings"]) == (6, 3)
    assert report["checks"] == {"pass": 37, "warn": 1, "fail": 0}


def test_without_change_nothing_is_built(refresh, landing):
    register_month(refresh, landing, "2025-02")
    register_month(refresh, landing, "2025-03")
    first = refresh.run("2025-02", "2025-03")
    tables = cells(refresh)
    for start, end in (("2025-02", "2025-03"), ("2025-03", "2025-03")):
        again = refresh.run(start, end)
        assert again["build_skipped"] and again["partitions_processed"] == []
        assert all(again[k] == first[k] for k in ("gold_rows", "checks", "invalid_rows", "quality_warnings"))
    assert cells(refresh) == tables


def test_months_arrive_in_any_order(refresh, landing):
    register_month(refresh, landing, "2025-02")
    refresh.run("2025-02", "2025-02")
    register_month(refresh, landing, "2025-01")
    report = refresh.run("2025-01", "2025-02")
    assert report["partitions_processed"] == ["2025-01"] and report["gold_rows"]["fct_trips"] == 10


def test_rebuilding_gives_the_same_tables(refresh, landing):
    for period in ("2025-01", "2025-02"):
        register_month(refresh, landing, period)
    refresh.run("2025-01", "2025-02")
    tables = cells(refresh)
    full = refresh.run("2025-01", "2025-02", full_refresh=True)
    assert full["partitions_processed"] == ["2025-01", "2025-02"] and cells(refresh) == tables
    forced = refresh.run("2025-01", "2025-02", force=("2025-02",))
    assert forced["partitions_processed"] == ["2025-02"] and cells(refresh) == tables


def test_a_failed_run_leaves_the_published_tables(refresh, landing, monkeypatch):
    register_month(refresh, landing)
    refresh.run("2025-01", "2025-01")
    published, tables = refresh.store.latest(), cells(refresh)

    def broken(*_):
        raise RuntimeError("no space" + "!" * 5000)
    monkeypatch.setattr(Refresh, "export", broken)
    with pytest.raises(RuntimeError, match="no space"):
        refresh.run("2025-01", "2025-01", full_refresh=True)
    monkeypatch.undo()
    assert refresh.store.latest() == published and cells(refresh) == tables
    error = refresh.runs().where("status = 'failed'").first()["error"]
    assert error["stage"] == "export_reporting" and len(error["reason"]) == 5008


def test_a_correction_may_empty_a_month(refresh, landing):
    register_month(refresh, landing, "2025-02")
    register_month(refresh, landing, "2025-01")
    refresh.run("2025-01", "2025-02")
    register_month(refresh, landing, "2025-02", all_invalid=True)
    report = refresh.run("2025-01", "2025-02")
    assert report["partitions_processed"] == ["2025-02"] and report["gold_rows"]["fct_trips"] == 5
    left = {r["source_period"] for r in refresh.store.table("fct_trips").collect()}
    assert left == {"2025-01"}
    assert refresh.ledger.history().where("source = 'trips' and period = '2025-02'").count() == 2
    assert [r["status"] for r in refresh.runs().collect()] == ["success", "success"]


def test_published_tables(refresh, landing):
    register_month(refresh, landing)
    report = refresh.run("2025-01", "2025-01")
    store = refresh.store
    zone_day = store.table("mart_zone_daily").collect()
    assert len(zone_day) == 1
    row = zone_day[0].asDict()
    assert (str(row["date"]), row["zone_key"], row["trip_count"]) == ("2025-01-02", 1, 5)
    assert (row["passenger_count"], row["trips_with_passenger_count"]) == (4.0, 4)
    assert (row["average_trip_distance"], row["average_trip_duration"]) == (2.0, 15.0)
    assert (str(row["fare_amount"]), str(row["total_amount"])) == ("50.00", "100.00")
    assert row["suspicious_trip_count"] == 3

    borough = store.table("mart_borough_daily").first().asDict()
    assert (borough["borough"], borough["trip_count"]) == ("Manhattan", 5)
    assert borough["active_pickup_zones"] == 1

    demand = {r["date"].day: r for r in store.table("mart_weather_demand").collect()}
    assert len(demand) == 31 and demand[1]["change_from_previous_day"] is None
    assert (demand[2]["trip_count"], demand[2]["change_from_previous_day"]) == (5, 5)
    assert demand[2]["trailing_7_day_trips"] == 2.5
    assert demand[3]["change_from_previous_day"] == -5
    assert demand[3]["trailing_7_day_trips"] == pytest.approx(5 / 3)
    assert demand[8]["trailing_7_day_trips"] == pytest.approx(5 / 7)
    assert demand[9]["trailing_7_day_trips"] == 0

    quality = {r["quality_status"]: r["trip_count"] for r in store.table("mart_quality").collect()}
    assert quality == {"ACCEPTED": 2, "SUSPICIOUS": 3, "INVALID": 6}
    new_year = store.table("dim_date").where("date_key = '2025-01-01'").first()
    assert (new_year["weekday_number"], new_year["weekday_name"]) == (3, "Wednesday")

    # Exports: CSV with header in column order, schemas, quality rows, source list.
    folder = store.report_folder(report["run_id"], "mart_weather_demand", "csv")
    csv = refresh.spark.read.option("header", "true").csv(folder)
    assert csv.columns[:3] == ["date", "trip_count", "total_amount"] and csv.count() == 31
    for name in EXPORTS:
        path = store.report_folder(report["run_id"], name, "csv")
        assert refresh.spark.read.option("header", "true").csv(path).columns == \
            store.table(name).columns
    schemas = refresh.spark.read.json(store.report_folder(report["run_id"], "schemas", "json"))
    assert schemas.count() == 6
    fields = json.loads(
        schemas.where("table_name = 'mart_weather_demand'").first()["schema"])["fields"]
    assert [f["name"] for f in fields][:3] == ["date", "trip_count", "total_amount"]
    assert refresh.spark.read.json(
        store.report_folder(report["run_id"], "sources", "json")).count() == 3


def test_export_is_sorted(refresh, landing):
    register_month(refresh, landing)
    register_month(refresh, landing, "2025-02")
    report = refresh.run("2025-01", "2025-02")
    path = refresh.store.report_folder(report["run_id"], "dim_date", "csv")
    dates = [r["date_key"] for r in refresh.spark.read.option("header", "true").csv(path)
             .orderBy(F.input_file_name()).collect()]
    assert dates == sorted(dates) and len(dates) == 59


def test_weather_only_change_rebuilds_marts_only(refresh, landing):
    register_month(refresh, landing)
    refresh.run("2025-01", "2025-01")
    path = write_weather(landing, "2025-01", rain="3.5").rename(landing / "w2.csv")
    refresh.register([("weather", "2025-01", str(path))])
    # The first weather file was rewritten above; the ledger now points at the new one.
    report = refresh.run("2025-01", "2025-01")
    assert report["partitions_processed"] == [] and not report["build_skipped"]
    rain = {r["precipitation_mm"] for r in refresh.store.table("mart_weather_demand").collect()}
    assert rain == {3.5}


def test_zone_change_rebuilds_every_period(refresh, landing, tmp_path):
    register_month(refresh, landing)
    register_month(refresh, landing, "2025-02")
    refresh.run("2025-01", "2025-02")
    other = tmp_path / "more"
    other.mkdir()
    zones = write_zones(other, ((1, "Manhattan", "A", "Yellow"), (2, "Queens", "B", "Yellow"),
                                (999, "", "", "")))
    refresh.register([("zones", "zones", str(zones))])
    report = refresh.run("2025-02", "2025-02")
    assert report["partitions_processed"] == ["2025-01", "2025-02"]
    assert report["gold_rows"]["fct_trips"] == 12  # zone 999 is known now
    labels = {r["borough"] for r in refresh.store.table("mart_borough_daily").collect()}
    assert labels == {"Manhattan", ""}


def test_logic_version_rebuilds_all(spark, refresh, landing, tmp_path):
    register_month(refresh, landing)
    refresh.run("2025-01", "2025-01")
    newer = Refresh(spark, str(tmp_path / "data"), logic_version="2")
    assert newer.run("2025-01", "2025-01")["partitions_processed"] == ["2025-01"]


def test_damaged_bronze_is_rebuilt(spark, landing, tmp_path):
    refresh = Refresh(spark, str(tmp_path / "data"))
    register_month(refresh, landing)
    register_month(refresh, landing, "2025-02")
    refresh.run("2025-01", "2025-02")
    assert refresh.run("2025-01", "2025-02")["build_skipped"]
    entry = refresh.store.latest().entries["trips", "2025-02"]
    folder = tmp_path / "data" / "bronze" / "trips" / f"run={entry['bronze_run']}" / \
        "period=2025-02"
    part = next(folder.glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    crc = folder / f".{part.name}.crc"
    crc.unlink()
    assert refresh.run("2025-01", "2025-02")["partitions_processed"] == ["2025-02"]
    # The same for a folder that is gone.
    entry = refresh.store.latest().entries["trips", "2025-01"]
    (tmp_path / "data" / "bronze" / "trips" / f"run={entry['bronze_run']}" /
     "period=2025-01").rename(tmp_path / "lost")
    assert refresh.run("2025-01", "2025-02")["partitions_processed"] == ["2025-01"]


def test_changed_raw_bytes_stop_the_run(spark, landing, tmp_path):
    refresh = Refresh(spark, str(tmp_path / "data"))
    register_month(refresh, landing)
    with open(landing / "2025-01-weather.csv", "a") as stream:
        stream.write("tampered")
    with pytest.raises(ContractError, match="integrity"):
        refresh.run("2025-01", "2025-01")


def test_missing_source_is_recorded(refresh):
    with pytest.raises(ContractError, match="not registered"):
        refresh.run("2025-01", "2025-01")
    run = refresh.runs().first()
    assert run["status"] == "failed" and run["error"]["stage"] == "ingestion"
    assert run["error"]["source"] == "zones"


def test_forced_month_outside_range(refresh):
    with pytest.raises(ValueError, match="inside the requested"):
        refresh.run("2025-01", "2025-01", force=("2025-02",))


def test_failed_check_blocks_publication(refresh, landing, monkeypatch):
    register_month(refresh, landing)
    real = module.generations.weather_demand
    monkeypatch.setattr(
        module.generations, "weather_demand", lambda *a: real(*a).where("trip_count = 0"))
    with pytest.raises(ChecksFailed, match="reconciliation"):
        refresh.run("2025-01", "2025-01")
    assert refresh.store.latest().run_id is None
    assert refresh.runs().first()["error"]["stage"] == "checks"


def test_empty_month(refresh, landing):
    register_month(refresh, landing)
    empty = write_rides(landing, rides("2025-02").slice(0, 0))
    refresh.register([("trips", "2025-02", str(empty)),
                      ("weather", "2025-02", str(write_weather(landing, "2025-02")))])
    report = refresh.run("2025-01", "2025-02")
    assert report["input_rows"] == 11 and report["gold_rows"]["fct_trips"] == 5
    assert refresh.run("2025-01", "2025-02")["build_skipped"]
    assert refresh.store.table("mart_weather_demand").count() == 59
    assert refresh.store.table("dim_date").where(
        F.col("date_key") == datetime.date(2025, 2, 28)).count() == 1


def test_lost_gold_and_reports_are_restored(refresh, landing, tmp_path):
    """A plain run restores exactly what is gone; all else stays as it was."""
    register_month(refresh, landing)
    register_month(refresh, landing, "2025-02")
    refresh.run("2025-01", "2025-02")
    whole, lost = cells(refresh), tmp_path / "lost"
    lost.mkdir()

    entry = refresh.store.latest().entries["trips", "2025-01"]
    data = tmp_path / "data"
    (data / "gold" / "fct_trips" / f"run={entry['gold_run']}" / "period=2025-01").rename(lost / "fact")
    report = refresh.run("2025-01", "2025-02")
    assert report["partitions_processed"] == ["2025-01"] and cells(refresh) == whole

    (data / "gold").rename(lost / "gold")
    report = refresh.run("2025-01", "2025-02")
    assert report["partitions_processed"] == ["2025-01", "2025-02"] and cells(refresh) == whole

    (data / "reports").rename(lost / "reports")
    report = refresh.run("2025-01", "2025-02")
    assert report["partitions_processed"] == [] and not report["build_skipped"]
    assert cells(refresh) == whole and refresh.run("2025-01", "2025-02")["build_skipped"]


def test_a_month_of_several_files(refresh, landing):
    """Loads, is corrected and is replaced like a month of one file."""
    register_month(refresh, landing)
    refresh.run("2025-01", "2025-01")
    one = cells(refresh)
    table = rides("2025-01")
    parts = [("trips", "2025-01", str(write_rides(landing, table.slice(i, n)))) for i, n in ((0, 5), (5, 6))]
    refresh.register(parts)
    report = refresh.run("2025-01", "2025-01")
    assert report["partitions_processed"] == ["2025-01"] and report["input_rows"] == 11
    two = cells(refresh)
    assert {n: rows for n, rows in two.items() if n != "fct_trips"} == {
        n: rows for n, rows in one.items() if n != "fct_trips"}
    assert len(two["fct_trips"]) == len(one["fct_trips"]) == 5
    refresh.register(parts[:1])
    assert refresh.run("2025-01", "2025-01")["gold_rows"]["fct_trips"] == 4


def test_earlier_generations_stay_readable(refresh, landing):
    register_month(refresh, landing)
    first = refresh.run("2025-01", "2025-01")
    register_month(refresh, landing, "2025-02")
    second = refresh.run("2025-01", "2025-02")
    old = refresh.store.table("fct_trips", first["run_id"])
    assert old.count() == 5 and refresh.store.table("fct_trips", second["run_id"]).count() == 10
    assert refresh.store.table("mart_quality", first["run_id"]).count() == 3
    with pytest.raises(LookupError):
        refresh.store.table("fct_trips", "no such run")


def test_scratch_is_removed(refresh, landing, tmp_path):
    register_month(refresh, landing)
    refresh.run("2025-01", "2025-01")
    assert not list((tmp_path / "data" / "scratch").glob("run=*"))
