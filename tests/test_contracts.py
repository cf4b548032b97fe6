"""Raw file contracts: trips, zones, weather, months."""
import hashlib
from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterline.schemas import REQUIRED, TRIPS
from meterline.sources.contracts import ContractError, schema_fingerprint
from meterline.sources.digests import file_digests, tree_fingerprint
from meterline.sources.files import qualified, scan_files
from meterline.sources.periods import month_spine
from meterline.sources.trips import TripFile, bronze_file, bronze_files, checked_trip_files
from meterline.sources.weather import checked_weather, observations, read_weather_text
from meterline.sources.zones import checked_zones, read_zones
from tests.inputs import rides, sha256, write_rides, write_weather, write_zones


def written(table, path):
    pq.write_table(table, path)
    return str(path)


def with_column(table, name, values):
    return table.set_column(table.schema.get_field_index(name), name, values)


@pytest.mark.parametrize("column", REQUIRED)
def test_missing_required_column(spark, tmp_path, column):
    path = written(rides("2025-01").drop_columns([column]), tmp_path / "t.parquet")
    with pytest.raises(ContractError, match=f"required field missing: {column}"):
        checked_trip_files(spark, [path])


@pytest.mark.parametrize("column", ["trip_distance", "tpep_pickup_datetime", "payment_type"])
def test_incompatible_type(spark, tmp_path, column):
    table = rides("2025-01")
    path = written(
        with_column(table, column, pa.array(["bad"] * len(table))), tmp_path / "t.parquet")
    with pytest.raises(ContractError, match=f"incompatible field {column}"):
        checked_trip_files(spark, [path])


def test_optional_column_changes_the_fingerprint_only(spark, tmp_path):
    table = rides("2025-01")
    def described(path):
        (schema, rows), = checked_trip_files(spark, [path]).values()
        return schema_fingerprint(schema), rows

    plain = described(written(table, tmp_path / "a.parquet"))
    same = described(written(table.slice(0, 5), tmp_path / "b.parquet"))
    wider = table.append_column("cbd_congestion_fee", pa.array([2.5] * 11))
    path = written(wider, tmp_path / "c.parquet")
    extra = described(path)
    assert plain[1] == extra[1] == 11 and same[1] == 5
    assert plain[0] == same[0] != extra[0]
    assert bronze_file(spark, TripFile("2025-01", path, "x")).columns == TRIPS.fieldNames()


def test_row_identity(spark, tmp_path):
    path = write_rides(tmp_path, rides("2025-01"))
    bronze = bronze_file(spark, TripFile("2025-01", str(path), sha256(path)))
    rows = bronze.orderBy("source_row").collect()
    assert [r["source_row"] for r in rows] == list(range(11))
    assert {r["source_sha256"] for r in rows} == {sha256(path)}
    assert bronze.schema.simpleString() == TRIPS.simpleString()


def test_row_identity_holds_when_a_file_is_split(spark, tmp_path):
    """Many row groups, many tasks, and a filter: the number is still the physical position."""
    count = 40_000
    one = rides("2025-01").slice(0, 1)
    table = pa.concat_tables([one] * count).combine_chunks()
    table = with_column(table, "fare_amount", pa.array([float(i) for i in range(count)]))
    path = tmp_path / "big.parquet"
    pq.write_table(table, path, row_group_size=1_000, use_dictionary=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        bronze = bronze_file(spark, TripFile("2025-01", str(path), "x"))
        assert bronze.select(F.spark_partition_id()).distinct().count() > 4
        assert bronze.where("source_row <> fare_amount").count() == 0
        assert bronze.select("source_row").distinct().count() == count
        late = bronze.where("fare_amount >= 39990")
        assert sorted(r[0] for r in late.select("source_row").collect()) == \
            list(range(39_990, 40_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_months_with_different_widths(spark, tmp_path):
    """32-bit ids, whole passenger counts, decimals and milliseconds in one month only."""
    wide = rides("2025-01")
    narrow = rides("2025-02")
    narrow = with_column(narrow, "PULocationID", narrow["PULocationID"].cast(pa.int32()))
    narrow = with_column(narrow, "passenger_count", narrow["passenger_count"].cast(pa.int64()))
    narrow = with_column(narrow, "tip_amount", pa.array([Decimal("3.00")] * 11, pa.decimal128(9, 2)))
    narrow = with_column(narrow, "fare_amount", narrow["fare_amount"].cast(pa.float32()))
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        narrow = with_column(narrow, name, narrow[name].cast(pa.timestamp("ms")))
    files = [TripFile("2025-01", written(wide, tmp_path / "a.parquet"), "a"),
             TripFile("2025-02", written(narrow, tmp_path / "b.parquet"), "b")]
    rows = bronze_files(spark, files)
    assert rows.schema.simpleString() == TRIPS.simpleString() and rows.count() == 22
    second = rows.where("source_sha256 = 'b' and source_row = 0").first()
    assert second["tip_amount"] == 3.0 and second["passenger_count"] == 1.0
    assert second["tpep_pickup_datetime"] == datetime(2025, 2, 2, 12)


@pytest.mark.parametrize("zone", [None, "UTC", "America/New_York"])
@pytest.mark.parametrize("unit", ["ns", "us", "ms"])
def test_timestamp_units_and_zones(spark, tmp_path, unit, zone):
    table = rides("2025-01")
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        table = with_column(table, name, table[name].cast(pa.timestamp(unit, zone)))
    path = written(table, tmp_path / "t.parquet")
    rows = bronze_file(spark, TripFile("2025-01", path, "x"))
    first = rows.where("source_row = 0").first()
    assert first["tpep_pickup_datetime"] == datetime(2025, 1, 2, 12)
    assert first["tpep_dropoff_datetime"] == datetime(2025, 1, 2, 12, 15)


@pytest.mark.parametrize("column,values", [
    ("PULocationID", pa.array([1.5] * 11)),
    ("payment_type", pa.array([float("nan")] * 11)),
    ("payment_type", pa.array([1e30] * 11)),
    ("DOLocationID", pa.array([Decimal("2.50")] * 11, pa.decimal128(9, 2))),
    ("trip_distance", pa.array([2**53 + 1] * 11)),
    ("tpep_pickup_datetime", pa.array([1_735_819_200_000_000_001] * 11, pa.timestamp("ns"))),
])
def test_lossy_casts_fail(spark, tmp_path, column, values):
    path = written(with_column(rides("2025-01"), column, values), tmp_path / "t.parquet")
    with pytest.raises(Exception, match="lossy cast|CAST_OVERFLOW|CAST_INVALID"):
        bronze_file(spark, TripFile("2025-01", path, "x")).collect()


def test_whole_numbers_pass_as_timestamps_only_where_the_footer_says_so(spark, tmp_path):
    """A nanosecond column elsewhere does not lend its meaning to a plain whole number."""
    table = rides("2025-01")
    table = with_column(table, "tpep_dropoff_datetime", table["tpep_dropoff_datetime"].cast(pa.timestamp("ns")))
    table = with_column(table, "tpep_pickup_datetime", pa.array([1_735_819_200_000_000_000] * 11))
    with pytest.raises(ContractError, match="incompatible field tpep_pickup_datetime"):
        checked_trip_files(spark, [written(table, tmp_path / "t.parquet")])
    nanos = with_column(rides("2025-01"), "payment_type", pa.array([1] * 11, pa.timestamp("ns")))
    with pytest.raises(ContractError, match="incompatible field payment_type"):
        checked_trip_files(spark, [written(nanos, tmp_path / "u.parquet")])


def test_many_files_are_one_scan_per_schema(spark, tmp_path):
    """The plan follows the number of schemas; names with odd characters keep their digests."""
    files = []
    for i in range(120):
        table = rides("2025-01").slice(i % 11, 1)
        if i % 3 == 0:
            table = with_column(table, "PULocationID", table["PULocationID"].cast(pa.int32()))
        files.append(TripFile(f"2025-{i % 12 + 1:02d}", written(table, tmp_path / f"part {i}%20+é.parquet"), f"d{i}"))
    rows = bronze_files(spark, files)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    found = {(r["source_sha256"], r["source_period"], r["source_row"]) for r in rows.collect()}
    assert found == {(f.sha256, f.period, 0) for f in files}


def test_file_lists_are_sent_in_bounded_parts(spark, tmp_path):
    paths = [written(rides("2025-01").slice(0, i + 1), tmp_path / f"{i}.parquet") for i in range(5)]

    def read(names):
        return spark.read.parquet(*names).select(F.col("_metadata.file_path").alias("file_uri"))
    rows = scan_files(spark, [(qualified(spark, p), str(i), "x") for i, p in enumerate(paths)], read, chunk=2)
    counts = {r["file_period"]: r["count"] for r in rows.groupBy("file_period").count().collect()}
    assert counts == {str(i): i + 1 for i in range(5)}


def test_zones(spark, tmp_path):
    path = write_zones(tmp_path, ((1, "Manhattan", "A", "Yellow"), (264, "", "", "N/A")))
    rows = {r["zone_key"]: r for r in checked_zones(spark, str(path)).collect()}
    assert rows[264]["borough"] == "" and rows[1]["service_zone"] == "Yellow"


@pytest.mark.parametrize("rows", [(), ((1, "A", "A", "A"), (1, "B", "B", "B"))])
def test_zones_empty_or_duplicate(spark, tmp_path, rows):
    path = write_zones(tmp_path, rows)
    with pytest.raises(ContractError, match="duplicate"):
        checked_zones(spark, str(path))


def test_zone_key_must_be_a_number(spark, tmp_path):
    path = write_zones(tmp_path, (("x", "A", "A", "A"),))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_zones(spark, str(path)).collect()


def test_zone_keys_must_not_be_blank(spark, tmp_path):
    rows = ((1, "Manhattan", "A", "Yellow"), ("", "Queens", "B", "Yellow"))
    with pytest.raises(ContractError, match="blank"):
        checked_zones(spark, str(write_zones(tmp_path, rows)))


@pytest.mark.parametrize("day", ["2025-01", "2025-01-01Tgarbage", "2025-01-32", "01/01/2025", "2025-1-1"])
def test_weather_dates_must_be_iso(spark, tmp_path, day):
    path = write_weather(tmp_path, "2025-01")
    path.write_text(path.read_text().replace("2025-01-01", day))
    with pytest.raises(ContractError, match="not ISO"):
        checked_weather(spark, {"2025-01": str(path)})


def test_weather_timestamps_count_as_their_day(spark, tmp_path):
    path = write_weather(tmp_path, "2025-01")
    path.write_text(path.read_text().replace("2025-01-01", "2025-01-01T00:00:00"))
    assert checked_weather(spark, {"2025-01": str(path)}).count() == 31


def test_weather_masking(spark, tmp_path):
    accepted = checked_weather(
        spark, {"2025-01": str(write_weather(tmp_path, "2025-01"))}).collect()
    assert len(accepted) == 31 and {r["precipitation_mm"] for r in accepted} == {0.0}
    assert {r["quality_flagged_values"] for r in accepted} == {0}
    path = write_weather(tmp_path, "2025-01", attributes=",X,W,")
    rejected = checked_weather(spark, {"2025-01": str(path)}).collect()
    assert {r["precipitation_mm"] for r in rejected} == {None}
    assert {r["quality_flagged_values"] for r in rejected} == {1}
    assert {r["max_temperature_c"] for r in rejected} == {9.0}


def test_blank_and_absent_weather_columns(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("STATION,DATE,PRCP,TMAX,TMAX_ATTRIBUTES\n"
                    "S,2025-01-01,,5,\n" 'S,2025-01-02,1.5,6,"T"\n' 'S,2025-01-03,2,7,", ,W"\n')
    rows = {r["date"].day: r for r in observations(
        read_weather_text(spark, str(path))).collect()}
    assert rows[1]["precipitation_mm"] is None and rows[2]["precipitation_mm"] == 1.5
    assert [rows[d]["max_temperature_c"] for d in (1, 2, 3)] == [5.0, 6.0, 7.0]
    assert rows[3]["snowfall_mm"] is None and rows[3]["quality_flagged_values"] == 0


@pytest.mark.parametrize("change,message", [
    ({"days": 30}, "missing or duplicate"),
    ({"days": 0}, "missing or duplicate"),
    ({"station": "OTHER"}, "unexpected station"),
])
def test_weather_contract(spark, tmp_path, change, message):
    path = write_weather(tmp_path, "2025-01", **change)
    with pytest.raises(ContractError, match=message):
        checked_weather(spark, {"2025-01": str(path)})


def test_weather_duplicate_or_foreign_day(spark, tmp_path):
    path = write_weather(tmp_path, "2025-01", days=30)
    complete = path.read_text()
    path.write_text(complete + "USW00094728,2025-01-30,0,0,1,9,\n")
    with pytest.raises(ContractError, match="missing or duplicate"):
        checked_weather(spark, {"2025-01": str(path)})
    path.write_text(complete + "USW00094728,2025-02-01,0,0,1,9,\n")
    with pytest.raises(ContractError, match="outside source period"):
        checked_weather(spark, {"2025-01": str(path)})


def test_month_spine(spark):
    def months(start, end):
        return sorted(r["period"] for r in month_spine(spark, start, end).collect())

    assert months("2024-12", "2025-02") == ["2024-12", "2025-01", "2025-02"]
    assert months("2025-01", "2025-01") == ["2025-01"]
    for start, end in (("2025-03", "2025-01"), ("2025-13", "2026-01"), ("2025-1", "2025-02")):
        with pytest.raises(ValueError):
            month_spine(spark, start, end)


def test_digests(spark, tmp_path):
    contents = {"a.bin": b"x" * 500, "b.bin": b"y" * 5_000, "c.gz": b"not really gzip" * 900,
                "e f+g%20.bin": bytes(range(256)) * 50_000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = {
        r["path"].rsplit("/", 1)[1]: (r["length"], r["sha256"])
        for r in file_digests(spark, str(tmp_path)).collect()}
    assert found == {
        n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}


def test_tree_fingerprint(spark, tmp_path):
    def fingerprint():
        digests = file_digests(spark, str(tmp_path))
        return tree_fingerprint(digests, F.lit("all").alias("k")).first()["fingerprint"]

    (tmp_path / "a").write_bytes(b"1")
    (tmp_path / "b").write_bytes(b"2")
    first = fingerprint()
    assert fingerprint() == first
    (tmp_path / "b").write_bytes(b"3")
    second = fingerprint()
    assert second != first
    (tmp_path / "b").rename(tmp_path / "c")
    assert fingerprint() not in (first, second)
