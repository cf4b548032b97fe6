"""Operator rules on hand-made rows, against results worked out by hand or brute force."""
import datetime as dt
import math
import random
from collections import Counter
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row, functions as F

from meterline.functions.expressions import minutes_between, money, period_of
from meterline.operators import checks, compare, marts
from meterline.operators.classify import classify, quarantine
from meterline.operators.dimensions import date_dimension, staged_weather
from meterline.operators.fact import replace_periods, trip_fact
from meterline.operators.profile import profile_trips
from meterline.operators.reports import location_trips
from meterline.plans.worklist import changed_periods, detect_work, loaded_periods
from meterline.schemas import FLAGS, TRIPS, WEATHER, ZONES
from meterline.sources import tables

NOON = dt.datetime(2025, 1, 2, 12)
PLAIN = {
    "tpep_pickup_datetime": NOON, "tpep_dropoff_datetime": NOON + dt.timedelta(minutes=15),
    "PULocationID": 1, "DOLocationID": 2, "passenger_count": 1.0, "trip_distance": 2.5,
    "fare_amount": 15.0, "tip_amount": 3.0, "total_amount": 20.0, "payment_type": 1,
    "source_row": 0, "source_period": "2025-01", "source_sha256": "f",
}
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [(1, "Manhattan", "A", "Y"), (2, "Queens", "B", "Y")], ZONES)


def staged(spark, zones, *changes):
    rows = [PLAIN | {"source_row": i} | change for i, change in enumerate(changes)]
    return classify(spark.createDataFrame(rows, TRIPS), zones)


CASES = [
    ({}, set()),
    ({"tpep_pickup_datetime": None}, {"missing_timestamp"}),
    ({"tpep_dropoff_datetime": None}, {"missing_timestamp"}),
    ({"tpep_dropoff_datetime": NOON - dt.timedelta(minutes=1)}, {"reversed_timestamp"}),
    ({"tpep_dropoff_datetime": NOON}, set()),
    ({"tpep_pickup_datetime": NOON - dt.timedelta(days=10)},
     {"outside_source_month", "long_duration"}),
    ({"tpep_dropoff_datetime": dt.datetime(2025, 2, 1)}, {"long_duration"}),
    ({"tpep_dropoff_datetime": NOON + dt.timedelta(minutes=180)}, set()),
    ({"tpep_dropoff_datetime": NOON + dt.timedelta(minutes=180, seconds=1)}, {"long_duration"}),
    ({"trip_distance": None}, {"invalid_distance"}),
    ({"trip_distance": NAN}, {"invalid_distance"}),
    ({"trip_distance": INF}, {"invalid_distance"}),
    ({"trip_distance": -INF}, {"invalid_distance"}),
    ({"trip_distance": -0.01}, {"invalid_distance"}),
    ({"trip_distance": 0.0}, {"zero_distance"}),
    ({"trip_distance": -0.0}, {"zero_distance"}),
    ({"fare_amount": None}, {"invalid_money"}),
    ({"tip_amount": NAN}, {"invalid_money"}),
    ({"total_amount": -INF}, {"invalid_money", "negative_money"}),
    ({"total_amount": INF, "tip_amount": -1.0}, {"invalid_money", "negative_money"}),
    ({"fare_amount": -10.0}, {"negative_money"}),
    ({"fare_amount": None, "tip_amount": -1.0}, {"invalid_money", "negative_money"}),
    ({"PULocationID": None}, {"unknown_zone"}),
    ({"PULocationID": 999}, {"unknown_zone"}),
    ({"DOLocationID": 999}, {"unknown_zone"}),
    ({"DOLocationID": None, "PULocationID": None}, {"unknown_zone"}),
    ({"passenger_count": None}, {"unusual_passengers"}),
    ({"passenger_count": NAN}, {"unusual_passengers"}),
    ({"passenger_count": INF}, {"unusual_passengers"}),
    ({"passenger_count": 0.0}, {"unusual_passengers"}),
    ({"passenger_count": -1.0}, {"unusual_passengers"}),
    ({"passenger_count": 1.5}, {"unusual_passengers"}),
    ({"payment_type": None}, {"unusual_payment"}),
    ({"payment_type": 7}, {"unusual_payment"}),
    ({"payment_type": 0}, set()),
    ({"trip_distance": 0.0, "PULocationID": 999}, {"zero_distance", "unknown_zone"}),
]


def test_flags_and_status(spark, zones):
    rows = staged(spark, zones, *[change for change, _ in CASES]).collect()
    assert len(rows) == len(CASES)
    for row in rows:
        change, expected = CASES[row["source_row"]]
        assert {f for f in FLAGS if row[f]} == expected, change
        assert all(row[f] is not None for f in FLAGS)
        invalid = expected & set(FLAGS[:6])
        status = "INVALID" if invalid else "SUSPICIOUS" if expected else "ACCEPTED"
        assert row["quality_status"] == status, change


def test_fact_and_quarantine_split_the_rows(spark, zones):
    rows = staged(spark, zones, *[change for change, _ in CASES])
    kept = {r["source_row"]: r for r in trip_fact(rows).collect()}
    out = {r["source_row"] for r in quarantine(rows).collect()}
    assert set(kept) | out == set(range(len(CASES))) and not set(kept) & out
    expected = {r["source_row"]: r["quality_status"] for r in rows.collect()}
    assert all(r["quality_status"] == expected[i] for i, r in kept.items())
    by_value = {
        repr(CASES[i][0].get("passenger_count", 1.0)): r["passenger_count"]
        for i, r in kept.items()}
    assert by_value["0.0"] == 0.0 and by_value["1.0"] == 1.0
    assert all(by_value[v] is None for v in ("None", "nan", "inf", "-1.0", "1.5"))


def test_repeated_zone_keys_never_multiply_trips(spark, zones):
    doubled = zones.unionByName(zones)
    assert staged(spark, doubled, {}, {}).count() == 2


def test_flag_thresholds_are_parameters(spark, zones):
    trips = spark.createDataFrame([PLAIN], TRIPS)
    row = classify(trips, zones, long_trip_minutes=10, payment_types=(2,)).first()
    assert row["long_duration"] and row["unusual_payment"]


def test_duration_counts_second_boundaries(spark):
    base = dt.datetime(2025, 3, 9, 1, 59, 59)
    pairs = [
        (base.replace(microsecond=900_000), base.replace(microsecond=100_000)
         + dt.timedelta(seconds=1), 1),
        (base, base.replace(microsecond=999_999), 0),
        (base, base + dt.timedelta(hours=2), 7200),       # across a daylight-saving gap
        (base, base - dt.timedelta(days=400), -400 * 86400),
        (dt.datetime(1969, 12, 31, 23, 59, 59, 900_000), dt.datetime(1970, 1, 1), 1),
    ]
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b, _) in enumerate(pairs)],
        "i int, a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            rows = df.select("i", minutes_between(F.col("a"), F.col("b")).alias("m"),
                             period_of(F.col("a")).alias("p")).collect()
            for row in rows:
                assert row["m"] == pairs[row["i"]][2] / 60.0
                assert row["p"] == pairs[row["i"]][0].strftime("%Y-%m")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_money_rounds_the_stored_double(spark):
    values = [1.005, 0.125, -0.125, 2.675, 19.99, -3.5, 0.0, 1234567.891, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {r["v"]: r["m"] for r in df.select("v", money(F.col("v")).alias("m")).collect()}
    assert found[1.005] == Decimal("1.00") and found[2.675] == Decimal("2.68")
    assert found[0.125] == Decimal("0.13") and found[-0.125] == Decimal("-0.13")
    assert found[19.99] == Decimal("19.99") and found[-3.5] == Decimal("-3.50")
    assert found[1234567.891] == Decimal("1234567.89")


def test_weather_staging_takes_the_lowest_station(spark):
    day = dt.date(2025, 1, 1)
    rows = [(day, "B", 0, 1.0, None, None, None), (day, "A", 1, None, 2.0, None, 3.0),
            (day, "C", 0, 9.0, 9.0, 9.0, 9.0),
            (dt.date(2025, 1, 2), "Z", 0, None, None, None, None)]
    found = {r["date"]: r for r in staged_weather(spark.createDataFrame(rows, WEATHER)).collect()}
    assert found[day]["station"] == "A" and found[day]["precipitation_mm"] is None
    assert found[day]["snowfall_mm"] == 2.0 and len(found) == 2


def test_calendar(spark):
    rows = [(dt.date(2024, 2, 27),), (dt.date(2024, 3, 3),)]
    days = date_dimension(spark.createDataFrame(rows, "date date")).orderBy("date_key").collect()
    assert [str(d["date_key"]) for d in days] == [
        "2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02", "2024-03-03"]
    assert [d["weekday_number"] for d in days] == [2, 3, 4, 5, 6, 0]
    assert [d["is_weekend"] for d in days] == [False] * 4 + [True] * 2
    assert days[-1]["weekday_name"] == "Sunday" and days[2]["month"] == 2
    assert date_dimension(spark.createDataFrame([], "date date")).count() == 0


def test_windows_count_rows_across_calendar_gaps(spark):
    january = [dt.date(2025, 1, d) for d in range(28, 32)]
    march = [dt.date(2025, 3, d) for d in range(1, 6)]
    weather = spark.createDataFrame(
        [(d, "S", 0, None, None, None, None) for d in january + march], WEATHER)
    counts = [3, 0, 5, 1, 9, 0, 2, 4, 8]
    zone_day = spark.createDataFrame(
        [(d, 1, n, Decimal(n)) for d, n in zip(january + march, counts) if n],
        "date date, zone_key long, trip_count long, total_amount decimal(38,2)")
    rows = marts.weather_demand(zone_day, date_dimension(weather), weather).orderBy("date").collect()
    assert [r["trip_count"] for r in rows] == counts
    assert [r["change_from_previous_day"] for r in rows] == [None] + [
        b - a for a, b in zip(counts, counts[1:])]
    for i, row in enumerate(rows):
        window = counts[max(0, i - 6):i + 1]
        assert row["trailing_7_day_trips"] == pytest.approx(sum(window) / len(window))
    assert rows[1]["total_amount"] == 0


def test_marts_match_brute_force_under_a_hot_zone(spark, zones):
    """A third of all rides start in one zone on one day."""
    rng = random.Random(7)
    fact_rows = []
    for i in range(3_000):
        hot = i % 3 == 0
        day = 2 if hot else rng.randrange(1, 29)
        fact_rows.append({
            "pickup_date": dt.date(2025, 1, day), "pickup_zone_key": 1 if hot else rng.choice((1, 2)),
            "passenger_count": rng.choice((None, 1.0, 2.0)), "trip_distance": rng.randrange(40) / 4,
            "trip_duration_minutes": float(rng.randrange(60)),
            "fare_amount": Decimal(rng.randrange(-500, 9000)) / 100,
            "total_amount": Decimal(rng.randrange(9000)) / 100,
            "quality_status": rng.choice(("ACCEPTED", "SUSPICIOUS"))})
    fact = spark.createDataFrame(
        fact_rows, "pickup_date date, pickup_zone_key long, passenger_count double, "
        "trip_distance double, trip_duration_minutes double, fare_amount decimal(18,2), "
        "total_amount decimal(18,2), quality_status string")
    zone_day = marts.zone_daily(fact)
    found = {(r["date"], r["zone_key"]): r for r in zone_day.collect()}
    groups = {}
    for row in fact_rows:
        groups.setdefault((row["pickup_date"], row["pickup_zone_key"]), []).append(row)
    assert set(found) == set(groups)
    for key, rows in groups.items():
        mart = found[key]
        seen = [r["passenger_count"] for r in rows if r["passenger_count"] is not None]
        assert mart["trip_count"] == len(rows)
        assert mart["trips_with_passenger_count"] == len(seen)
        assert mart["passenger_count"] == (sum(seen) if seen else None)
        assert mart["average_trip_distance"] == pytest.approx(
            sum(r["trip_distance"] for r in rows) / len(rows))
        assert mart["fare_amount"] == sum(r["fare_amount"] for r in rows)
        assert mart["suspicious_trip_count"] == sum(
            r["quality_status"] == "SUSPICIOUS" for r in rows)
    places = Counter()
    for (day, zone), rows in groups.items():
        places[day, {1: "Manhattan", 2: "Queens"}[zone]] += len(rows)
    boroughs = marts.borough_daily(zone_day, zones)
    assert {(r["date"], r["borough"]): r["trip_count"] for r in boroughs.collect()} == places
    ranked = location_trips(boroughs).collect()
    assert [r["trips"] for r in ranked] == sorted((r["trips"] for r in ranked), reverse=True)


def test_missing_borough_label(spark):
    rows = spark.createDataFrame(
        [(None, 5), ("Bronx", 5), ("Queens", 7)], "borough string, trip_count long")
    assert [tuple(r) for r in location_trips(rows).collect()] == [
        ("Queens", 7), ("(missing label)", 5), ("Bronx", 5)]


def test_profile(spark):
    rows = [PLAIN, PLAIN | {"passenger_count": None, "trip_distance": 0.0},
            PLAIN | {"tpep_pickup_datetime": None, "fare_amount": -1.0, "trip_distance": -2.0},
            PLAIN | {"tpep_dropoff_datetime": NOON - dt.timedelta(days=31)},
            PLAIN | {"tpep_pickup_datetime": NOON.replace(second=59),
                     "tpep_dropoff_datetime": NOON + dt.timedelta(minutes=200)}]
    found = profile_trips(spark.createDataFrame(rows, TRIPS), "2025-01").first().asDict()
    assert found == {
        "source_rows": 5, "null_timestamps": 1, "backwards": 1, "outside_month": 0,
        "negative_distance": 1, "negative_fare": 1, "null_passengers": 1, "zero_distance": 1,
        "max_duration": 200}


def test_replacing_periods(spark):
    def fact(*rows):
        return spark.createDataFrame(rows, "trip_id string, source_period string")

    def months(*periods):
        return spark.createDataFrame([(p,) for p in periods], "period string")

    old = fact(("a", "2025-01"), ("b", "2025-02"), ("c", "2025-03"))
    new = fact(("x", "2025-02"), ("y", "2025-02"), ("z", "2025-04"))

    def ids(*periods):
        return sorted(r["trip_id"] for r in replace_periods(old, new, months(*periods)).collect())

    assert ids() == ["a", "b", "c"]
    assert ids("2025-02") == ["a", "c", "x", "y"]
    assert ids("2025-03") == ["a", "b"]          # replaced by nothing
    assert ids("2025-02", "2025-04") == ["a", "c", "x", "y", "z"]
    assert replace_periods(old, new, months("2025-02")).columns == old.columns


def test_work_detection(spark):
    columns = "source string, period string, raw_sha256 string, bronze_fingerprint string"
    inputs = spark.createDataFrame([
        ("trips", "2025-01", "a", "f"), ("trips", "2025-02", "b2", "f"),
        ("trips", "2025-03", "c", None), ("trips", "2025-04", "d", "g"),
        ("weather", "2025-01", "e", "f"), ("trips", "2025-05", "n", None)], columns)
    committed = spark.createDataFrame([
        ("trips", "2025-01", "a", "f"), ("trips", "2025-02", "b", "f"),
        ("trips", "2025-03", "c", "f"), ("trips", "2025-04", "d", "f"),
        ("weather", "2025-01", "e", "f"), ("trips", "2024-12", "z", "f")], columns)

    def months(*periods):
        return spark.createDataFrame([(p,) for p in periods], "period string")

    def reasons(*forced, everything=False):
        found = detect_work(inputs, committed, months(*forced), everything)
        return {(r["source"], r["period"]): r["reason"] for r in found.collect()}

    changed = {("trips", "2025-02"): "raw_changed", ("trips", "2025-03"): "bronze_missing",
               ("trips", "2025-04"): "bronze_changed", ("trips", "2025-05"): "raw_changed"}
    assert reasons() == changed
    assert reasons("2025-01") == changed | {
        ("trips", "2025-01"): "forced", ("weather", "2025-01"): "forced"}
    assert set(reasons(everything=True).values()) == {"rebuild_all"}

    periods = loaded_periods(months("2025-06"), committed)
    assert {r["period"] for r in periods.collect()} == {
        "2024-12", "2025-01", "2025-02", "2025-03", "2025-04", "2025-06"}

    def propagated(*work):
        rows = spark.createDataFrame(list(work), "source string, period string, reason string")
        return {r["period"] for r in changed_periods(rows, months("2025-01", "2025-02")).collect()}

    assert propagated(("weather", "2025-01", "raw_changed")) == set()
    assert propagated(("trips", "2025-02", "raw_changed")) == {"2025-02"}
    assert propagated(("zones", "zones", "raw_changed")) == {"2025-01", "2025-02"}


def test_fingerprint_ignores_order_and_sees_every_change(spark):
    rows = [(f"r{i}", "2025-01" if i % 3 else "2025-02", i * 0.5) for i in range(300)]

    def prints(data):
        df = spark.createDataFrame(data, "id string, source_period string, v double")
        return {tuple(r) for r in compare.content_fingerprint(df).collect()}

    base = prints(rows)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    assert prints(shuffled) == base and len(base) == 2
    assert prints(rows[:-1] + [("r299", "2025-01", 0.25)]) != base
    assert prints(rows + rows[:1]) != base


def test_comparing_tables(spark):
    columns = "k string, j long, n long, v double"
    left = spark.createDataFrame(
        [("a", 1, 1, 1.0), ("b", 1, 2, 2.0), (None, 1, 3, 3.0), ("d", 1, None, None),
         ("e", 1, 5, 1e15), ("gone", 1, 0, 0.0)], columns)
    right = spark.createDataFrame(
        [("a", 1, 1, 1.0 + 1e-10), ("b", 1, 2, 2.1), (None, 1, 3, 3.0), ("d", 1, None, None),
         ("e", 1, 5, 1e15 + 1), ("new", 1, 0, 0.0)], columns)
    row = compare.compare_tables(left, right, ["k", "j"], "t").first()
    assert (row["matched"], row["only_before"], row["only_after"], row["differing"]) == (5, 1, 1, 1)
    assert row["max_float_gap"] == 1.0
    assert not compare.equivalent(compare.compare_tables(left, right, ["k", "j"], "t"))
    assert compare.equivalent(compare.compare_tables(left, left, ["k", "j"], "t"))


def test_look_alikes(spark, zones):
    rows = staged(spark, zones, {}, {}, {"fare_amount": -10.0}, {"passenger_count": None},
                  {"total_amount": 21.0}, {"trip_distance": 0.0}, {"trip_distance": -1.0},
                  {"trip_distance": -1.0})
    groups = checks.look_alike_trips(trip_fact(rows)).collect()
    assert [g["occurrences"] for g in groups] == [4]


def test_checks_find_planted_faults(spark, zones):
    fact = spark.createDataFrame([
        Row(trip_id="a", source_period="p", pickup_zone_key=1, dropoff_zone_key=9,
            pickup_date=dt.date(2025, 1, 1), quality_status="ACCEPTED"),
        Row(trip_id="a", source_period="p", pickup_zone_key=8, dropoff_zone_key=9,
            pickup_date=dt.date(2025, 1, 5), quality_status="ODD"),
        Row(trip_id=None, source_period="p", pickup_zone_key=None, dropoff_zone_key=2,
            pickup_date=None, quality_status="ACCEPTED"),
    ])
    rules = checks.not_null_rules("fct_trips") | checks.accepted_rule("fct_trips", ["ACCEPTED"])
    found = {r["check_name"]: r["violations"] for r in checks.row_findings(fact, rules).collect()}
    assert found == {
        "not_null_fct_trips_trip_id": 1, "not_null_fct_trips_source_period": 0,
        "not_null_fct_trips_pickup_zone_key": 1, "not_null_fct_trips_dropoff_zone_key": 0,
        "not_null_fct_trips_pickup_date": 1, "accepted_values_fct_trips_quality_status": 1}
    ids = {r["check_name"]: r["violations"] for r in checks.trip_id_findings(fact).collect()}
    assert ids["unique_stg_trips_trip_id"] == 1
    calendar = spark.createDataFrame([(dt.date(2025, 1, 1),)], "date_key date")
    relations = ("pickup_zone_key", "dropoff_zone_key", "pickup_date")
    orphaned = checks.orphans(fact, zones, calendar)
    found = {r["check_name"].rsplit("trips_", 1)[1]: r["violations"]
             for r in checks.relationship_findings(orphaned, relations).collect()}
    assert found == {"pickup_zone_key": 1, "dropoff_zone_key": 2, "pickup_date": 1}
    weather = spark.createDataFrame([(dt.date(2025, 1, 1),)], "date date")
    days = checks.uncovered_dates(fact.where("pickup_date is not null"), weather).collect()
    assert [r["pickup_date"] for r in days] == [dt.date(2025, 1, 5)]
    outcome = {r["check_name"]: r["status"] for r in checks.outcomes(
        spark.createDataFrame(
            [("x", "error", 2), ("y", "warn", 1), ("x", "error", 0), ("z", "error", 0)],
            "check_name string, severity string, violations long")).collect()}
    assert outcome == {"x": "fail", "y": "warn", "z": "pass"}


def test_findings_of_keyed_tables(spark):
    rows = spark.createDataFrame(
        [(None, "a"), (None, "b"), (1, None), (1, "x"), (2, "y")], "zone_key long, borough string")
    found = {r["check_name"]: r["violations"] for r in checks.keyed_findings(
        rows, "dim_zone", "unique_dim_zone_zone_key").collect()}
    assert found == {"not_null_dim_zone_zone_key": 2, "not_null_dim_zone_borough": 1,
                     "unique_dim_zone_zone_key": 1}


def test_adapter_ordinals_are_physical(spark):
    folder = "/root/testdata/sf0.001"
    keys = pq.read_table(f"{folder}/lineitem.parquet")["l_orderkey"].to_pylist()
    rows = tables.line_items(spark, folder).select("source_row", "l_orderkey").collect()
    assert {r["source_row"]: r["l_orderkey"] for r in rows} == dict(enumerate(keys))


def test_adapter_counts(spark):
    folder = "/root/testdata/sf0.001"
    rows = classify(tables.bronze_trips(spark, folder), tables.bronze_zones(spark, folder))
    found = {r["quality_status"]: r["count"] for r in rows.groupBy("quality_status").count().collect()}
    assert found == {"ACCEPTED": 3730, "SUSPICIOUS": 2056, "INVALID": 214}
    assert not any(math.isnan(r["trip_distance"]) for r in trip_fact(rows).select(
        "trip_distance").collect())
