"""Stored generations: ordered files, observed counts, differences, consistency with the run record."""
from functools import reduce

import pytest
from pyspark.sql import functions as F

from meterline.operators import compare
from meterline.plans import generations
from meterline.plans.refresh import Refresh
from meterline.plans.store import Store
from tests.inputs import register_month, rides, write_rides


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """Two publications of two months; in the second, one ride of February is gone."""
    landing = tmp_path_factory.mktemp("landing")
    refresh = Refresh(spark, str(tmp_path_factory.mktemp("data")))
    for month in ("2025-01", "2025-02"):
        register_month(refresh, landing, month)
    first = refresh.run("2025-01", "2025-02")
    refresh.register([("trips", "2025-02", str(write_rides(landing, rides("2025-02").slice(1))))])
    return refresh, first, refresh.run("2025-01", "2025-02")


def test_counts_of_the_record_equal_recounts(runs):
    refresh, _, last = runs
    found = {r["measure"]: r["value"] for r in generations.recorded_totals(refresh.runs(), last["run_id"]).collect()}
    store = refresh.store
    for name in ("fct_trips", *generations.EXPORTS):
        assert found[f"gold_{name}"] == store.table(name).count()
    quality = {r["quality_status"]: r["n"] for r in store.table("mart_quality").groupBy("quality_status").agg(
        F.sum("trip_count").alias("n")).collect()}
    assert (found["input_rows"], found["quality_warnings"], found["invalid_rows"]) == (
        sum(quality.values()), quality["SUSPICIOUS"], quality["INVALID"])


def test_differences_name_the_rows(runs):
    refresh, first, last = runs
    found = {(r["table_name"], r["key"], r["kind"]) for r in generations.differences(
        refresh.store, first["run_id"], last["run_id"]).collect()}
    # Another file has other trip ids; every row of February's fact is a new one.
    facts = [(k, kind) for t, k, kind in found if t == "fct_trips"]
    assert sum(kind == "only_before" for _, kind in facts) == 5 and sum(kind == "only_after" for _, kind in facts) == 4
    assert ("mart_zone_daily", "2025-02-02|1", "differing") in found
    assert ("mart_weather_demand", "2025-02-03", "differing") in found  # its change from the day before
    assert not any(t in ("dim_date", "dim_zone") or "2025-01" in k for t, k, _ in found if t != "fct_trips")
    assert generations.differences(refresh.store, last["run_id"], last["run_id"]).isEmpty()


def test_shared_folders_are_not_read(runs, monkeypatch):
    refresh, first, last = runs
    asked, real = [], Store._read
    monkeypatch.setattr(Store, "_read", lambda self, schema, folders: (asked.extend(folders), real(self, schema, folders))[1])
    generations.differences(refresh.store, first["run_id"], last["run_id"])
    assert asked and all("period=2025-02" in f for f in asked)


def test_only_rows_of_changed_buckets_are_compared(spark):
    left = spark.range(10_000).select("id", (F.col("id") / 7).alias("x"), F.lit(None).cast("string").alias("t"))
    right = left.withColumn("x", F.when(F.col("id") == 77, 0.0).otherwise(F.col("x") * (1 + 1e-14))).where("id <> 78")
    prints = [compare.bucket_prints(df, ["id"], F.lit(""), 100) for df in (left, left.where("id <> 78"))]
    changed = compare.changed_buckets(*prints)
    assert changed.count() == 1
    kept = compare.rows_of(left, changed, ["id"], F.lit(""), 100)
    assert 50 < kept.count() < 200 and kept.columns == left.columns
    found = {(r["key"], r["kind"]) for r in compare.differing_keys(left, right, ["id"], "t").collect()}
    assert found == {("77", "differing"), ("78", "only_before")}


def test_nulls_that_change_places_are_seen(spark):
    left = spark.createDataFrame([(1, "a", None)], "id int, x string, y string")
    right = spark.createDataFrame([(1, None, "a")], "id int, x string, y string")
    assert [r["kind"] for r in compare.differing_keys(left, right, ["id"], "t").collect()] == ["differing"]


def test_a_generation_agrees_with_its_record_until_it_is_tampered_with(runs):
    refresh, _, last = runs
    def holds():
        return {r["requirement"]: r["holds"] for r in generations.stored_consistency(
            refresh.store, refresh.runs(), last["run_id"]).collect()}
    assert len(holds()) == 10 and all(holds().values())
    folder = refresh.store.report_folder(last["run_id"], "mart_quality", "parquet")
    rows = refresh.spark.createDataFrame(refresh.store.table("mart_quality").collect(), refresh.store.table("mart_quality").schema)
    rows.withColumn("trip_count", F.col("trip_count") + 1).write.mode("overwrite").parquet(folder)
    after = holds()
    assert not after["monthly_equals_retained"] and not after["source_equals_input"] and after["days_as_recorded"]


def test_both_kinds_of_files_are_in_order_after_one_sort(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}")
    rows = spark.range(5_000).select(F.xxhash64("id").alias("a"), (F.col("id") % 7).alias("b"))
    rows = rows.withColumn("a", F.when(F.col("b") > 0, F.col("a")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        marts = generations.Marts(store, "r", {"mart": rows})
        marts.write()
        marts.write_csv("mart")
        assert "InMemoryTableScan" in marts.ordered["mart"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    for kind in ("parquet", "csv"):
        parts = sorted((tmp_path / "reports" / "run=r" / "mart" / kind).glob("part-*"))
        assert len(parts) > 2
        read = [spark.read.schema(rows.schema).option("header", "true").format(kind).load(str(p)).collect() for p in parts]
        keys = [(r["a"] is None, r["a"] or 0, r["b"]) for r in reduce(lambda x, y: x + y, read)]
        assert keys == sorted(keys) and len(keys) == 5_000
    assert marts.counts == {"mart": 5_000}
    marts.close()
