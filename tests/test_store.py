"""The commit log: replay, checkpoints and vacuum, with hundreds of commits."""
import pytest
from pyspark.sql import functions as F

from meterline.plans import commits as log
from meterline.plans.refresh import Refresh, many_small
from meterline.plans.store import COMMITS, ENTRY, Commit, Store
from meterline.plans.tables import local_rows
from tests.inputs import register_month


def entry(source, period, run):
    return {n: None for n in ENTRY.fieldNames()} | {
        "source": source, "period": period, "bronze_run": run, "gold_run": run, "bronze_rows": 1, "fact_rows": 1}


def publish(store, count, periods=5):
    """Commit n replaces period n mod `periods`; returns the expected entries after every commit."""
    entries, states, before = {}, {}, Commit(0, None, None, {})
    for n in range(1, count + 1):
        key = ("trips", f"p{n % periods}")
        entries = entries | {key: entry(*key, f"r{n}")}
        commit = Commit(n, f"r{n}", "1", entries)
        store.publish(commit, before)
        before, states[n] = commit, entries
    return states


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    store = Store(spark, f"file:{tmp_path_factory.mktemp('log')}", checkpoint_every=10)
    return store, publish(store, 205)


def test_one_checkpoint_and_a_tail_are_read(filled, monkeypatch):
    store, states = filled
    last = store.latest()
    assert (last.sequence, last.run_id, last.entries) == (205, "r205", states[205])
    real, asked = type(store.spark.read).parquet, []
    monkeypatch.setattr(type(store.spark.read), "parquet", lambda self, *p: (asked.extend(p), real(self, *p))[1])
    assert store.latest() == last
    assert [p.rsplit("/", 2)[1] for p in asked] == ["checkpoints"] + ["commits"] * 5
    for n in (1, 9, 10, 11, 104):
        assert store.generation(f"r{n}").entries == states[n]
    with pytest.raises(LookupError):
        store.generation("r206")


def test_the_log_as_data_agrees(filled):
    store, states = filled
    versions = store.versions()
    assert versions.count() == 205
    for n in (3, 10, 205):
        found = {(r["source"], r["period"]): r["gold_run"] for r in log.state(versions, n).collect()}
        assert found == {k: e["gold_run"] for k, e in states[n].items()}
    # Generations 200 to 205 consist of the versions from 196 on: 195 was replaced by 200.
    assert sorted(r["sequence"] for r in log.live(versions, 200).collect()) == list(range(196, 206))


def test_an_unfinished_commit_does_not_count(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}")
    publish(store, 2)
    row = {"sequence": 3, "run_id": "r3", "logic_version": "1", "entries": []}
    local_rows(spark, [row], COMMITS).write.parquet(f"{tmp_path}/commits/000000000003-r3")
    (tmp_path / "commits" / "000000000003-r3" / "_SUCCESS").unlink()
    assert store.latest().run_id == "r2"


def test_vacuum_keeps_what_any_kept_generation_needs(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    refresh = Refresh(spark, str(tmp_path / "data"))
    store = refresh.store
    register_month(refresh, landing, "2025-01")
    register_month(refresh, landing, "2025-02")
    runs = [refresh.run("2025-01", "2025-02")["run_id"]]
    for month in ("2025-02", "2025-02"):
        runs.append(refresh.run("2025-01", "2025-02", force=(month,))["run_id"])
    facts = {r: sorted(map(tuple, store.table("fct_trips", r).collect())) for r in runs[1:]}
    would = store.vacuum(2, dry_run=True)
    assert store.vacuum(2) == would and would
    assert not any("period=2025-01" in f for f in would) and f"{store.root}/reports/run={runs[0]}" in would
    assert all(runs[0] in f for f in would)
    assert {r: sorted(map(tuple, store.table("fct_trips", r).collect())) for r in runs[1:]} == facts
    assert store.table("mart_zone_daily", runs[1]).count() == 2
    with pytest.raises(LookupError):
        store.table("fct_trips", runs[0])
    assert store.vacuum(2) == [] and refresh.run("2025-01", "2025-02")["build_skipped"]
    store.vacuum(1)
    assert sorted(map(tuple, store.table("fct_trips").collect())) == facts[runs[2]]
    assert refresh.run("2025-01", "2025-02", force=("2025-01",))["partitions_processed"] == ["2025-01"]
    with pytest.raises(ValueError):
        store.vacuum(0)


def test_folders_of_failed_runs_go(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}")
    publish(store, 1)
    spark.range(1).withColumn("period", F.lit("p1")).write.partitionBy("period").parquet(
        f"{tmp_path}/gold/fct_trips/run=failed")
    assert store.vacuum(1) == [f"file:{tmp_path}/gold/fct_trips/run=failed/period=p1"]
    assert not list((tmp_path / "gold").rglob("*.parquet"))


def test_files_follow_the_size_of_a_period(spark, tmp_path):
    """Forty tasks with rows of all twelve months: a file per small month, several for the hot one."""
    store = Store(spark, f"file:{tmp_path}")
    month = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 12 + 1).cast("string")
    rows = spark.range(0, 400_000, 1, 40).select(
        F.concat(F.lit("p"), month).alias("period"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # so that few months share a reducer with the hot one
    try:
        for rebalance in (True, False):
            store.write_gold("t", f"r{rebalance}", rows, rebalance)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    count = lambda run, p: len(list((tmp_path / "gold" / "t" / f"run={run}" / f"period={p}").glob("part-*")))
    assert 3 <= count("rTrue", "p1") <= 12 and all(count("rTrue", f"p{m}") <= 3 for m in (2, 4, 6, 8, 10, 12))
    assert count("rFalse", "p1") == 40 == count("rFalse", "p4")
    read = spark.read.parquet(f"{tmp_path}/gold/t/run=rTrue")
    assert read.count() == 400_000 and read.select("text").distinct().count() == 400_000
    plan = store._by_period(rows, True)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "Sort" not in plan


def test_small_files_are_told_from_large_ones():
    assert many_small([1000] * 30, 10) and not many_small([1000] * 20, 10) and not many_small([2**27] * 30, 10)
