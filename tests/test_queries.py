"""Every registered query against its SQL, and the shape of the plans."""
import contextlib
import io

import pytest

import __spark_entry__ as driver
from meterline import catalogue
from tests.oracle_compare import database, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("extended")
    return text.getvalue()


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(catalogue.QUERIES) - set(SQL) == {"file_digests"}


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name in SQL:
        _, only_spark, only_sql = differences(df, connection, SQL[name])
        assert not only_spark and not only_sql
    else:
        assert df.count() > 0


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["date", "trip_count", "total_amount"] and df.count() == 2289


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(QUERIES["report_quality_totals"](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("c_name" in s or "o_totalprice" in s or "l_tax" in s for s in scans)
    assert "sha2" not in plan.split("== Physical Plan ==")[1]


def test_order_join_is_never_broadcast(spark):
    plan = plan_of(QUERIES["fact_trips"](spark, FOLDER)).split("== Physical Plan ==")[1]
    assert "SortMergeJoin [l_orderkey" in plan


def test_a_correction_is_carried_by_the_orders(spark):
    """Line items join the orders once; the mark of the corrected periods is joined to the orders, below that."""
    plan = plan_of(QUERIES["period_replacement"](spark, FOLDER)).split("== Optimized Logical Plan ==")[1]
    plan = plan.split("== Physical Plan ==")[0].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    join, = [i for i, line in enumerate(plan) if "Join" in line and "l_orderkey" in line]
    mark, = [i for i, line in enumerate(plan) if "Join LeftOuter" in line and "source_period" in line]
    assert mark > join and depth(plan[mark]) > depth(plan[join])
    assert sum("lineitem" in line or "l_orderkey" in line and "Relation" in line for line in plan) == 1


def test_totals_are_reconciled_in_one_pass(spark, monkeypatch):
    """Trips are classified for one settled aggregate; nothing else reads the line items but the weather."""
    settled, real = {}, catalogue.settle
    monkeypatch.setattr(catalogue, "settle", lambda df, label: settled.setdefault(label, plan_of(df)) and real(df, label))
    plan = plan_of(QUERIES["check_reconciliation"](spark, FOLDER))
    assert set(settled) == {"weather", "totals"} and "lineitem" not in plan
    scans = [s for s in settled["totals"].split("== Physical Plan ==")[1].splitlines() if "FileScan" in s and "lineitem" in s]
    assert len(scans) == 1


def test_every_check_finds_planted_faults(spark):
    found = {r["check_name"]: r for r in QUERIES["check_faults"](spark, FOLDER).collect()}
    assert len(found) == 38 and all(r["violations"] > 0 for r in found.values())
    assert {r["status"] for r in found.values()} == {"warn", "fail"}
