"""Tree digests against a brute-force tree, with small leaves."""
import hashlib

import pytest
from pyspark.sql import functions as F

from meterline.sources.digests import arrow_reads, content_digests, file_digests


def tree(data: bytes, leaf: int, fan_out: int = 1024) -> str:
    nodes = [hashlib.sha256(data[i:i + leaf]).hexdigest() for i in range(0, max(1, len(data)), leaf)]
    while len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i:i + fan_out]).encode()).hexdigest()
                 for i in range(0, len(nodes), fan_out)]
    return nodes[0]


@pytest.fixture
def folder(tmp_path):
    for i, size in enumerate((1, 99, 100, 101, 1000, 12_345, 250_007)):
        (tmp_path / f"odd name%20 {i}.bin").write_bytes(bytes((i * 31 + j * j) % 256 for j in range(size)))
    (tmp_path / "empty.bin").write_bytes(b"")
    return tmp_path


@pytest.mark.parametrize("ranges", [True, False, None])
@pytest.mark.parametrize("leaf", [100, 1000, 10**6])
def test_files_equal_a_brute_force_tree(spark, folder, ranges, leaf):
    found = {r["path"]: (r["length"], r["sha256"])
             for r in file_digests(spark, str(folder), leaf_bytes=leaf, ranges=ranges).collect()}
    assert found == {f"file:{p}": (p.stat().st_size, tree(p.read_bytes(), leaf))
                     for p in folder.iterdir() if p.stat().st_size}


def test_one_leaf_is_the_plain_digest_and_many_levels_join_up(spark, folder):
    path = folder / "odd name%20 6.bin"
    plain = file_digests(spark, [str(path)]).first()["sha256"]
    assert plain == hashlib.sha256(path.read_bytes()).hexdigest()
    # 250,007 leaves of one byte: 245 nodes, then one.
    assert file_digests(spark, [str(path)], leaf_bytes=1).first()["sha256"] == tree(path.read_bytes(), 1)


def test_leaves_of_one_file_are_read_by_many_tasks(spark, folder):
    plan = file_digests(spark, str(folder), leaf_bytes=100)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "MapInArrow" in plan


def test_file_systems_arrow_does_not_know():
    assert arrow_reads("file:/tmp") and not arrow_reads("viewfs://store/in")


@pytest.mark.parametrize("fan_out", [2, 3, 1024])
def test_contents(spark, fan_out):
    rows = [(i, bytes(j % 251 for j in range(size))) for i, size in enumerate((0, 1, 9, 10, 11, 95, 1000))]
    rows += [(50, None), (None, b"x" * 33)]
    df = spark.createDataFrame(rows, "id long, data binary")
    found = {r["id"]: tuple(r)[1:] for r in content_digests(df, "id", F.col("data"), 10, fan_out).collect()}
    assert found.pop(50) == (None, None, None)
    assert found == {i: (len(d), max(1, -(-len(d) // 10)), tree(d, 10, fan_out)) for i, d in rows if d is not None}
    assert content_digests(df.limit(0), "id", F.col("data")).count() == 0
