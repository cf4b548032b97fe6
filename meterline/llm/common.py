"""Helpers that the corpus operators share."""
from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import meterline
from meterline.session import shared_folder

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors, once per application.

    Functions in tasks are found by name, so a worker must be able to import
    them wherever the driver was started. Spark copies the archive; nothing
    reads it from the driver's disk later on.
    """
    context, home = spark.sparkContext, Path(meterline.__file__).parent
    if context.applicationId in _SHIPPED or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp()) / "meterline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, source.relative_to(home.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder of the cluster."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compact: bool = False) -> DataFrame:
    """`df` written once to the shared folder; cuts lineage without pinning it to executors.

    `compact`: for narrow rows that many tasks made few of each; they are dealt
    evenly to as many files as the cluster has cores.
    """
    spark = df.sparkSession
    ship(spark)
    path = scratch(spark, label)
    (df.repartition(spark.sparkContext.defaultParallelism) if compact else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def connected(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node that `edges` (u, v) lead to.

    Alternates two contractions until nothing changes: every node's larger
    neighbours are tied to its smallest one, then its smaller ones are. Only
    ids move; a node with many neighbours is reduced by partial aggregates, and
    as its smallest neighbour is written before the join, adaptive execution can
    split its rows over tasks there. Every round is written to the shared
    folder. Null ends and self loops are dropped.
    """
    e = edges.select("u", "v").where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, label, compact=True)
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), label, compact=True)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(
            F.explode(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").where("u <> v").distinct(), label, compact=True)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
