"""Small append-only tables: the ledger, commits and run records."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def append_rows(df: DataFrame, path: str) -> None:
    """Add a few rows as one file, which becomes visible in a single rename."""
    df.coalesce(1).write.mode("append").parquet(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows so far; an absent table is an empty one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def local_rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Driver-side bookkeeping rows (sources x months) as a local relation.

    Handed over as Arrow: no task is needed to read it, and Spark knows its
    size when it plans joins.
    """
    rows = [r if isinstance(r, (dict, tuple)) and not hasattr(r, "asDict") else r.asDict()
            for r in rows]
    names = schema.fieldNames()
    columns = {
        name: [row.get(name) if isinstance(row, dict) else row[i] for row in rows]
        for i, name in enumerate(names)}
    table = pa.table(columns, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def together(*jobs) -> list:
    """Submit independent Spark jobs at once and wait; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=min(len(jobs), 16) or 1) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
