"""Raw trip files -> typed bronze rows with a stable identity."""
from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.plans.tables import together
from meterline.schemas import TRIPS
from meterline.sources.contracts import (
    ContractError, check_trip_schema, footer, spark_schema, typed_trips,
)
from meterline.sources.files import qualified, scan_files


@dataclass(frozen=True)
class TripFile:
    """A registered file; `schema` as described at registration, or None to look again."""

    period: str
    path: str
    sha256: str
    schema: T.StructType | None = None


def described(spark: SparkSession, paths: list[str]) -> dict[str, tuple[T.StructType, int]]:
    """(schema, row count) per path, from footers read in parallel; one schema look-up per kind of file."""
    footers = dict(zip(paths, together(*[lambda p=p: footer(spark, p) for p in paths]))) if paths else {}
    kinds = {}
    for path, (message, nanoseconds, _) in footers.items():
        if message not in kinds:
            kinds[message] = spark_schema(spark, path, nanoseconds)
    return {path: (kinds[message], rows) for path, (message, _, rows) in footers.items()}


def checked_trip_files(spark: SparkSession, paths: list[str]) -> dict[str, tuple[T.StructType, int]]:
    """As `described`, for files that keep the contract."""
    found = described(spark, paths)
    for schema, _ in found.values():
        check_trip_schema(schema)
    return found


def bronze_files(spark: SparkSession, files: list[TripFile]) -> DataFrame:
    """Raw files as bronze rows, one scan per distinct schema.

    The reader numbers the physical rows of each file, also when it is split
    over many tasks or read under a filter, so (digest, number) identifies a
    source row for as long as the raw file is immutable.
    """
    if not files:
        return spark.createDataFrame([], TRIPS)
    files = [TripFile(f.period, qualified(spark, f.path), f.sha256, f.schema) for f in files]
    unknown = described(spark, [f.path for f in files if f.schema is None])
    groups: dict[str, list[TripFile]] = defaultdict(list)
    schemas = {}
    for f in files:
        schema = f.schema or unknown[f.path][0]
        groups[schema.json()].append(f)
        schemas[schema.json()] = schema
    out = None
    for key, members in sorted(groups.items()):
        try:
            columns = typed_trips(schemas[key])
        except ContractError as broken:
            raise ContractError(str(broken), "trips", members[0].period) from broken

        def read(paths, schema=schemas[key], columns=columns):
            return spark.read.schema(schema).parquet(*paths).select(
                *columns, F.col("_metadata.row_index").alias("source_row"),
                F.col("_metadata.file_path").alias("file_uri"))
        rows = scan_files(spark, [(f.path, f.period, f.sha256) for f in members], read).withColumnsRenamed(
            {"file_period": "source_period", "file_sha256": "source_sha256"}).to(TRIPS)
        out = rows if out is None else out.unionByName(rows)
    return out


def bronze_file(spark: SparkSession, file: TripFile) -> DataFrame:
    return bronze_files(spark, [file])
