"""Daily weather CSV: scan, masking of rejected measurements, file contract."""
from __future__ import annotations

import json
from collections import defaultdict

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from meterline.functions.expressions import days_in_month, period_of
from meterline.schemas import MEASUREMENTS, STATION, WEATHER
from meterline.sources.contracts import ContractError
from meterline.sources.files import qualified, scan_files

TEXT_COLUMNS = ("STATION", "DATE", *MEASUREMENTS)


#: A full ISO day, alone or before a time of day.
ISO_DAY = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]+)?)?)?$"


def csv_columns(spark: SparkSession, path: str) -> T.StructType:
    """The header of a CSV file, every column as text."""
    names = spark.read.csv(path, header=True, inferSchema=False).columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_weather_text(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """All columns as text; header names decide, absent optional columns do not matter.

    Several paths must have the header `schema`.
    """
    schema = schema or csv_columns(spark, path)
    missing = [name for name in ("STATION", "DATE") if name not in schema.fieldNames()]
    if missing:
        raise ContractError(f"weather file without {', '.join(missing)} (required field missing)", "weather")
    return spark.read.schema(schema).csv(path, header=True, multiLine=True)


def strict_day(text: Column) -> Column:
    """The day of a full ISO date or timestamp; null for null, an error for any other text."""
    day = F.regexp_extract(text, ISO_DAY, 1)
    broken = F.raise_error(F.concat(F.lit("not an ISO date: "), text)).cast("date")
    return F.when(text.isNotNull(), F.coalesce(F.when(day != "", F.try_to_date(day)), broken))


def observations(text: DataFrame, *extra: Column) -> DataFrame:
    """Typed day rows.

    A measurement is null when blank or when its attribute list carries a
    non-blank second token; the number of such rejections is kept per row.
    """
    def column(name):
        return F.col(name) if name in text.columns else F.lit(None).cast("string")

    def rejected(name):
        second = F.get(F.split(column(f"{name}_ATTRIBUTES"), ",", -1), F.lit(1))
        return F.coalesce(F.trim(second) != "", F.lit(False))

    def value(name):
        usable = ~rejected(name) & (column(name) != "")
        return F.when(usable, column(name).cast("double"))

    flagged = sum((rejected(name).cast("long") for name in MEASUREMENTS), F.lit(0).cast("long"))
    return text.select(
        strict_day(F.col("DATE")).alias("date"),
        F.col("STATION").alias("station"),
        flagged.alias("quality_flagged_values"),
        *[value(name).alias(field) for name, field in MEASUREMENTS.items()],
        *extra,
    )


def weather_contract(
    claimed: DataFrame, station: str = STATION
) -> DataFrame:
    """Contract findings per claimed period.

    `claimed` has columns period, station and date. A period is complete when
    it has exactly one row for each of its calendar days.
    """
    in_period = period_of(F.col("date")) == F.col("period")
    first_day = F.to_date(F.concat("period", F.lit("-01")))
    return (
        claimed.groupBy("period")
        .agg(
            F.count("*").alias("row_count"),
            F.countDistinct("date").alias("distinct_days"),
            F.count_if(~F.col("station").eqNullSafe(station)).alias("unexpected_station"),
            F.count_if(~F.coalesce(in_period, F.lit(False))).alias("outside_period"),
        )
        .withColumn("expected_days", days_in_month(first_day).cast("long"))
        .withColumn(
            "complete",
            (F.col("row_count") == F.col("expected_days"))
            & (F.col("distinct_days") == F.col("expected_days")),
        )
    )


def checked_weather(
    spark: SparkSession, files: dict[str, str] | list[tuple[str, str, T.StructType | None]],
    station: str = STATION,
) -> DataFrame:
    """Bronze weather of several months, or a ContractError.

    `files` are (period, path, header) or period -> path. Files with the same
    header are read together, as their optional columns agree.
    """
    if isinstance(files, dict):
        files = [(period, path, None) for period, path in files.items()]
    groups = defaultdict(list)
    for period, path, schema in files:
        path = qualified(spark, path)
        groups[(schema or csv_columns(spark, path)).json()].append((path, period, ""))
    rows = None
    for header, members in sorted(groups.items()):
        schema = T.StructType.fromJson(json.loads(header))

        def read(paths, schema=schema):
            text = read_weather_text(spark, paths, schema)
            return observations(text, F.col("_metadata.file_path").alias("file_uri"))
        part = scan_files(spark, members, read).withColumnRenamed("file_period", "period").drop("file_sha256")
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.select(*WEATHER.fieldNames(), "period")
    try:
        found = {r["period"]: r for r in weather_contract(rows, station).collect()}
    except PySparkException as problem:
        if "not an ISO date" not in str(problem):
            raise
        raise ContractError(f"weather file with a date that is not ISO: {problem}", "weather") from problem
    for period in sorted({period for period, _, _ in files}):
        finding = found.get(period)
        if finding and finding["unexpected_station"]:
            raise ContractError(f"unexpected station in the weather of {period}", "weather", period)
        if finding and finding["outside_period"]:
            raise ContractError(f"weather of {period} holds a date outside source period", "weather", period)
        if not finding or not finding["complete"]:
            raise ContractError(f"weather of {period} has missing or duplicate dates", "weather", period)
    return rows
