"""Raw trip file contract: required columns, type families, lossless casts."""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession, functions as F, types as T

from meterline.schemas import REQUIRED, TRIPS

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
#: Mark of a column that holds nanoseconds as whole numbers.
NANOSECONDS = "nanoseconds"


class ContractError(ValueError):
    """A source broke its contract; carries the source and period for run reports."""

    def __init__(self, message: str, source: str | None = None, period: str | None = None):
        super().__init__(message)
        self.source = source
        self.period = period


def footer(spark: SparkSession, path: str) -> tuple[str, frozenset[str], int]:
    """(message type, columns of nanosecond timestamps, row count) of a Parquet file.

    Read through Spark's file systems, without a job.
    """
    jvm = spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        message = reader.getFileMetaData().getSchema()
        fields = [message.getType(i) for i in range(message.getFieldCount())]
        nanoseconds = frozenset(
            f.getName() for f in fields if str(f.getLogicalTypeAnnotation()).startswith("TIMESTAMP(NANOS"))
        return message.toString(), nanoseconds, reader.getRecordCount()
    finally:
        reader.close()


def spark_schema(spark: SparkSession, path: str, nanoseconds: frozenset[str]) -> T.StructType:
    """Spark's schema of a Parquet file, with nanosecond columns marked in their metadata.

    Spark hands such columns over as whole numbers under a session setting that
    leaves all others alone; it is set once and stays, since frames need it
    when they run.
    """
    if spark.conf.get(NANOS_AS_LONG, "false") != "true":
        spark.conf.set(NANOS_AS_LONG, "true")
    return T.StructType([
        T.StructField(f.name, f.dataType, f.nullable, {NANOSECONDS: True} if f.name in nanoseconds else None)
        for f in spark.read.parquet(path).schema.fields])


def check_trip_schema(schema: T.StructType) -> None:
    """Every required column must exist with the right family; extras are allowed."""
    families = {
        "timestamp": (T.TimestampType, T.TimestampNTZType),
        "number": (T.IntegralType, T.FractionalType),
    }
    for name, family in REQUIRED.items():
        if name not in schema.fieldNames():
            raise ContractError(f"trip file lacks a column (required field missing: {name})", "trips")
        field = schema[name]
        fits = family == "timestamp" if field.metadata.get(NANOSECONDS) else isinstance(
            field.dataType, families[family])
        if not fits:
            raise ContractError(
                f"incompatible field {name}: a {family} column cannot be {field.dataType.simpleString()}", "trips")


def schema_fingerprint(schema: T.StructType) -> str:
    """Changes exactly when a column name, its type or the order changes."""
    text = ",".join(
        f"{f.name}:{f.dataType.simpleString()}{' ns' if f.metadata.get(NANOSECONDS) else ''}" for f in schema.fields)
    return hashlib.sha256(text.encode()).hexdigest()


def _guarded(
    value: Column, breaks: Column, target: T.DataType, name: str, result: Column | None = None
) -> Column:
    failure = F.raise_error(F.concat(F.lit(f"lossy cast of {name}: "), value.cast("string")))
    result = value.cast(target) if result is None else result
    return F.when(breaks, failure.cast(target)).otherwise(result)


def safe_cast(value: Column, source: T.DataType, target: T.DataType, name: str) -> Column:
    """Cast that raises instead of changing a value.

    Spark's ANSI cast already raises on overflow and NaN, but it drops
    fractions silently, and it rounds whole numbers beyond 2**53 when they
    become doubles; both are guarded here. A zone-aware timestamp keeps its UTC
    reading, independent of the session time zone.
    """
    if isinstance(target, T.LongType) and isinstance(source, T.FractionalType):
        whole = value if isinstance(source, T.DecimalType) else value.cast("double")
        breaks = whole % 1 != 0
        return _guarded(value, F.coalesce(breaks, F.lit(False)), target, name)
    if isinstance(target, T.DoubleType) and isinstance(source, T.LongType):
        limit = F.lit(2**53).cast("long")
        breaks = (value > limit) | (value < -limit)
        return _guarded(value, F.coalesce(breaks, F.lit(False)), target, name)
    if isinstance(target, T.TimestampNTZType) and isinstance(source, T.TimestampType):
        return _after_epoch(F.unix_micros(value))
    if isinstance(target, T.TimestampNTZType) and isinstance(source, T.LongType):
        # Nanoseconds, which Spark reads as bare whole numbers (see spark_schema).
        micros = F.floor(value / F.lit(1000).cast("decimal(4,0)")).cast("long")
        return _guarded(
            value, F.coalesce(value % 1000 != 0, F.lit(False)), target, name, _after_epoch(micros))
    return value.cast(target)


def _after_epoch(micros: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (micros.cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(secs=seconds)


def typed_trips(schema: T.StructType) -> list[Column]:
    """Required columns of a raw file in bronze types."""
    check_trip_schema(schema)
    return [
        safe_cast(F.col(name), schema[name].dataType, TRIPS[name].dataType, name).alias(name)
        for name in REQUIRED
    ]
