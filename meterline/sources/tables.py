"""Trip-shaped inputs derived from the provided order tables.

The provided tables hold no trips, so a fixed projection reads each line item
as one ride of its order's customer: the order date is the pickup day, nations
are zones, and rules on the keys plant every kind of fault. The operators then
run on it exactly as on raw files.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.functions.expressions import period_of
from meterline.plans.ledger import LEDGER, current
from meterline.schemas import TRIPS
from meterline.sources.periods import spine_between
from meterline.sources.weather import observations


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the physical position of each row in its file.

    The reader supplies the position, so identity costs neither a shuffle nor
    a sort and does not depend on how the file is split.
    """
    return _table(spark, sf_dir, "lineitem").select(
        "*",
        F.col("_metadata.row_index").alias("source_row"),
        F.col("_metadata.file_name").alias("source_file"),
    )


def _rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a trip takes from its line item alone, computed before any join."""
    return line_items(spark, sf_dir).selectExpr(
        "l_orderkey", "l_suppkey", "source_row", "source_file",
        "int(case when l_orderkey % 211 = 0 then null when l_orderkey % 223 = 0 then -57600 "
        "else (l_partkey * 7 + l_linenumber * 131) % 1440 end) as start_minute",
        "int(if(l_orderkey % 199 = 0, -1, l_partkey % 200)) as ride_minutes",
        "bigint(if(l_orderkey % 227 = 0, 999, null)) as fixed_zone",
        "l_orderkey % 229 = 0 and l_orderkey % 227 <> 0 as zone_lost",
        "bigint(if(l_partkey % 29 = 0, 99, null)) as odd_payment",
        "case when l_partkey % 17 = 0 then null when l_partkey % 19 = 0 then 0D "
        "when l_partkey % 23 = 0 then 1.5D else double(l_linenumber) end as passenger_count",
        "case when l_orderkey % 233 = 0 then -1D when l_orderkey % 239 = 0 then double('NaN') "
        "when l_partkey % 13 = 0 then 0D else l_quantity / 2 end as trip_distance",
        "case when l_orderkey % 241 = 0 then double('NaN') "
        "when l_returnflag = 'R' and l_linenumber = 7 then -l_extendedprice "
        "else l_extendedprice end as fare_amount",
        "l_discount * 100 as tip_amount",
        "l_extendedprice + l_discount * 100 as total_amount",
    )


def bronze_trips(
    spark: SparkSession, sf_dir: str, marked: DataFrame | None = None,
) -> DataFrame:
    """Bronze trips. Line items are shuffled for orders and suppliers only.

    With `marked` (column period), a column of that name tells the trips of
    those periods; the orders carry it through their one join with the line items.

    Customers are resolved on the (four times smaller) order side first. Both
    sides of the order join grow with the data and neither may ever be copied
    to every executor, hence the merge hint; elsewhere Spark decides by size.
    AQE splits hot keys of the shuffle joins.
    """
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as o_custkey", "bigint(c_nationkey) as home_zone")
    orders = _table(spark, sf_dir, "orders").join(customers, "o_custkey").selectExpr(
        "o_orderkey as l_orderkey", "o_orderdate", "home_zone",
        "substring(string(date(o_orderdate)), 1, 7) as source_period",
        "bigint(substring(o_orderpriority, 1, 1)) as priority",
    )
    more = []
    if marked is not None:
        chosen = marked.select(F.col("period").alias("source_period"), F.lit(True).alias("marked")).distinct()
        orders = orders.join(chosen, "source_period", "left")
        more = [F.coalesce("marked", F.lit(False)).alias("marked")]
    suppliers = _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as l_suppkey", "bigint(s_nationkey) as DOLocationID")
    trips = _rides(spark, sf_dir).join(orders.hint("merge"), "l_orderkey").selectExpr(
        "*",
        "o_orderdate + make_dt_interval(0, 0, start_minute) as tpep_pickup_datetime",
        "o_orderdate + make_dt_interval(0, 0, start_minute + ride_minutes) "
        "as tpep_dropoff_datetime",
        "if(zone_lost, null, coalesce(fixed_zone, home_zone)) as PULocationID",
        "coalesce(odd_payment, priority) as payment_type",
        "sha2(concat_ws('/', source_period, source_file), 256) as source_sha256",
    )
    return trips.join(suppliers, "l_suppkey").select(*TRIPS.fieldNames(), *more)


def bronze_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return nations.join(_table(spark, sf_dir, "region"), "r_regionkey").select(
        F.col("n_nationkey").cast("long").alias("zone_key"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("Area "), F.col("r_regionkey").cast("string")).alias("service_zone"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather text rows as a station file has them: one per day and station.

    Measurements are maxima and minima over the day's shipments (free of
    summation order); attribute texts follow from how many were untaxed.
    """
    day = F.col("l_shipdate").cast("date")
    daily = _table(spark, sf_dir, "lineitem").groupBy(
        day.alias("day"), F.concat(F.lit("STATION-"), F.col("l_returnflag")).alias("STATION")
    ).agg(
        F.max("l_quantity").alias("rain"), F.min("l_discount").alias("snow"),
        F.min("l_tax").alias("low"), F.max("l_linenumber").alias("high"),
        F.count_if(F.col("l_tax") == 0).alias("untaxed"),
        F.count("*").alias("shipments"),
    )
    claimed = F.when((F.col("STATION") == "STATION-R") & (F.dayofmonth("day") == 1),
                     F.date_sub("day", 1)).otherwise(F.col("day"))
    kind = F.col("untaxed") % 4
    return daily.select(
        period_of(claimed).alias("period"),
        "STATION",
        F.col("day").cast("string").alias("DATE"),
        F.when(F.col("shipments") % 7 == 0, "").otherwise(F.col("rain").cast("string"))
        .alias("PRCP"),
        F.col("snow").cast("string").alias("SNOW"),
        F.when(F.col("shipments") % 5 == 0, None).otherwise(F.col("low").cast("string"))
        .alias("TMIN"),
        F.col("high").cast("string").alias("TMAX"),
        F.when(kind == 0, ",,W,").when(kind == 1, ",X,W,").when(kind == 2, "T")
        .alias("PRCP_ATTRIBUTES"),
        F.when(F.col("untaxed") % 3 == 1, ", ,W").when(F.col("untaxed") % 3 == 2, ",Q")
        .otherwise("").alias("SNOW_ATTRIBUTES"),
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stations, so a date may have several rows before staging."""
    return observations(raw_weather(spark, sf_dir))


def corrected_trips(bronze: DataFrame, which: Column | None = None) -> DataFrame:
    """A later version of the trips (of those that `which` tells): July wholly invalid, every second March row too."""
    month = F.substring("source_period", 6, 2)
    broken = (month == "07") | ((month == "03") & (F.col("source_row") % 2 == 0))
    broken = broken if which is None else which & broken
    return bronze.withColumn(
        "trip_distance", F.when(broken, -1.0).otherwise(F.col("trip_distance")))


def corrected_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_months(spark, sf_dir).where(F.substring("period", 6, 2).isin("03", "07"))


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine_between(_table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last")))


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows: per month and line status, one file version per return flag.

    Digests come from a checksum over all shipments of the version and collide
    now and then between months.
    """
    c = F.col
    versions = _table(spark, sf_dir, "lineitem").groupBy(
        period_of(c("l_shipdate")).alias("period"), "l_linestatus", "l_returnflag"
    ).agg(
        F.count("*").alias("row_count"),
        F.sum("l_partkey").alias("length"),
        F.max("l_shipdate").alias("registered_at"),
    )
    source = F.when(c("l_linestatus") == "F", "trips").otherwise("weather")
    return versions.select(
        source.alias("source"),
        "period",
        F.concat_ws("/", F.lit("landing"), source, F.concat_ws("-", "period", "l_returnflag"))
        .alias("path"),
        "length",
        F.sha2((c("length") % 499).cast("string"), 256).alias("sha256"),
        "row_count",
        F.sha2("l_returnflag", 256).alias("schema_fingerprint"),
        F.lit(None).cast("string").alias("schema_json"),
        F.concat(F.sha2((c("length") % 499).cast("string"), 256), F.lit("/"), "period", F.lit("-"), "l_returnflag")
        .alias("batch"),
        "registered_at",
    ).to(LEDGER)


def run_inputs(ledger: DataFrame) -> DataFrame:
    """Current inputs with the bronze found for them (some of it missing)."""
    found = F.concat(F.lit("bronze-"), (F.col("row_count") % 3).cast("string"))
    return current(ledger).select(
        "source", "period", F.col("sha256").alias("raw_sha256"),
        F.when(F.col("row_count") % 7 != 0, found).alias("bronze_fingerprint"))


def last_committed(ledger: DataFrame) -> DataFrame:
    """What the previous run published: the version of return flag N."""
    found = F.concat(
        F.lit("bronze-"), F.when(F.col("length") % 5 == 0, F.lit("old"))
        .otherwise((F.col("row_count") % 3).cast("string")))
    return ledger.where(F.col("path").endswith("-N")).select(
        "source", "period", F.col("sha256").alias("raw_sha256"),
        found.alias("bronze_fingerprint"))


def zone_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two zone lookups: the nations, and one with a row per customer."""
    nations = bronze_zones(spark, sf_dir).select(F.lit("nations").alias("lookup"), "zone_key")
    customers = _table(spark, sf_dir, "customer").select(
        F.lit("customers").alias("lookup"), F.col("c_nationkey").cast("long").alias("zone_key"))
    return nations.unionByName(customers)


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records: one run per order month, some of them failed."""
    return _table(spark, sf_dir, "orders").groupBy(
        period_of(F.col("o_orderdate")).alias("run_id")
    ).agg(
        F.min("o_orderdate").alias("start_time"),
        F.count("*").alias("input_rows"),
        F.when(F.sum("o_custkey") % 3 == 0, "failed").otherwise("success").alias("status"),
    )
