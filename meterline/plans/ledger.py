"""Source ledger: an append-only table of registrations, queried as DataFrames."""
from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.plans.tables import append_rows, local_rows, read_rows
from meterline.session import remove, settle
from meterline.sources.contracts import ContractError, schema_fingerprint
from meterline.sources.digests import file_digests
from meterline.sources.files import qualified_all, scan_files
from meterline.sources.trips import checked_trip_files
from meterline.sources.weather import csv_columns

LEDGER = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("schema_fingerprint", T.StringType()),
    # Column list as registered, so that drift can be read back.
    T.StructField("schema_json", T.StringType()),
    # Files of one (source, period) registered together share their batch.
    T.StructField("batch", T.StringType()),
    T.StructField("registered_at", T.TimestampNTZType()),
])


# --- queries -------------------------------------------------------------------------------


def current(ledger: DataFrame) -> DataFrame:
    """Files of the latest batch of every (source, period); ties fall to the larger batch."""
    keys = ("source", "period")
    latest = ledger.groupBy(*keys).agg(F.max(F.struct("registered_at", "batch")).alias("latest"))
    latest = latest.select(*keys, F.col("latest.batch").alias("batch"),
                           F.col("latest.registered_at").alias("registered_at"))
    return ledger.join(latest, [*keys, "batch", "registered_at"], "left_semi").select(*ledger.columns)


def period_digests(current_rows: DataFrame) -> DataFrame:
    """(source, period, raw_sha256, row_count): one digest for all files of a period.

    A single file's own digest, else the digest of the sorted list.
    """
    listed = F.sort_array(F.collect_list("sha256"))
    return current_rows.groupBy("source", "period").agg(
        listed.alias("digests"), F.sum("row_count").alias("row_count")).select(
        "source", "period", F.when(F.size("digests") == 1, F.col("digests")[0]).otherwise(
            F.sha2(F.array_join("digests", ","), 256)).alias("raw_sha256"), "row_count")


def history(ledger: DataFrame) -> DataFrame:
    """First registration of every distinct (source, period, digest)."""
    rest = [n for n in ledger.columns if n not in ("source", "period", "sha256", "registered_at")]
    first = F.min(F.struct("registered_at", *rest)).alias("first")
    return ledger.groupBy("source", "period", "sha256").agg(first).select(
        *[n if n in ("source", "period", "sha256") else f"first.{n}" for n in ledger.columns])


def duplicate_bytes(ledger: DataFrame) -> DataFrame:
    """Digests that one source holds under more than one period."""
    return ledger.groupBy("source", "sha256").agg(
        F.countDistinct("period").alias("periods"),
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
    ).where("periods > 1")


def judged(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """`incoming` files with an `outcome` each, against the files `known` as current.

    In this order: named_twice (a path given more than once), no_digest,
    twice_in_period (its bytes are given more than once for its period),
    elsewhere (its bytes belong to another period of the source, which this
    registration does not replace), unchanged (its period's files are just the
    current ones) and added. Grouped counts and equi-joins only, so the work
    grows with the number of files and not with its square.
    """
    period = ["source", "period"]
    named = incoming.groupBy("path").agg((F.count("*") > 1).alias("twice"))
    bytes_ = incoming.where("sha256 is not null").groupBy(*period, "sha256").agg((F.count("*") > 1).alias("again"))
    clash = duplicate_bytes(
        known.join(incoming.select(*period).distinct(), period, "left_anti")
        .select(*period, "sha256").unionByName(incoming.where("sha256 is not null").select(*period, "sha256"))
    ).select("source", "sha256", "first_period", "last_period")
    # The sets are equal if as many files match as either side has.
    files = [*period, "path", "sha256"]
    both = known.select(*files, F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        incoming.select(*files, F.lit(0).alias("old"), F.lit(1).alias("new")))
    same = both.groupBy(*files).agg(F.sum("old").alias("old"), F.sum("new").alias("new")).groupBy(*period).agg(
        F.bool_and(F.col("old") == F.col("new")).alias("same"))
    outcome = F.when(F.col("twice"), "named_twice").when(F.col("sha256").isNull(), "no_digest").when(
        F.col("again"), "twice_in_period").when(F.col("first_period").isNotNull(), "elsewhere").when(
        F.col("same"), "unchanged").otherwise("added")
    return incoming.join(named, "path").join(bytes_, [*period, "sha256"], "left").join(
        clash, ["source", "sha256"], "left").join(same, period).select(
        *incoming.columns, "first_period", "last_period", outcome.alias("outcome"))


def broken_files(current_rows: DataFrame, digests: DataFrame) -> DataFrame:
    """Ledger rows whose file is gone or no longer has the registered bytes."""
    found = digests.select(F.col("path").alias("found_path"), F.col("sha256").alias("found_sha256"))
    return current_rows.join(found, F.col("path") == F.col("found_path"), "left").where(
        ~F.col("sha256").eqNullSafe(F.col("found_sha256"))).select(
        "source", "period", "path", "sha256", "found_sha256")


#: What is said of a file that cannot be registered, by outcome, in the order of the rules.
REFUSALS = {
    "named_twice": "one registration names {path} more than once",
    "no_digest": "no digest for {path}; it cannot be registered",
    "twice_in_period": "two files with duplicate source bytes for {source}/{period}",
    "elsewhere": "{source} of {first_period} and {last_period} are duplicate source bytes",
}


# --- the stored ledger -----------------------------------------------------------------------


class Ledger:
    """The ledger table under a data root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/ledger"

    def rows(self) -> DataFrame:
        return read_rows(self.spark, self.path, LEDGER)

    def current(self) -> DataFrame:
        return current(self.rows())

    def history(self) -> DataFrame:
        return history(self.rows())

    def digests(self, paths: list[str]) -> DataFrame:
        return file_digests(self.spark, paths)

    def register(self, files: list[tuple[str, str, str]]) -> int:
        """Register landed files, given as (source, period, path).

        All files given for one (source, period) replace its earlier ones
        together. Paths may be relative or spelt in any way; they are kept in
        their full form. Trip files are held to their contract first. Nothing
        is recorded unless every file passes; registering the current files of
        a period again adds nothing. Returns the number of rows added.
        """
        if not files:
            return 0
        names = qualified_all(self.spark, [path for _, _, path in files])
        files = [(source, period, path) for (source, period, _), path in zip(files, names)]
        twice = [path for path, n in Counter(names).items() if n > 1]
        if twice:
            raise ContractError(f"one registration names {min(twice)} more than once")
        described = self._described(files)
        now, batch = datetime.now(timezone.utc).replace(tzinfo=None), uuid.uuid4().hex
        given = local_rows(self.spark, [
            (source, period, path, None, None, described[path][1], schema_fingerprint(described[path][0]),
             described[path][0].json(), batch, now) for source, period, path in files], LEDGER)
        digests = self.digests(names).select(F.col("path").alias("found"), "length", "sha256")
        scratch = f"{self.path}-scratch/{batch}"
        try:
            # Settled, as every rule looks at the digests; each file's bytes are read once.
            incoming = settle(given.drop("length", "sha256").join(
                digests, F.col("path") == F.col("found"), "left").select(*LEDGER.fieldNames()), "incoming", scratch)
            return self._record(judged(self.current(), incoming))
        finally:
            remove(self.spark, scratch)

    def _record(self, files: DataFrame) -> int:
        """Appends what is new, unless a file is refused."""
        counts = {r["outcome"]: r["n"] for r in files.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
        refused = [o for o in REFUSALS if o in counts]
        if refused:
            row = files.where(F.col("outcome") == refused[0]).orderBy("source", "period", "path").first()
            raise ContractError(REFUSALS[refused[0]].format(**row.asDict()), row["source"], row["period"])
        if counts.get("added"):
            append_rows(files.where("outcome = 'added'").select(*LEDGER.fieldNames()), self.path)
        return counts.get("added", 0)

    def _described(self, files) -> dict[str, tuple[T.StructType, int]]:
        """(schema, row count) per path; rows of CSV files are counted as parsed."""
        out = checked_trip_files(self.spark, [path for source, _, path in files if source == "trips"])
        texts = [path for source, _, path in files if source != "trips"]
        headers = {path: csv_columns(self.spark, path) for path in texts}
        groups = defaultdict(list)
        for path, schema in headers.items():
            groups[schema.json()].append(path)
        for paths in groups.values():
            def read(names, schema=headers[paths[0]]):
                return self.spark.read.schema(schema).csv(names, header=True, multiLine=True).select(
                    *schema.fieldNames()[:1], F.col("_metadata.file_path").alias("file_uri"))
            counted = scan_files(self.spark, [(p, p, "") for p in paths], read).groupBy("file_period").count()
            counts = {r["file_period"]: r["count"] for r in counted.collect()}
            out |= {path: (headers[path], counts.get(path, 0)) for path in paths}
        return out

    def verify(self, current_rows: DataFrame, paths: list[str]) -> None:
        """Raise unless every registered file still has its registered bytes."""
        from pyspark.errors import AnalysisException

        try:
            digests = self.digests(paths)
        except AnalysisException as missing:
            raise ContractError(f"raw files fail their integrity test: {missing}") from missing
        broken = broken_files(current_rows, digests).orderBy("source", "period").first()
        if broken:
            raise ContractError(
                f"{broken['source']} of {broken['period']} fail their integrity test: {broken['path']} "
                "is not as registered", broken["source"], broken["period"])
