"""Versioned storage of bronze and gold on plain Parquet.

Each run writes new folders and never touches old ones:

    bronze/<source>/run=<id>/period=<yyyy-MM>/
    gold/<table>/run=<id>/period=<yyyy-MM>/      tables kept per source period
    reports/run=<id>/<table>/{parquet,csv}/      one generation of the marts
    commits/<sequence>-<id>/                     what a run published
    checkpoints/<sequence>-<id>/                 everything that is live after it

A commit lists the folders of every (source, period) that its run changed. It
is one file and counts once its folder is complete, so a new generation appears
at once or not at all, a period can be replaced by nothing, and readers open
exactly the live folders. Every `CHECKPOINT_EVERY`-th commit is followed by a
checkpoint; readers replay the last checkpoint and the commits behind it.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.plans import commits as log
from meterline.plans.tables import local_rows, together
from meterline.schemas import FACT, FLAGS, TRIPS, WEATHER, ZONES
from meterline.session import remove
from meterline.sources.digests import file_digests, tree_fingerprint

ENTRY = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("raw_sha256", T.StringType()),
    T.StructField("bronze_run", T.StringType()),
    T.StructField("bronze_fingerprint", T.StringType()),
    T.StructField("gold_run", T.StringType()),
    T.StructField("bronze_rows", T.LongType()),
    T.StructField("fact_rows", T.LongType()),
])
COMMITS = T.StructType([
    T.StructField("sequence", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("logic_version", T.StringType()),
    T.StructField("entries", T.ArrayType(ENTRY)),
])

TOTAL = T.DecimalType(38, 2)
ZONE_DAY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("zone_key", T.LongType()),
    T.StructField("trip_count", T.LongType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trips_with_passenger_count", T.LongType()),
    T.StructField("average_trip_distance", T.DoubleType()),
    T.StructField("average_trip_duration", T.DoubleType()),
    T.StructField("fare_amount", TOTAL),
    T.StructField("total_amount", TOTAL),
    T.StructField("suspicious_trip_count", T.LongType()),
])
QUALITY = T.StructType(
    [
        T.StructField("source_period", T.StringType()),
        T.StructField("quality_status", T.StringType()),
        T.StructField("trip_count", T.LongType()),
    ]
    + [T.StructField(flag, T.LongType()) for flag in FLAGS]
)
# What is stored for the quality mart: its columns and one more count for the checks.
STATUS_COUNTS = T.StructType(
    [*QUALITY.fields, T.StructField("missing_trip_id", T.LongType())])
FINDINGS = T.StructType([
    T.StructField("source_period", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("violations", T.LongType()),
])

BRONZE_SCHEMAS = {"trips": TRIPS, "zones": ZONES, "weather": WEATHER}
GOLD_SCHEMAS = {
    "fct_trips": FACT, "mart_zone_daily": ZONE_DAY, "mart_quality": QUALITY,
    "trip_findings": FINDINGS,
}
EMPTY = "empty"
FOLDERS = T.StructType([T.StructField("folder", T.StringType())])
CHECKPOINT_EVERY = 16
ROW_GROUP_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Commit:
    """Live folders as of one publication; one entry per (source, period)."""

    sequence: int
    run_id: str | None
    logic_version: str | None
    entries: dict[tuple[str, str], dict]

    def periods(self) -> list[str]:
        return sorted(period for source, period in self.entries if source == "trips")


NOTHING = Commit(0, None, None, {})


class Store:
    def __init__(self, spark: SparkSession, root: str, checkpoint_every: int = CHECKPOINT_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.checkpoint_every = checkpoint_every

    # --- folders -----------------------------------------------------------------------

    def bronze_folder(self, source: str, run_id: str, period: str) -> str:
        return f"{self.root}/bronze/{source}/run={run_id}/period={period}"

    def gold_folder(self, table: str, run_id: str, period: str) -> str:
        return f"{self.root}/gold/{table}/run={run_id}/period={period}"

    def report_folder(self, run_id: str, table: str, kind: str) -> str:
        return f"{self.root}/reports/run={run_id}/{table}/{kind}"

    def _read(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option(
            "recursiveFileLookup", "true").parquet(*folders)

    # --- bronze ------------------------------------------------------------------------

    def write_bronze(self, source: str, run_id: str, rows: DataFrame, rebalance: bool = False) -> None:
        """`rows` carry a `period` column, which names the folder.

        Row groups are small enough that a file of any size splits well.
        """
        self._by_period(rows, rebalance).write.option("compression", "zstd").option(
            "parquet.block.size", ROW_GROUP_BYTES
        ).partitionBy("period").parquet(f"{self.root}/bronze/{source}/run={run_id}")

    @staticmethod
    def _by_period(rows: DataFrame, rebalance: bool) -> DataFrame:
        """With `rebalance`, rows dealt anew by period and measured size.

        Spark merges small periods into one task and splits a period beyond its
        advisory partition size over several, so a period gets about as many
        files as its bytes ask for. Rows whose tasks already hold large pieces
        of few periods, such as a scan of large files, need no such shuffle.
        """
        return rows.hint("rebalance", F.col("period")) if rebalance else rows

    def read_bronze(self, source: str, entries: list[dict]) -> DataFrame:
        """Columns are matched by name; folder names never become columns."""
        return self._read(BRONZE_SCHEMAS[source], [
            self.bronze_folder(source, e["bronze_run"], e["period"])
            for e in entries if e["bronze_rows"] != 0])

    def fingerprints(self, folders: dict[tuple[str, str], str]) -> dict[tuple[str, str], str]:
        """Fingerprint per (source, period) of the bronze folders that exist."""
        if not folders:
            return {}
        paths = list(folders.values())
        files = file_digests(self.spark, paths, recursive=True)
        found = tree_fingerprint(
            files.where(F.col("path").endswith(".parquet")),
            F.regexp_extract("path", r"/bronze/(\w+)/run=", 1).alias("source"),
            F.regexp_extract("path", r"/period=([^/]+)/", 1).alias("period"))
        return {(r["source"], r["period"]): r["fingerprint"] for r in found.collect()}

    def missing(self, folders: list[str]) -> list[str]:
        """Those of `folders` that are gone or hold no data file; lists names, reads no data."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()

        def lost(folder: str) -> bool:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            system = path.getFileSystem(conf)
            return not system.exists(path) or not any(
                f.isFile() and f.getPath().getName().startswith("part-") for f in system.listStatus(path))
        return [f for f, gone in zip(folders, together(*[lambda f=f: lost(f) for f in folders])) if gone]

    # --- gold --------------------------------------------------------------------------

    def write_gold(self, table: str, run_id: str, rows: DataFrame, rebalance: bool = True) -> None:
        """`rows` carry a `period` column; schema-stable columns stay in the files.

        Trip ids never repeat, so no dictionary is tried for them.
        """
        self._by_period(rows, rebalance).write.option("compression", "zstd").option(
            "parquet.enable.dictionary#trip_id", "false"
        ).option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("period").parquet(f"{self.root}/gold/{table}/run={run_id}")

    def read_gold(
        self, table: str, entries: list[dict], schema: T.StructType | None = None
    ) -> DataFrame:
        """Only live folders are listed, so periods are pruned by path."""
        rows = "fact_rows" if table in ("fct_trips", "mart_zone_daily") else "bronze_rows"
        return self._read(schema or GOLD_SCHEMAS[table], [
            self.gold_folder(table, e["gold_run"], e["period"]) for e in entries if e[rows]])

    # --- commits -----------------------------------------------------------------------

    def _names(self, kind: str) -> list[tuple[int, str]]:
        """(sequence, run id) of the complete folders of commits or checkpoints, in order; lists names only."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/*/_SUCCESS")
        found = pattern.getFileSystem(conf).globStatus(pattern) or []
        names = [f.getPath().getParent().getName().split("-", 1) for f in found]
        return sorted((int(sequence), run_id) for sequence, run_id in names)

    def _folder(self, kind: str, sequence: int, run_id: str) -> str:
        return f"{self.root}/{kind}/{sequence:012d}-{run_id}"

    def _write_commit(self, kind: str, commit: Commit) -> None:
        row = {
            "sequence": commit.sequence, "run_id": commit.run_id,
            "logic_version": commit.logic_version, "entries": list(commit.entries.values())}
        local_rows(self.spark, [row], COMMITS).coalesce(1).write.mode("overwrite").parquet(
            self._folder(kind, commit.sequence, commit.run_id))

    def replay(self, upto: int | None = None) -> Commit:
        """The generation `upto` (the last one by default), from one checkpoint and the commits behind it."""
        commits = [c for c in self._names("commits") if upto is None or c[0] <= upto]
        if not commits:
            return NOTHING
        start = max((c for c in self._names("checkpoints") if c[0] <= commits[-1][0]), default=None)
        folders = [self._folder("checkpoints", *start)] if start else []
        folders += [self._folder("commits", *c) for c in commits if not start or c[0] > start[0]]
        rows = self.spark.read.schema(COMMITS).parquet(*folders).collect()
        entries = {}
        for row in sorted(rows, key=lambda r: r["sequence"]):
            entries |= {(e["source"], e["period"]): e.asDict() for e in row["entries"]}
        last = max(rows, key=lambda r: r["sequence"])
        return Commit(last["sequence"], last["run_id"], last["logic_version"], entries)

    def latest(self) -> Commit:
        """The last publication; its entries number sources x months, not rows."""
        return self.replay()

    def publish(self, commit: Commit, before: Commit | None = None) -> None:
        """Appends the entries that `commit` changed since `before` (the last publication, if not given)."""
        before = self.latest() if before is None else before
        changed = {k: e for k, e in commit.entries.items() if before.entries.get(k) != e}
        self._write_commit("commits", Commit(commit.sequence, commit.run_id, commit.logic_version, changed))
        if commit.sequence % self.checkpoint_every == 0:
            self._write_commit("checkpoints", commit)

    def versions(self) -> DataFrame:
        """(sequence, entry columns): every version of every (source, period) that the log still holds."""
        starts = self._names("checkpoints")[:1]  # what came before it is kept in it only
        commits = self._names("commits")
        folders = [self._folder("checkpoints", *c) for c in starts if commits and c[0] <= commits[0][0]]
        folders += [self._folder("commits", *c) for c in commits]
        if not folders:
            return self.spark.createDataFrame([], T.StructType([COMMITS["sequence"], *ENTRY.fields]))
        rows = self.spark.read.schema(COMMITS).parquet(*folders).select("sequence", F.inline("entries"))
        return rows.groupBy(*ENTRY.fieldNames()).agg(F.min("sequence").alias("sequence")).select(
            "sequence", *ENTRY.fieldNames())

    def vacuum(self, keep: int, dry_run: bool = False) -> list[str]:
        """Removes what none of the last `keep` generations consists of; returns the folders.

        Folders of failed runs go as well, so no run may be under way. The log
        is cut at the first generation that stays, behind a checkpoint of it;
        earlier ones can no longer be opened.
        """
        commits = self._names("commits")
        if keep < 1 or not commits:
            raise ValueError("at least one published generation has to stay")
        kept = commits[-keep:]
        first = kept[0]
        entries = log.live(self.versions(), first[0])
        root = F.lit(self.root)
        bronze = F.concat(root, F.lit("/bronze/"), "source", F.lit("/run="), "bronze_run", F.lit("/period="), "period")
        gold = [F.concat(root, F.lit(f"/gold/{t}/run="), "gold_run", F.lit("/period="), "period") for t in GOLD_SCHEMAS]
        used = entries.select(F.explode(F.array(bronze, *gold)).alias("folder")).unionByName(local_rows(
            self.spark, [(f"{self.root}/reports/run={run_id}",) for _, run_id in kept], FOLDERS))
        listed = [p for pattern in ("bronze/*/run=*/period=*", "gold/*/run=*/period=*", "reports/run=*")
                  for p in self._glob(pattern)]
        gone = sorted(r["folder"] for r in log.unreferenced(
            local_rows(self.spark, [(p,) for p in listed], FOLDERS), used).collect())
        if dry_run:
            return gone
        if first not in self._names("checkpoints"):
            self._write_commit("checkpoints", self.replay(first[0]))
        old = [self._folder(kind, *c) for kind in ("commits", "checkpoints") for c in self._names(kind) if c < first]
        together(*[lambda f=f: remove(self.spark, f) for f in [*old, *gone]])
        return gone

    def _glob(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return [f.getPath().toString() for f in found]

    # --- published data ------------------------------------------------------------------

    def generation(self, run_id: str) -> Commit:
        """The publication of an earlier run that no vacuum has removed."""
        found = [sequence for sequence, name in self._names("commits") if name == run_id]
        if not found:
            raise LookupError(f"run {run_id} has published nothing that is still kept")
        return self.replay(found[0])

    def table(self, name: str, run_id: str | None = None) -> DataFrame:
        """A table of a published generation (the last one by default): the trip fact or an exported mart."""
        commit = self.latest() if run_id is None else self.generation(run_id)
        if commit.run_id is None:
            raise LookupError("nothing has been published yet")
        if name == "fct_trips":
            return self.read_gold(
                name, [e for (source, _), e in commit.entries.items() if source == "trips"])
        return self.spark.read.parquet(self.report_folder(commit.run_id, name, "parquet"))
