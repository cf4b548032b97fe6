"""File names as Spark spells them, and the scan of many files of one schema."""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.plans.tables import local_rows

#: Files of one scan; more of them are read by further scans, so that the list
#: of names sent to every executor stays small.
SCAN_FILES = 10_000

_NAMED = T.StructType([
    T.StructField("file_uri", T.StringType()),
    T.StructField("file_period", T.StringType()),
    T.StructField("file_sha256", T.StringType()),
])


def qualified(spark: SparkSession, path: str) -> str:
    """The one full spelling of a path: scheme, authority, no relative part, no double slash."""
    # Two leading slashes would name an authority.
    path = "/" + path.lstrip("/") if path.startswith("/") else path
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(file).toString()


def qualified_all(spark: SparkSession, paths: list[str]) -> list[str]:
    """`qualified` for many paths; each folder is asked for once."""
    folders: dict[str, str] = {}
    out = []
    for path in paths:
        folder, _, name = path.rpartition("/")
        if not folder or not name or name in (".", ".."):
            out.append(qualified(spark, path))
            continue
        if folder not in folders:
            folders[folder] = qualified(spark, f"{folder}/x")[:-1]
        out.append(folders[folder] + name)
    return out


def _uri(spark: SparkSession, path: str) -> str:
    text = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()
    return "file:/" + text.removeprefix("file:").lstrip("/") if text.startswith("file:/") else text


def scan_files(
    spark: SparkSession, files: Iterable[tuple[str, str, str]],
    read: Callable[[list[str]], DataFrame], chunk: int = SCAN_FILES,
) -> DataFrame:
    """Rows of all files, given as (qualified path, period, digest), with `file_period` and `file_sha256`.

    `read` opens a list of paths and selects `_metadata.file_path` as
    `file_uri`. At most `chunk` names, a few megabytes, are broadcast at once.
    """
    files, out = list(files), None
    for start in range(0, len(files), chunk):
        part = files[start:start + chunk]
        names = local_rows(spark, [(_uri(spark, p), period, digest) for p, period, digest in part], _NAMED)
        rows = read([p for p, _, _ in part]).withColumn("file_uri", F.regexp_replace("file_uri", "^file:/+", "file:/"))
        rows = rows.join(F.broadcast(names), "file_uri").drop("file_uri")
        out = rows if out is None else out.unionByName(rows)
    return out
