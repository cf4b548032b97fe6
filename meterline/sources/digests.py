"""Tree digests of files of any size, and of binary columns.

A content is cut into leaves of a fixed size; the last one may be shorter, and
an empty content is one empty leaf. A leaf's digest is the SHA-256 of its
bytes. As long as a content has more than one node, every run of `FAN_OUT`
consecutive nodes becomes one node: the SHA-256 of their digests, as lower-case
hex, one after the other. So the digest of a content of one leaf is its plain
SHA-256, and leaves can be read by different tasks.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.sources.files import qualified

# They are part of every digest of a content beyond one leaf.
LEAF_BYTES = 64 * 1024 * 1024
FAN_OUT = 1024


def leaf_count(length: Column, leaf_bytes: int) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(length / F.lit(leaf_bytes)))


def leaves(rows: DataFrame, keys: list[str], content: Column, leaf_bytes: int) -> DataFrame:
    """(*keys, leaf, nodes, sha256): the leaves of a binary column; a null content is a leaf without digest."""
    held = rows.select(*keys, content.alias("bytes"), leaf_count(F.octet_length(content), leaf_bytes).alias("nodes"))
    each = F.explode_outer(F.sequence(F.lit(0).cast("long"), F.col("nodes") - 1))
    piece = F.substring("bytes", (F.col("leaf") * leaf_bytes + 1).cast("int"), F.lit(leaf_bytes))
    return held.select("*", each.alias("leaf")).select(
        *keys, "leaf", "nodes", F.sha2(piece, 256).alias("sha256"))


def roots(nodes: DataFrame, keys: list[str], most: int, fan_out: int = FAN_OUT) -> DataFrame:
    """(*keys, sha256) from leaves (*keys, leaf, nodes, sha256) of contents with at most `most` leaves each.

    Every level gathers at most `fan_out` digests in a group, so a content of
    any size is joined up in small groups. A content's only node stays.
    """
    while most > 1:
        level = nodes.groupBy(*keys, "nodes", F.floor(F.col("leaf") / fan_out).alias("leaf")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("leaf").alias("place"), "sha256"))).alias("below"))
        joined = F.sha2(F.array_join(F.transform("below", lambda n: n["sha256"]), "").cast("binary"), 256)
        nodes = level.select(
            *keys, "leaf", F.ceil(F.col("nodes") / fan_out).alias("nodes"),
            F.when(F.col("nodes") > 1, joined).otherwise(F.col("below")[0]["sha256"]).alias("sha256"))
        most = -(-most // fan_out)
    return nodes.select(*keys, "sha256")


def content_digests(rows: DataFrame, key: str, content: Column, leaf_bytes: int = LEAF_BYTES,
                    fan_out: int = FAN_OUT) -> DataFrame:
    """(key, length, leaves, sha256) of every row's binary content; a null content has nulls.

    `key` tells the rows apart.
    """
    length = F.octet_length(content)
    longest = rows.agg(F.max(length).alias("n")).first()["n"] or 0
    digests = roots(leaves(rows, [key], content, leaf_bytes), [key], -(-longest // leaf_bytes), fan_out)
    sizes = rows.select(F.col(key).alias("of"), length.cast("long").alias("length"),
                        F.when(length.isNotNull(), leaf_count(length, leaf_bytes)).alias("leaves"))
    return digests.join(sizes, F.col(key).eqNullSafe(F.col("of"))).select(key, "length", "leaves", "sha256")


# --- files ------------------------------------------------------------------------------------


def _range_digests(leaf_bytes: int):
    """Reads one leaf after the other, a few megabytes at a time, through Arrow's file systems.

    Everything the tasks need is inside this function, so workers need not be able to import this package.
    """
    def opened(path: str):
        from pyarrow import fs
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(path)

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        for batch in batches:
            digests = []
            for path, length, leaf in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                system, name = opened(path)
                left = min(leaf_bytes, length - leaf * leaf_bytes)
                digest = hashlib.sha256()
                with system.open_input_file(name) as source:
                    source.seek(leaf * leaf_bytes)
                    while left > 0:
                        part = source.read(min(left, 4 * 1024 * 1024))
                        if not part:
                            raise OSError(f"{path} is shorter than listed")
                        digest.update(part)
                        left -= len(part)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.string())], names=["path", "length", "leaf", "nodes", "sha256"])
    run.opened = opened
    return run


def arrow_reads(path: str) -> bool:
    """Whether Arrow has a file system for `path` (Spark knows more of them, such as viewfs)."""
    try:
        system, name = _range_digests(1).opened(path)
        system.get_file_info(name)
        return True
    except Exception:  # an unknown scheme, or one whose native library is not installed
        return False


def file_digests(spark: SparkSession, paths: str | list[str], recursive: bool = False,
                 leaf_bytes: int = LEAF_BYTES, ranges: bool | None = None) -> DataFrame:
    """(path, length, sha256) of every file under `paths`: the tree digest, which for a file of one leaf is its SHA-256.

    Empty files are not listed. Files of one leaf are read by the JVM. The
    leaves of larger files are read by tasks of their own, wherever Arrow has a
    file system for them (local, HDFS, S3, GCS, ABFS), so a file may have any
    size. On other file systems (`ranges` false) the JVM reads such files whole
    and cuts them; there Spark refuses files beyond 2 GiB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(paths)
    longest = files.agg(F.max("length").alias("n")).first()["n"] or 0  # lists, reads no content
    if longest <= leaf_bytes:
        return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
    small = files.where(F.col("length") <= leaf_bytes).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > leaf_bytes)
    keys = ["path", "length"]
    if ranges is None:
        first = paths if isinstance(paths, str) else paths[0]
        ranges = arrow_reads(qualified(spark, first))
    if ranges:
        each = large.select(*keys, leaf_count(F.col("length"), leaf_bytes).alias("nodes")).select(
            *keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("nodes") - 1)).alias("leaf"), "nodes")
        # An explicit number of tasks: the rows are tiny, what they stand for is not.
        each = each.repartition(4 * spark.sparkContext.defaultParallelism, "path", "leaf")
        cut = each.mapInArrow(_range_digests(leaf_bytes),
                              "path string, length long, leaf long, nodes long, sha256 string")
    else:
        cut = leaves(large, keys, F.col("content"), leaf_bytes)
    return small.unionByName(roots(cut, keys, -(-longest // leaf_bytes)).select("path", "length", "sha256"))


def tree_fingerprint(digests: DataFrame, *keys) -> DataFrame:
    """One order-independent text per key group for the files in it.

    Changes when a file is added, removed, renamed or altered; sums of hashes
    aggregate partially, so no list of files is ever gathered.
    """
    name = F.element_at(F.split("path", "/"), -1)
    parts = F.xxhash64(name, F.col("sha256")).cast("decimal(38,0)")
    return digests.groupBy(*keys).agg(
        F.concat_ws(
            ":", F.count("*").cast("string"), F.sum("length").cast("string"),
            F.sum(parts).cast("string"),
        ).alias("fingerprint")
    )
