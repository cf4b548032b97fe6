"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard similarity.

Two permutations give all signature coordinates: the first scatters shingle
hashes over 32 bits, the second is reused for every coordinate after a
circular shift of its input by one more place. Both are bijections of the
32-bit integers, computed instead of stored.

Cost and completeness: a pair at the threshold shares none of the 64 bands of 8
coordinates with probability (1 - 0.8^8)^64 = 8e-6, a pair at 0.9 with 1e-16.
Documents that share a band, directly or through others, form a cluster; within
a cluster every pair is compared on full sets, but for pairs that verified
links tie together already: in clusters of more than one block each document is
first compared with the hub it shares most bands with, and then only blocks
of different components meet. Each pair of blocks is one bounded task that
returns a spanning forest, never the pairs themselves.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import connected, written

BANDS, ROWS = 64, 8
BLOCK_SHINGLES, BLOCK_DOCS = 400_000, 400
_P = np.uint64(0x9E3779B97F4A7C15)
_COLUMNS = 4096


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case for A-Z alone, split at the six ASCII blanks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = max(1, len(words) - width + 1)
    x = np.full(n, np.uint64(min(width, len(words))))
    for k in range(min(width, len(words))):
        x = (x ^ h[k:k + n]) * _P
        x ^= x >> np.uint64(29)
    return np.unique(x)


def scattered(hashes: np.ndarray) -> np.ndarray:
    """The first permutation, after folding 64-bit hashes to 32 bits."""
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """Coordinate k is the minimum of the second permutation over inputs shifted by k."""
    x = scattered(hashes)
    out = np.empty(size, np.uint32)
    step = max(1, min(size, 65536 // max(1, len(x))))
    for k in range(0, size, step):
        shifts = np.arange(k, min(size, k + step), dtype=np.uint32)[:, None]
        y = x[None, :] - shifts
        y *= np.uint32(0x9E3779B1)
        z = y >> np.uint32(15)
        y ^= z
        y *= np.uint32(0x85EBCA77)
        y.min(axis=1, out=out[k:k + step])
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, which also tells the bands apart."""
    s = sig[:bands * rows].reshape(bands, rows).astype(np.uint64)
    x = (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _P
    for k in range(rows):
        x = (x ^ s[:, k]) * _P
        x ^= x >> np.uint64(31)
    return x.view(np.int64)


def _sketch(width: int, bands: int, rows: int):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, len(batch), 256):
                sizes, keys, sketches = [], [], []
                for text in texts[start:start + 256]:
                    words = words_of(text.as_py())
                    hashes = shingle_hashes(words, width)
                    sizes.append(len(hashes))
                    keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                    sketches.append(band_keys(signature(hashes, bands * rows), bands, rows) if words else None)
                yield pa.RecordBatch.from_arrays(
                    [ids[start:start + 256], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(sketches, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "key", "bands"])
    return run


def _forest(links: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id of its tree) for the indexes joined by `links`."""
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in links:
        a, b = find(int(a)), find(int(b))
        if a != b:
            if ids[b] < ids[a]:
                a, b = b, a
            root[b] = a
    return [(int(ids[i]), int(ids[find(i)])) for i in list(root) if find(i) != i]


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """Index pairs with 100 * |A and B| >= percent * |A or B|, a strip of `left` at a time.

    Intersections are counted as products of incidence matrices over the
    hashes that occur more than once, some thousand columns at a time.
    """
    sets = left + right
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, index, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[index] > 1
    owner, index = owner[shared], index[shared]
    rank = np.cumsum(counts > 1) - 1
    column = rank[index]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.int64)
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, _COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + _COLUMNS])
        m = np.zeros((len(sets), min(_COLUMNS, total - start)), np.float32)
        m[owner[lo:hi], column[lo:hi] - start] = 1
        common += (m[:len(left)] @ m[len(left):].T).astype(np.int64)  # exact: a strip counts to _COLUMNS at most
    union = sizes[:len(left), None] + sizes[None, len(left):] - common
    for a in range(len(left)):
        hits = np.flatnonzero((common[a] > 0) & (100 * common[a] >= percent * union[a]))
        if len(hits):
            yield np.column_stack([np.full(len(hits), a), hits])


def _verify(width: int, percent: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        _, first, second = key
        sets = [shingle_hashes(words_of(t), width) for t in group["text"]]
        ids, blocks = group["doc_id"].to_numpy(), group["block"].to_numpy()
        a = np.flatnonzero(blocks == first)
        b = np.flatnonzero(blocks == second)
        links = [np.column_stack([a[x[:, 0]], b[x[:, 1]]])
                 for x in similar_pairs([sets[i] for i in a], [sets[i] for i in b], percent)] \
            if len(a) and len(b) else []
        pairs = np.concatenate(links) if links else np.empty((0, 2), int)
        return pd.DataFrame(_forest(pairs[pairs[:, 0] != pairs[:, 1]], ids), columns=["u", "v"], dtype="int64")
    return run


def _n_blocks() -> Column:
    return F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_DOCS)).cast("int")


def _place(n: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")


def _compared(tasks: DataFrame, base: DataFrame, width: int, percent: int) -> DataFrame:
    """Spanning forests (u, v) of the links between the blocks `first` and `second` of each task.

    Rows of `tasks` are (task, first, second, node, block); texts come from `base`.
    """
    # Both sides grow with the corpus, so neither is ever copied to every executor, small or large.
    return base.join(tasks.hint("merge"), base["doc_id"] == tasks["node"]).select(
        "task", "first", "second", "doc_id", "text", "block").groupBy("task", "first", "second").applyInPandas(
        _verify(width, percent), "u long, v long")


def _starred(members: DataFrame, near: DataFrame, base: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, root) of components verified between documents of clusters beyond one block and their hubs."""
    large = members.groupBy("root").agg(_n_blocks().alias("n_blocks")).where("n_blocks > 1").select("root")
    hubs = near.groupBy("u").agg(F.max_by("v", F.struct(F.col("n"), -F.col("v"))).alias("task"))
    rays = written(members.join(large, "root").join(hubs, F.col("node") == F.col("u")).select(
        "task", "node", "n_shingles"), "rays")
    sizes = rays.groupBy("task").agg(_n_blocks().alias("n_blocks"))
    outer = rays.join(sizes, "task").select(
        "task", F.lit(0).alias("first"), (_place("n_blocks") + 1).alias("second"), "node",
        (_place("n_blocks") + 1).alias("block"))
    inner = outer.select("task", "first", "second").distinct().select(
        "task", "first", "second", F.col("task").alias("node"), F.lit(0).alias("block"))
    return connected(_compared(outer.unionByName(inner), base, width, percent), "stars")


def _unresolved(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Tasks for all pairs of a cluster that `stars` does not tie together already.

    A component of at least one block has blocks of its own, the others of a
    cluster share blocks. Blocks of the same component do not meet.
    """
    known = stars.select(F.col("node").alias("_node"), F.col("root").alias("_component"))
    parted = members.join(known, F.col("node") == F.col("_node"), "left").select(
        "root", "node", "n_shingles", F.coalesce("_component", "node").alias("component"))
    own = parted.groupBy("root", "component").agg(F.count("*").alias("n_docs"), _n_blocks().alias("n_own"),
                                                  F.sum("n_shingles").alias("n_shingles"))
    large = (F.col("n_docs") >= BLOCK_DOCS) | (F.col("n_shingles") >= BLOCK_SHINGLES)
    shared = own.where(~large).groupBy("root").agg(F.greatest(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.sum("n_docs") / BLOCK_DOCS)).cast("int").alias("n_shared"))
    sizes = own.select("root", "component", "n_own", large.alias("large")).join(shared, "root", "left")
    placed = written(parted.join(sizes, ["root", "component"]).select(
        "root", "node", F.when(F.col("large"), F.col("component")).alias("owner"),
        F.when(F.col("large"), F.concat_ws(":", "component", _place("n_own"))).otherwise(
            F.concat_ws(":", F.lit("shared"), _place("n_shared"))).alias("block")), "placed")
    blocks = placed.select("root", "owner", "block").distinct()
    others = blocks.select("root", F.col("owner").alias("other_owner"), F.col("block").alias("other"))
    pairs = blocks.join(others, "root").where("not coalesce(owner = other_owner, false)").select(
        F.col("root").alias("task"), F.col("block").alias("_block"), "other")
    return placed.join(pairs, (F.col("root") == F.col("task")) & (F.col("block") == F.col("_block"))).select(
        "task", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "node", "block")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs` (doc_id, text).

    Documents are linked if 100 * |A and B| >= percent * |A or B| on their sets
    of `width`-word shingles. A component's id is its smallest doc_id, and that
    document is kept. Exact copies (same words) are settled by their digest;
    only one of them is compared. Defined edge cases: a null, empty or blank
    text has no shingles and is linked with nothing; a text of fewer words than
    `width` is a single shingle; a row without doc_id is linked with nothing,
    has a null component and is kept; rows that repeat a doc_id share its
    component if their texts agree. Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(base.mapInArrow(
        _sketch(width, bands, rows), "doc_id long, n_shingles long, key binary, bands array<long>"), "sketch")
    named = sketches.where("key is not null and doc_id is not null")
    classes = written(named.groupBy("key").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r")).select(
        "key", F.col("r.doc_id").alias("doc_id"), F.col("r.n_shingles").alias("n_shingles"),
        F.col("r.bands").alias("bands")), "classes")
    bucketed = classes.select("doc_id", F.explode("bands").alias("bucket"))
    hubs = bucketed.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    near = written(bucketed.join(hubs, "bucket").where("doc_id <> hub").groupBy(
        F.col("doc_id").alias("u"), F.col("hub").alias("v")).agg(F.count("*").alias("n")), "near")
    clusters = connected(near, "clusters")
    members = written(clusters.union(clusters.select(F.col("root"), F.col("root")).distinct()).join(
        classes.select(F.col("doc_id").alias("node"), "n_shingles"), "node").groupBy("node").agg(
        F.min("root").alias("root"), F.max("n_shingles").alias("n_shingles")), "members")
    stars = _starred(members, near, base, width, percent)
    links = _compared(_unresolved(members, stars), base, width, percent)
    roots = connected(links.union(stars.select(F.col("node").alias("u"), F.col("root").alias("v"))), "links")
    component = classes.select("key", "doc_id").join(
        roots, F.col("doc_id") == F.col("node"), "left").select(
        "key", F.coalesce("root", "doc_id").alias("component_id"))
    linked = named.select("doc_id", "n_shingles", "key").join(component, "key").drop("key")
    alone = sketches.where("key is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay: one of each group of near duplicates, the one with the smallest doc_id.

    Rows are judged by their texts, not by their ids: of rows that repeat a
    doc_id only true copies go, and a row without doc_id goes if it is a copy of
    another row. Rows without words resemble nothing and stay.
    """
    rows = written(docs.withColumn("__op_row", F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows.select(F.col("__op_row").alias("doc_id"), "text"), width, percent).select(
        F.col("doc_id").alias("__op_node"), F.col("component_id").alias("__op_group"))
    named = written(rows.select("__op_row", "doc_id").join(groups, F.col("__op_row") == F.col("__op_node")).select(
        F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                 F.col("__op_row").alias("row")).alias("place"), "__op_group"), "named")
    first = named.groupBy("__op_group").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = named.join(first, "__op_group").where("place.row <> first.row").select(F.col("place.row").alias("__op_gone"))
    return rows.join(gone, F.col("__op_row") == F.col("__op_gone"), "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])
