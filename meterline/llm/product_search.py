"""Exact top-k search by inner product over norm-sorted, SVD-rotated vectors.

Candidates are dealt to blocks by descending length. A block's longest vector
bounds every product with it, so a query visits only the blocks whose bound
still reaches its threshold. Within a block, products are summed along the
singular directions of all vectors, the strongest first; by Cauchy-Schwarz the
rest of a product is at most the product of the two residual lengths. Pairs
that may still reach the threshold are evaluated exactly in integers.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import ship, written
from meterline.llm.vectors import component_bound, floors, lists, matrix, usable, widest

#: Bytes of integer components in a block of candidates, longest vectors whose products give the first thresholds, and
#: queries of one group: a task holds one block and streams one group of queries past it.
BLOCK_BYTES = 32 * 1024 * 1024
SEEDS = 1024
GROUP = 65_536
TILE, STRIP = 2_048, 256
_LOW = np.iinfo(np.int64).min


def _gram(width: int):
    """Sums of products of components over a task's rows: the upper triangle."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column(0), width).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])
    return run


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: the right singular vectors of all rows of `vectors` (x), the strongest first.

    Gathers width² sums, whatever the number of rows. Any orthogonal matrix
    keeps the search exact; this one makes the first partial sums large.
    """
    if not width:
        return np.zeros((0, 0))
    gram = np.zeros((width, width))
    sums = vectors.select("x").mapInArrow(_gram(width), "i int, j int, v double").groupBy("i", "j").agg(
        F.sum("v").alias("v"))
    for r in sums.toLocalIterator():
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["v"]
    return np.ascontiguousarray(np.linalg.eigh(gram)[1][:, ::-1])


def stages(width: int) -> list[int]:
    """Numbers of leading directions after which pairs are pruned."""
    return sorted({d for d in (width // 8, width // 4, width // 2) if d > 0})


class Rotated:
    """Integer vectors with their lengths, rotated components and residual lengths per stage."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.x = x
        self.floats = x.astype(np.float64)
        self.y = self.floats @ turn
        square = self.y**2
        self.length = np.sqrt((self.floats**2).sum(axis=1))
        self.rest = {d: np.sqrt(square[:, d:].sum(axis=1)) for d in stages(x.shape[1])}

    def __len__(self) -> int:
        return len(self.x)

    def part(self, rows) -> Rotated:
        out = object.__new__(Rotated)
        out.x, out.floats, out.y, out.length = self.x[rows], self.floats[rows], self.y[rows], self.length[rows]
        out.rest = {d: r[rows] for d, r in self.rest.items()}
        return out


def exact(q: Rotated, c: Rotated, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of the pairs (a of q, b of c).

    Doubles hold them exactly while the lengths' product stays below 2**53;
    longer vectors are multiplied as 64-bit integers.
    """
    out = np.empty(len(a), np.int64)
    for s in range(0, len(a), 1 << 16):
        i, j = a[s:s + (1 << 16)], b[s:s + (1 << 16)]
        if q.length.max(initial=0) * c.length.max(initial=0) < 2**52:
            out[s:s + (1 << 16)] = np.rint(np.einsum("ij,ij->i", q.floats[i], c.floats[j]))
        else:
            out[s:s + (1 << 16)] = np.einsum("ij,ij->i", q.x[i], c.x[j])
    return out


def reaching(q: Rotated, c: Rotated, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, product) of all pairs whose product is at least the query's threshold `least`."""
    slack = 1e-9 * q.length * c.length.max(initial=0) + 1e-6
    floor = least - slack
    a = b = None
    at, total = 0, None
    for d in stages(q.x.shape[1]):
        if a is None:
            total = q.y[:, :d] @ c.y[:, :d].T
            a, b = np.nonzero(total + q.rest[d][:, None] * c.rest[d][None, :] >= floor[:, None])
            total = total[a, b]
        elif len(a) * 4 > len(q) * len(c):  # little was pruned: one dense product is cheaper than many gathered ones
            total = (q.y[:, :d] @ c.y[:, :d].T)[a, b]
        else:
            total += np.einsum("ij,ij->i", q.y[a, at:d], c.y[b, at:d])
        at = d
        stay = total + q.rest[d][a] * c.rest[d][b] >= floor[a]
        a, b, total = a[stay], b[stay], total[stay]
    if a is None:
        a, b = (x.ravel() for x in np.indices((len(q), len(c))))
    score = exact(q, c, a, b)
    stay = score >= least[a]
    return a[stay], b[stay], score[stay]


class Best:
    """The `size` best (score, id) of every query so far; ties go to the smaller id, a null id comes last."""

    def __init__(self, least: np.ndarray, size: int):
        self.least, self.size = least.astype(np.float64), size
        self.query = np.empty(0, np.int64)
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def add(self, query, score, ids, null) -> None:
        if not len(query):
            return
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        ids, null = np.concatenate([self.id, ids]), np.concatenate([self.null, null])
        order = np.lexsort((ids, null, ~score, query))  # ~ turns the order of integers round without overflow
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[place < self.size]
        self.query, self.score, self.id, self.null = query[order], score[order], ids[order], null[order]
        last = place[place < self.size] == self.size - 1
        self.least[self.query[last]] = np.maximum(self.least[self.query[last]], self.score[last])


def best_of(q: Rotated, least: np.ndarray, c: Rotated, ids: np.ndarray, null: np.ndarray, size: int) -> Best:
    """Searches candidates `c`, sorted by descending length, for the queries `q`.

    The tiles grow up to TILE: products with the first few give the thresholds that prune the others.
    """
    best = Best(least, size)
    start = stop = 0
    while stop < len(c):
        start, stop = stop, stop + min(TILE, max(STRIP, stop))
        tile = c.part(slice(start, stop))
        longest = tile.length[0]
        slack = 1e-9 * q.length * longest + 1e-6
        live = np.flatnonzero(q.length * longest >= best.least - slack)
        if not len(live):
            break  # no later vector is longer
        for s in range(0, len(live), STRIP):
            rows = live[s:s + STRIP]
            a, b, score = reaching(q.part(rows), tile, best.least[rows])
            best.add(rows[a], score, ids[start + b], null[start + b])
    return best


def _thresholds(seeds: np.ndarray, bounds: np.ndarray, turn: np.ndarray, width: int, size: int):
    """Adds to each query the size-th best product among the seeds and the number of blocks that can reach it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Rotated(seeds, turn)
        none = np.zeros(len(c), bool)
        for batch in batches:
            for start in range(0, len(batch), STRIP):
                part = batch.slice(start, STRIP)
                q = Rotated(matrix(part.column(1), width), turn)
                best = best_of(q, np.full(len(q), float(_LOW)), c, np.arange(len(c)), none, size)
                slack = 1e-9 * q.length[:, None] * bounds[None, :] + 1e-6
                reach = (q.length[:, None] * bounds[None, :] >= best.least[:, None] - slack).sum(axis=1)
                least = np.where(best.least == float(_LOW), float(_LOW), best.least)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(least), pa.array(reach.astype(np.int32))],
                    names=["query", "x", "least", "reach"])
    return run


def _search(turn: np.ndarray, width: int, size: int):
    """Per block: gathers its candidates, which come first, then streams the queries past them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            keys = batch.column(0).to_numpy() * np.int64(2**31) + batch.column(1).to_numpy()
            kinds = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                run_of = batch.slice(lo, hi - lo)
                if not hi - lo:
                    continue
                if keys[lo] != key:
                    key, parts, block = keys[lo], [], None
                if kinds[lo] == 0:
                    parts.append((run_of.column(3), matrix(run_of.column(4), width)))
                    continue
                if not parts and block is None:
                    continue
                if block is None:
                    x = np.concatenate([m for _, m in parts])
                    names = pa.concat_arrays([i for i, _ in parts])
                    null = names.is_null().to_numpy(zero_copy_only=False)
                    ids = names.fill_null(0).to_numpy(zero_copy_only=False)
                    c = Rotated(x, turn)
                    order = np.argsort(-c.length, kind="stable")
                    block, parts = (c.part(order), ids[order], null[order]), []
                queries = run_of.column(3).to_numpy(zero_copy_only=False)
                least = run_of.column(5).to_numpy(zero_copy_only=False)
                q = Rotated(matrix(run_of.column(4), width), turn)
                best = best_of(q, least, *block, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[best.query]), pa.array(best.score),
                     pa.array(best.id, mask=best.null)], names=["query", "score", "vec_id"])
    return run


def top_products(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id",
                 vector: str = "embedding", block_bytes: int = BLOCK_BYTES, seeds: int = SEEDS,
                 group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `vectors` that `queries` selects, its k best other rows.

    Components count as floor(scale * x); the score is the integer inner
    product; ties go to the smaller vec_id, a null one last. The answer is
    exact. Defined edge cases: vectors that are null or hold null, NaN or
    infinite components take no part; shorter vectors are padded with zeros, so
    an empty one scores 0 with all; magnitudes beyond `component_bound(width)`
    (about 1.9e8 after scaling at 64 components) count as that bound, so no
    score overflows; a row whose vec_id is null is a candidate and never a
    query; rows that repeat a vec_id are candidates of each other, and each of
    them that is a query gets rows of its own; fewer than k others give fewer
    rows; an empty table gives none. Other columns are ignored.

    Work: candidates lie in blocks of `block_bytes` by descending length, on
    range partitions that also split ties. Queries are grouped by `group`; each
    (block, group) is one task's work, and a query goes only to blocks whose
    length bound reaches its threshold. What is gathered on the driver: width²
    sums, the `seeds` longest vectors and one bound per block.
    """
    spark = vectors.sparkSession
    ship(spark)
    table = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"),
                           F.coalesce(queries, F.lit(False)).alias("asked"))
    n, width = widest(table, "v")
    size = k + 1  # one more, for the query's own row
    base = table.where(usable("v")).select("id", floors("v", scale, component_bound(width)).alias("x"), "asked")
    base = base.withColumn("length", F.sqrt(F.aggregate(
        "x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
    per_block = max(1, block_bytes // (8 * max(1, width)))
    blocks = max(1, -(-n // per_block), min(4 * spark.sparkContext.defaultParallelism, -(-n // TILE)))
    placed = written(base.repartitionByRange(
        blocks, F.desc("length"), F.asc("id"), F.monotonically_increasing_id()).withColumn(
        "block", F.spark_partition_id()), "norm-blocks")
    turn = rotation(placed, width)
    tops = {r["block"]: r["top"] for r in placed.groupBy("block").agg(F.max("length").alias("top")).collect()}
    bounds = np.array([tops.get(b, 0.0) for b in range(max(tops, default=-1) + 1)])
    bounds = np.maximum.accumulate(bounds[::-1])[::-1]  # an empty block is bounded like the next one
    longest = placed.orderBy(F.desc("length")).limit(seeds).select("x").collect()
    first = np.array([list(r["x"]) + [0] * (width - len(r["x"])) for r in longest], np.int64).reshape(
        len(longest), width)

    asked = placed.where("asked and id is not null").groupBy("id", "x").agg(F.count("*").alias("copies"))
    asked = written(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    groups = max(1, -(-asked.count() // group))
    known = asked.select("query", "x").mapInArrow(
        _thresholds(first, bounds, turn, width, size), "query long, x array<long>, least double, reach int")
    sent = known.where("reach > 0").select(
        F.explode(F.sequence(F.lit(0), F.col("reach") - 1)).alias("block"),
        F.pmod(F.xxhash64("query"), F.lit(groups)).cast("long").alias("part"),
        F.lit(1).cast("byte").alias("kind"), F.col("query").alias("key"), "x", "least", F.lit(0.0).alias("length"))
    held = placed.select(
        F.col("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"),
        F.lit(0).cast("byte").alias("kind"), F.col("id").alias("key"), "x", F.lit(0.0).alias("least"), "length")
    tasks = held.unionByName(sent).select(
        F.col("block").cast("long").alias("block"), "part", "kind", "key", "x", "least", "length")
    tasks = tasks.repartition(max(1, len(bounds)) * groups, "block", "part").sortWithinPartitions(
        "block", "part", "kind", F.desc("length"))
    found = tasks.drop("length").mapInArrow(_search(turn, width, size), "query long, score long, vec_id long")

    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    own = asked.select("query", F.col("id").alias("query_id"), "copies", F.aggregate(
        "x", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("own"))
    named = best.join(own, "query")
    itself = ((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))).cast("int")
    # The query's own row, or one that cannot be told from it, goes once.
    named = named.withColumn("itself", F.coalesce(itself, F.lit(0)))
    named = named.withColumn("before", F.sum("itself").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    others = named.where("not (itself = 1 and coalesce(before, 0) = 0)")
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
