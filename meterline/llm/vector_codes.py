"""Product codes of vectors, with nearest entries found through LAESA pivots.

The distance of every part to a few fixed pivots is computed once and stored.
In each round the distances of the entries to the same pivots give, by the
triangle inequality, a lower bound for every part and entry: the largest
difference of the two distances. Entries are tried in the order of that bound,
and those whose bound exceeds the best distance so far are never evaluated.
What is evaluated is evaluated exactly, in integers.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import ship, written
from meterline.llm.vectors import component_bound, floors, lists, matrix, usable, widest

#: Pivots per part position, rows that are bounded at once, and the share of open pairs from which a chunk's are
#: evaluated as one product instead of one by one in the order of their bounds.
PIVOTS = 8
CHUNK = 2_048
DENSE = 0.05


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired integer rows."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def all_squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of `x` to all of `y`; doubles hold them if they stay below 2**52."""
    top = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    if 4 * x.shape[1] * int(top)**2 >= 2**52:
        return np.stack([squared(x, e[None, :]) for e in y], axis=1)
    a, b = x.astype(np.float64), y.astype(np.float64)
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)


def farthest_first(entries: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` entries, each the farthest from those before; ties go to the lower index."""
    if not len(entries):
        return entries
    chosen = [0]
    near = squared(entries, entries[:1])
    while len(chosen) < min(count, len(entries)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(entries, entries[chosen[-1:]]))
    return entries[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(pivots)))
    for k, p in enumerate(pivots):
        out[:, k] = np.sqrt(squared(x, p[None, :]).astype(np.float64))
    return out


def nearest(x: np.ndarray, far: np.ndarray, entries: np.ndarray, entry_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of the nearest entry of every row, ties to the lower index, and the evaluations made.

    `far` and `entry_far` are the distances of rows and entries to the pivots.
    """
    index, error, tried = np.empty(len(x), np.int64), np.empty(len(x), np.int64), 0
    for start in range(0, len(x), CHUNK):
        rows, to = x[start:start + CHUNK], far[start:start + CHUNK]
        bound = np.zeros((len(rows), len(entries)))
        for k in range(to.shape[1]):
            np.maximum(bound, np.abs(to[:, k, None] - entry_far[None, :, k]), out=bound)
        # Square roots are rounded: the bound gives way by more than they can be wrong.
        bound = np.maximum(bound * (1 - 1e-12) - 1e-9 * (1 + to.max(initial=0)), 0)**2
        best_at = bound.argmin(axis=1)
        best = squared(rows, entries[best_at])
        tried += len(rows)
        open_ = bound <= best[:, None]
        if np.count_nonzero(open_) > DENSE * open_.size:
            tried += np.count_nonzero(open_)
            d = all_squared(rows, entries)
            d[~open_] = np.iinfo(np.int64).max  # the nearest entry is never among these
            index[start:start + CHUNK] = best_at = d.argmin(axis=1)
            error[start:start + CHUNK] = d[np.arange(len(rows)), best_at]
            continue
        open_[np.arange(len(rows)), best_at] = False
        a, b = np.nonzero(open_)
        order = np.lexsort((bound[a, b], a))
        a, b = a[order], b[order]
        step = 1
        while len(a):
            place = np.arange(len(a)) - np.searchsorted(a, a)
            now = place < step
            i, j = a[now], b[now]
            d = squared(rows[i], entries[j])
            tried += len(i)
            order = np.lexsort((j, d, i))
            i, j, d = i[order], j[order], d[order]
            first = np.flatnonzero(np.diff(i, prepend=-1))
            i, j, d = i[first], j[first], d[first]
            better = (d < best[i]) | ((d == best[i]) & (j < best_at[i]))
            best[i[better]], best_at[i[better]] = d[better], j[better]
            a, b = a[~now], b[~now]
            stay = bound[a, b] <= best[a]
            a, b = a[stay], b[stay]
            step *= 2
        index[start:start + CHUNK], error[start:start + CHUNK] = best_at, best
    return index, error, tried


@dataclass
class Codebooks:
    """Entries and pivots per part position: parts x entries x components of integers."""

    entries: list[np.ndarray]
    pivots: list[np.ndarray]

    def bounds(self) -> list[np.ndarray]:
        return [distances(e, p) for e, p in zip(self.entries, self.pivots)]

    def sha256(self) -> str:
        values = (str(v) for part in self.entries for entry in part for v in entry.tolist())
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def _measure(pivots: list[np.ndarray], size: int):
    """Adds the distances of all parts to their pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), size * len(pivots))
            far = np.hstack([distances(x[:, k * size:(k + 1) * size], p) for k, p in enumerate(pivots)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(x), lists(far)], names=["id", "label", "x", "far"])
    return run


def _assigned(batch: pa.RecordBatch, books: Codebooks, bounds: list[np.ndarray], size: int):
    """(part position, its rows, index, error) of the parts of a batch (…, x, far)."""
    x, far = batch.column("x"), batch.column("far")
    x = matrix(x, size * len(books.entries))
    far = matrix(far, sum(len(p) for p in books.pivots))
    at = 0
    for k, (entries, bound) in enumerate(zip(books.entries, bounds)):
        part = x[:, k * size:(k + 1) * size]
        index, error, _ = nearest(part, far[:, at:at + bound.shape[1]], entries, bound)
        at += bound.shape[1]
        yield k, part, index, error


def _sums(books: Codebooks, size: int):
    """Per task: componentwise sums and counts of the parts of each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = books.bounds()
        total = [np.zeros(e.shape, np.int64) for e in books.entries]
        count = [np.zeros(len(e), np.int64) for e in books.entries]
        for batch in batches:
            for k, part, index, _ in _assigned(batch, books, bounds, size):
                np.add.at(total[k], index, part)
                count[k] += np.bincount(index, minlength=len(count[k]))
        for k in range(len(total)):
            used = np.flatnonzero(count[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(count[k][used]),
                 lists(total[k][used])], names=["part", "entry", "n", "total"])
    return run


def _codes(books: Codebooks, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = books.bounds()
        for batch in batches:
            code, error = np.full(len(batch), "", dtype=object), [0] * len(batch)
            for _, _, index, off in _assigned(batch, books, bounds, size):
                code = code + np.array([f"{i:02x}" for i in index], dtype=object)
                error = [a + int(b) for a, b in zip(error, off)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code.tolist(), pa.string()),
                 pa.array([min(e, 2**63 - 1) for e in error], pa.int64())], names=["id", "label", "code", "error"])
    return run


def updated(parts: DataFrame, books: Codebooks, size: int) -> Codebooks:
    """One round: every part to its nearest entry, every used entry to the floor of its parts' mean.

    What reaches the driver is one sum per entry and component.
    """
    sums = parts.mapInArrow(_sums(books, size), "part int, entry int, n long, total array<long>")
    flat = sums.select("part", "entry", "n", F.posexplode("total").alias("at", "value"))
    rows = flat.groupBy("part", "entry", "at").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n")).collect()
    entries = [e.copy() for e in books.entries]
    for r in rows:
        entries[r["part"]][r["entry"], r["at"]] = int(r["value"]) // r["n"]
    return Codebooks(entries, books.pivots)


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
             pivots: int = PIVOTS, vec_id: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per row of `vectors` with a usable vector.

    Components count as floor(scale * x); vectors are cut into `parts` equal
    consecutive parts. A part position's codebook starts as that part of the
    `entries` smallest vec_ids and is refined in `rounds` rounds; entries that
    no part chooses stay. `code` has two hex digits per part (entries <= 256).
    error is the squared distance summed over parts, label_error its sum over
    the rows of equal label, nulls together.

    Defined edge cases: vectors that are null or hold null, NaN or infinite
    components have no row; all others are padded with zeros to the longest
    length, rounded up to a multiple of `parts`; magnitudes beyond
    `component_bound` (about 3.8e8 after scaling for parts of 16) count as that
    bound, and sums beyond a long as the greatest long. A vec_id starts one
    entry, that of its componentwise least vector if rows repeat it; rows
    without vec_id start none but are coded. Without any vec_id there are no
    entries, and code, error and label_error are null. An empty table gives no
    rows. Other columns are ignored.

    Work: the integer parts and their pivot distances are written once; each
    round is one pass over them with the codebooks (`entries` vectors) sent
    along, and shuffles one row per task, entry and component.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    spark = vectors.sparkSession
    ship(spark)
    table = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"),
                           F.col(vector).alias("v"))
    _, width = widest(table, "v")
    size = max(1, -(-width // parts))
    whole = table.where(usable("v")).select(
        "id", F.col("label").cast("string").alias("label"),
        floors("v", scale, component_bound(size)).alias("x"))
    ids = [r["id"] for r in whole.select("id").where("id is not null").distinct().orderBy("id").limit(entries).collect()]
    first = whole.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("x").alias("x")).orderBy("id").collect()
    start = np.zeros((len(first), parts * size), np.int64)
    for row, r in zip(start, first):
        row[:len(r["x"])] = r["x"]
    start = [np.ascontiguousarray(start[:, k * size:(k + 1) * size]) for k in range(parts)]
    books = Codebooks(start, [farthest_first(e, pivots) for e in start])
    if not first:
        none = whole.select(F.col("id").alias("vec_id"), F.lit(None).cast("string").alias("code"),
                            F.lit(None).cast("long").alias("error"), F.lit(None).cast("long").alias("label_error"))
        return none.withColumn("codebooks_sha256", F.lit(books.sha256()))
    measured = written(whole.mapInArrow(
        _measure(books.pivots, size), "id long, label string, x array<long>, far array<double>"), "parts")
    for _ in range(rounds):
        books = updated(measured.select("x", "far"), books, size)
    coded = written(measured.mapInArrow(
        _codes(books, size), "id long, label string, code string, error long"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)"))
    labels = coded.groupBy("label").agg(total.cast("long").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"))
