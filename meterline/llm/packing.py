"""Best-fit decreasing packing of token pieces into windows of a fixed size."""
from __future__ import annotations

import os
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import written
from meterline.llm.tokens import Encoder, _SETTLED, batches_of, vocabulary_path

#: Ends that one task packs on average; more of them hardly reduce the padding.
SHARD_PIECES = 20_000
#: Characters that are encoded at a time; a distinct unit of them is looked up once.
RUN_CHARS = 8_000_000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Open windows under a segment tree over remaining capacity.

    Leaf c tells whether a window with exactly c free places is open; an inner
    node, whether one is below it. The tightest window that holds a piece is
    the leftmost marked leaf at or above its length.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.marked = bytearray(2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, capacity: int, number: int) -> None:
        self.stacks[capacity].append(number)
        node = self.leaves + capacity
        while node and not self.marked[node]:
            self.marked[node] = 1
            node >>= 1

    def tightest(self, length: int) -> int:
        """The smallest capacity >= length with an open window, or -1."""
        node = self.leaves + length
        if self.marked[node]:
            return length
        while node > 1:
            if not node & 1 and self.marked[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.marked[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1

    def take(self, capacity: int) -> int:
        number = self.stacks[capacity].pop()
        if not self.stacks[capacity]:
            node = self.leaves + capacity
            self.marked[node] = 0
            node >>= 1
            while node and not (self.marked[2 * node] or self.marked[2 * node + 1]):
                self.marked[node] = 0
                node >>= 1
        return number


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each piece; `lengths` come in decreasing order."""
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, opened = OpenWindows(window), 0
    for i, length in enumerate(lengths.tolist()):
        capacity = tree.tightest(length)
        if capacity < 0:
            number, capacity = opened, window
            opened += 1
        else:
            number = tree.take(capacity)
        numbers[i], offsets[i] = number, window - capacity
        if capacity > length:
            tree.put(capacity - length, number)
    return numbers, offsets


def _cut(vocabulary: str, window: int, closing_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary if os.path.sep in vocabulary else vocabulary_path(vocabulary)
        if ("encoder", path) not in _SETTLED:
            _SETTLED["encoder", path] = Encoder(path)
        encoder = _SETTLED["encoder", path]
        closing = int(closing_id).to_bytes(4, "little")
        for batch in batches:
            docs = batch.column(0)
            for first, texts in batches_of(batch.column(1), RUN_CHARS):
                ids, ends = encoder.ids(texts, closing)
                totals = np.diff(ends, prepend=0)
                counts = -(-totals // window)
                doc = np.repeat(np.arange(len(texts)), counts)
                start = window * (np.arange(len(doc)) - (np.cumsum(counts) - counts)[doc])
                length = np.minimum(window, totals[doc] - start)
                stops = np.cumsum(length)
                code = memoryview(ids).cast("B")
                sums = [crc32(code[4 * a:4 * b]) for a, b in zip((stops - length).tolist(), stops.tolist())]
                arrays = [docs.take(pa.array(first + doc)), pa.array(start), pa.array(length),
                          pa.array(sums, pa.int64()), pa.array(totals[doc])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(0, stops), pa.int32()),
                                                           pa.array(ids.view("<i4"))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def _pack(window: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "piece"], ascending=[False, True], kind="stable")
        numbers, offsets = best_fit_decreasing(group["length"].to_numpy(), window)
        return pd.DataFrame({"piece": group["piece"], "sequence_id": (int(key[0]) << 31) + numbers,
                             "offset": offsets})
    return run


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", window: int = 1024, closing_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place and checksum, and its place in a sequence.

    A document is its ids and then `closing_id`. Documents longer than `window`
    are first cut into full windows, each a sequence of its own; the ends are
    dealt at random to tasks of about SHARD_PIECES pieces and packed there by
    best fit decreasing. Sequence ids are unique but not dense; an end's id is
    negative in none. With `with_ids`, the ids come along (`ids`).

    A null or empty text is the closing id alone; null and repeated doc_ids are
    carried along, each row a document of its own; an empty table gives no
    rows; other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = _PIECES + (", ids array<int>" if with_ids else "")
    pieces = written(base.mapInArrow(_cut(vocabulary, window, closing_id, with_ids), schema).withColumn(
        "piece", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == window).withColumn(
        "sequence_id", F.col("piece") + F.lit(1 << 62)).withColumn("offset", F.lit(0).cast("long"))
    ends = pieces.where(F.col("length") < window)
    shards = max(1, -(-ends.count() // SHARD_PIECES))
    placed = ends.select("piece", F.col("length").cast("int").alias("length"),
                         F.pmod(F.xxhash64("piece"), F.lit(shards)).alias("shard")).groupBy("shard").applyInPandas(
        _pack(window), "piece long, sequence_id long, offset long")
    both = full.unionByName(ends.join(placed, "piece"))
    return both.drop("piece")


def sequences(pieces: DataFrame, window: int = 1024, padding_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens): whole sequences out of `pack(…, with_ids=True)`.

    Each is padded to `window` ids, but for those whose length is a power of two.
    """
    rows = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    padded = F.concat(ids, F.array_repeat(F.lit(padding_id), F.lit(window) - F.col("n_tokens").cast("int")))
    even = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return rows.select("sequence_id", F.when(even, ids).otherwise(padded).alias("ids"), "n_tokens")
