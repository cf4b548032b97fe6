from collections import defaultdict
from zlib import crc32

from hypothesis import given, settings, strategies as st
import numpy as np
import public_tokenizers

from meterline.llm import packing, tokens
from tests.llm.inputs import awkward, documents

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_each_piece_goes_to_the_tightest_window(lengths):
    lengths = sorted(lengths, reverse=True)
    numbers, offsets = packing.best_fit_decreasing(np.array(lengths, np.int64), 32)
    free: list[int] = []
    for length, number, offset in zip(lengths, numbers, offsets):
        fits = [f for f in free if f >= length]
        if number == len(free):
            assert not fits
            free.append(32)
        assert free[number] == (min(fits) if fits else 32)
        assert offset == 32 - free[number]
        free[number] -= length


def check(docs, pieces):
    texts = defaultdict(list)
    for r in docs.collect():
        ids = tokens.library(BYTE).encode(r["text"] or "", add_special_tokens=False).ids + [0]
        texts[r["doc_id"]].append(ids)
    windows, seen = defaultdict(list), defaultdict(list)
    for p in pieces.collect():
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        seen[p["doc_id"], p["doc_tokens"]].append((p["start"], p["length"], p["ids_crc32"]))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    want = defaultdict(list)
    for doc, versions in texts.items():
        for ids in versions:
            for start in range(0, len(ids), 1024):
                part = np.array(ids[start:start + 1024], "<u4")
                want[doc, len(ids)].append((start, len(part), crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(v) for k, v in seen.items()}
    return windows


def test_every_id_lies_in_one_piece(spark):
    docs = documents(spark)
    windows = check(docs, packing.pack(docs))
    used = sum(length for spans in windows.values() for _, length in spans)
    assert used / (1024 * len(windows)) > 0.97
    check(awkward(spark), packing.pack(awkward(spark)))
    assert packing.pack(docs.limit(0)).count() == 0


def test_full_sequences(spark):
    docs = awkward(spark)
    rows = packing.sequences(packing.pack(docs, with_ids=True)).collect()
    assert all(len(r["ids"]) == (r["n_tokens"] if r["n_tokens"].bit_count() == 1 else 1024) for r in rows)
    total = sum(len(tokens.library(BYTE).encode(r["text"] or "").ids) + 1 for r in docs.collect())
    assert sum(r["n_tokens"] for r in rows) == total


def test_sequences_of_a_power_of_two_are_not_padded(spark):
    pieces = spark.createDataFrame([(1, 0, 3, [7, 8, 9]), (1, 3, 1, [0]), (2, 0, 3, [5, 6, 0]), (3, 0, 8, [4] * 8)],
                                   "sequence_id long, offset long, length long, ids array<int>")
    found = {r["sequence_id"]: (r["ids"], r["n_tokens"]) for r in packing.sequences(pieces, 8, 1).collect()}
    assert found == {1: ([7, 8, 9, 0], 4), 2: ([5, 6, 0, 1, 1, 1, 1, 1], 3), 3: ([4] * 8, 8)}


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 20)
    check(documents(spark), packing.pack(documents(spark)))
