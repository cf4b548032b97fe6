import random

import numpy as np
import pytest

from meterline.llm import near_duplicates as near
from meterline.llm.common import connected
from tests.llm.inputs import awkward, documents


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, percent):
    """doc_id -> (set size, smallest id reachable) by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(docs, width=4, percent=80):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(pairs, width, percent)
    found = near.near_duplicates(docs, width, percent).collect()
    assert len(found) == len(pairs)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    return want


def copies(n, words=120, seed=3):
    """A hot group: copies of one text with up to four words changed, linked directly or through others."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(words)] = f"x{rng.randrange(9999)}"
        out.append((1000 + i, " ".join(text)))
    return out


def test_documents_match_all_pairs(spark):
    want = check(documents(spark))
    assert len({c for _, c in want.values()}) < len(want)


def test_hot_group_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_DOCS", 16)
    rows = copies(150) + [(5000 + i, copies(1)[0][1]) for i in range(60)]
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = [c for _, c in want.values()]
    assert max(sizes.count(c) for c in set(sizes)) > 80


def test_large_components_that_only_bands_tie(spark, monkeypatch):
    """A cluster of several components, some larger than a block; nothing within one is compared twice."""
    monkeypatch.setattr(near, "BLOCK_DOCS", 8)
    base = copies(1, 200, 9)[0][1].split()
    rows = []
    for family in range(6):
        text = base[:100 + 2 * family] + [f"f{family}w{i}" for i in range(28 - 4 * family)] + base[160:]
        for i in range((40, 25, 3, 2, 30, 1)[family]):
            one = list(text)
            one[i % len(one)] = f"x{family}y{i}"
            rows.append((family * 1000 + i, " ".join(one)))
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert 1 < len({c for _, c in want.values()}) < len(rows)
    members = spark.createDataFrame([(1, i, 5) for i in range(1, 101)], "root long, node long, n_shingles long")
    stars = spark.createDataFrame([(i, 1) for i in range(2, 91)], "node long, root long")
    tasks = near._unresolved(members, stars).collect()
    assert {r["node"] for r in tasks if r["first"] == r["second"]} == set(range(91, 101))
    assert all("shared" in r["first"] + r["second"] for r in tasks)
    assert near._unresolved(members, stars.union(spark.createDataFrame([(i, 1) for i in range(91, 101)]))).count() == 0


def test_intersections_beyond_single_precision():
    left, right = np.arange(200_001, dtype=np.uint64), np.arange(40_000, 250_001, dtype=np.uint64)
    common, union = 160_001, 250_001
    for percent in (63, 64, 65):
        found = list(near.similar_pairs([left], [right], percent))
        assert bool(found) == (100 * common >= percent * union)


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b = copies(1, 40, 1)[0][1], copies(1, 40, 2)[0][1]
    docs = spark.createDataFrame([(5, a, "x"), (5, b, "y"), (7, a + " tail", "z"), (None, b, "n"), (9, None, "e"),
                                  (9, None, "e"), (4, "apart from all others it is", "o")],
                                 "doc_id long, text string, __op_node string")
    assert sorted(r["__op_node"] for r in near.keep_first(docs).collect()) == ["e", "e", "o", "x", "y"]


def test_awkward_documents(spark):
    want = check(awkward(spark), width=5)
    assert want[2][1] == 1 and want[9][1] == 8 and want[7][1] == 6 and want[4][1] == 4
    kept = near.keep_first(awkward(spark)).collect()
    assert kept[0].asDict().keys() == awkward(spark).first().asDict().keys()
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted(
        [1, 3, 4, 5, 6, 8, 10, 11, 12, None, None], key=repr)
    assert near.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_signature_is_one_shifted_permutation():
    hashes = near.shingle_hashes([b"a", b"b", b"c", b"d", b"e"], 2)
    x = near.scattered(hashes).astype(np.uint64)
    out = near.signature(hashes, 40)
    for k in range(40):
        y = (x - np.uint64(k)) & np.uint64(0xFFFFFFFF)
        y = (y * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        y ^= y >> np.uint64(15)
        y = (y * np.uint64(0x85EBCA77)) & np.uint64(0xFFFFFFFF)
        assert out[k] == y.min()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.8, 0.95):
        n = 2000
        common = int(n * 2 * share / (1 + share))
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = near.signature(pool[:n], 512), near.signature(pool[n - common:2 * n - common], 512)
        assert abs(float(np.mean(a == b)) - common / (2 * n - common)) < 0.08


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (9, 8)],
                                   [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(77, 49)]])
def test_components(spark, edges):
    found = {r["node"]: r["root"] for r in connected(
        spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    rows = {}
    for a, b in edges:
        merged = rows.get(a, {a}) | rows.get(b, {b})
        rows.update(dict.fromkeys(merged, merged))
    assert found == {i: min(s) for i, s in rows.items() if i != min(s)}
