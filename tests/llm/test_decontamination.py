from hypothesis import given, settings, strategies as st

from meterline.llm import decontamination as d
from tests.llm.inputs import awkward, documents, SMALL

SHORT = st.text("abc ", min_size=1, max_size=24)


def least(pattern, text):
    """Smallest edit distance of `pattern` to any substring of `text`, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(SHORT, st.text("abc ", max_size=40))
def test_bit_vectors_equal_the_edit_matrix(pattern, text):
    distance, _ = d.myers(pattern, text, len(pattern))
    assert distance == least(pattern, text)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_no_occurrence_within_the_budget_is_lost(data):
    item = " ".join(data.draw(st.text("abcdefg ", min_size=5, max_size=700)).split()) or "x" * 40
    text = item
    for _ in range(data.draw(st.integers(0, 6))):
        at = data.draw(st.integers(0, len(text)))
        text = data.draw(st.sampled_from([text[:at] + "z" + text[at:], text[:at] + text[at + 1:],
                                          text[:at] + "y" + text[at + 1:]]))
    start = data.draw(st.integers(0, len(text)))  # also parts of it
    text = text[start:] if data.draw(st.booleans()) else text[:start]
    text = " ".join((data.draw(st.text("abc ", max_size=30)) + text + data.draw(st.text("abc ", max_size=30))).split())
    found = d.Matcher([(1, item)]).occurrences(text)
    want = expected(item, text)
    assert (found[1][0] if found else None) == want


def expected(item, text):
    """Distance of the best passage that occurs within its budget; every passage is searched in the whole text."""
    if len(item) <= d.PASSAGE_CHARS:
        windows = [item]
    else:
        step = d.PASSAGE_CHARS // 2
        windows = [item[i:i + d.PASSAGE_CHARS] for i in range(0, len(item) - d.PASSAGE_CHARS, step)]
        windows.append(item[-d.PASSAGE_CHARS:])
    near = [0 if f" {w} " in f" {text} " else None for w in windows if d.budget(len(w)) == 0]
    near += [n for w in windows if d.budget(len(w)) and (n := d.myers(w, text, d.budget(len(w)))[0]) <= d.budget(len(w))]
    return min((n for n in near if n is not None), default=None)


def test_lengths_from_five_to_three_thousand_follow_one_rule():
    words = " ".join(f"w{i * 7919 % 1000}" for i in range(700))
    around = "some text in front " * 20
    for size in (5, 12, 19, 24, 31, 32, 80, 255, 256, 257, 300, 512, 600, 1000, 1024, 1025, 1030, 2000, 3000):
        item = words[:size].strip()
        matcher = d.Matcher([(1, item)])
        assert matcher.occurrences(f"{around}{item} and more")[1][0] == 0
        assert matcher.occurrences(item)[1] == (0, min(len(item), d.PASSAGE_CHARS))
        assert not matcher.occurrences(around)
        half = matcher.occurrences(f"{around}{item[len(item) // 2:].strip()} and more")
        if len(item) // 2 >= 1.5 * d.PASSAGE_CHARS:
            assert half[1][0] == 0
        if len(item) <= d.PASSAGE_CHARS:
            assert not half
    assert d.Matcher([(1, "the cat")]).occurrences("see the cat run")[1] == (0, 11)
    assert not d.Matcher([(1, "the cat")]).occurrences("see the cats run")


def test_pieces_cover_the_item():
    for size in (24, 200, 511, 1024):
        text = "".join(chr(97 + i % 26) for i in range(size))
        parts = d.pieces(text, d.budget(size))
        assert "".join(p for _, p in parts) == text and len(parts) == d.budget(size) + 1
        assert min(len(p) for _, p in parts) >= min(size, d.PIECE_CHARS)


def test_documents_match_a_full_search(spark):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = documents(spark)
    want = set()
    items = [(r["item_id"], d.normal(r["text"])) for r in benchmark.collect()]
    for r in docs.collect():
        text = d.normal(r["text"])
        for item, whole in items:
            for passage in d.passages(whole):
                errors = d.budget(len(passage))
                if passage in text or d.myers(passage, text, errors)[0] <= errors:
                    want.add((r["doc_id"], item))
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, benchmark).collect()}
    assert found == want and want
    kept = {r["doc_id"] for r in d.clean(docs, benchmark).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {i for i, _ in want}


def test_many_blocks_and_awkward_rows(spark, monkeypatch):
    items = [(1, "Quick brown fox jumps over the lazy dog, near the river!"), (2, None), (3, ""), (4, "word"),
             (None, "some words in it no id at all but"), (5, "x" * 30), (5, "x" * 30),
             (6, " ".join(f"word{i % 977} thing{i % 13}" for i in range(400, 900)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_CHARS", 60)
    found = sorted((r["doc_id"], r["item_id"]) for r in d.contaminated(awkward(spark), benchmark).collect())
    assert found == [(1, 1), (2, 1), (2, 1), (6, 4), (7, 4), (8, 6), (9, 6)]
    kept = d.clean(awkward(spark), benchmark)
    assert kept.columns == awkward(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([3, 4, 5, 10, 11, 12, None, None], key=repr)
    assert d.contaminated(awkward(spark).limit(0), benchmark).count() == 0
    assert d.contaminated(awkward(spark), benchmark.limit(0)).count() == 0
