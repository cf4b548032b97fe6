from hypothesis import given, settings, strategies as st
import numpy as np
import public_tokenizers
import pytest

from meterline.llm import tokens
from tests.llm.inputs import AWKWARD, awkward, documents

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = st.sampled_from(
    ["the", "The", "don't", "'s", "'re", "x1y22", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "\x1c", "é", "é", "İ",
     "Σ", "ß", "漢", "😀", "<|endoftext|>", "<|startoftext|>", "<|", "...", "--", "_", "ﬁ", "ǅ", "\u200d"])


def expected(path: str, text: str) -> list[int]:
    return tokens.library(path).encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join) | st.text(max_size=30))
def test_counts_and_ids_equal_the_library(text):
    assert tokens.Counter(WORD).counts([text, text]) == [len(expected(WORD, text))] * 2
    code = tokens.Encoder(BYTE).encode([text])[0]
    assert [int.from_bytes(code[i:i + 4], "little") for i in range(0, len(code), 4)] == expected(BYTE, text)


@pytest.mark.parametrize("entries", [1, 50, 10_000])
def test_a_bounded_table_changes_nothing(entries):
    texts = [t or "" for _, t, _, _ in AWKWARD] * 2
    counter, encoder = tokens.Counter(WORD, entries), tokens.Encoder(BYTE, entries)
    for text in texts:
        assert counter.counts([text]) == [len(expected(WORD, text))]
        assert len(encoder.encode([text])[0]) == 4 * len(expected(BYTE, text))
        assert max(len(counter.table), len(encoder.after_blank), len(counter.table.old)) <= entries


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PIECES | st.sampled_from(["×", "÷", "’", "ŉ", "\u1680", "\u3000", "ー", "\u0085", "<", "|"]),
                         max_size=8).map("".join) | st.text(max_size=12), max_size=6))
def test_texts_encoded_together_stay_apart(texts):
    ids, ends = tokens.Encoder(BYTE).ids(texts, (7).to_bytes(4, "little"))
    found = [part.tolist() for part in np.split(ids, ends[:-1])] if texts else []
    assert found == [expected(BYTE, text) + [7] for text in texts]
    assert [len(code) // 4 + 1 for code in tokens.Encoder(BYTE).encode(texts)] == [len(f) for f in found]


def test_a_distinct_unit_is_looked_up_once_among_many_texts():
    """However small the table: words, marks and newlines that come back are not encoded again."""
    encoder, made = tokens.Encoder(BYTE, 1), []
    for table in (encoder.first, encoder.after_blank):
        table.make = lambda unit, make=table.make: (made.append(unit), make(unit))[1]
    texts = ["the cat, the dog\nand the bird don't, 12 cats", "", "the dog, the cat and"] * 50
    codes = encoder.encode(texts)
    assert [len(c) for c in codes] == [4 * len(expected(BYTE, t)) for t in texts]
    assert len(made) == len(set(made)) < 20


@pytest.mark.parametrize("code", [0x20, 0x7f, 0x85, 0xa0, 0xd7, 0xe9, 0x17f, 0x1680, 0x2028, 0x3000, 0x3001, 0xffff,
                                  0x10000, 0x10ffff])
def test_bytes_have_the_kind_of_their_character(code):
    text = "a" + chr(code) + "1"
    kinds = tokens._byte_kinds((text + "\n").encode()).tolist()
    assert kinds[:-1] == [1] + [tokens._KINDS[min(code, 0x3001)]] * len(chr(code).encode()) + [2]


def test_whole_tokens_are_proved_by_the_library():
    whole = tokens.whole_tokens(WORD)
    assert "the" in whole and len(whole) > 10_000
    some = sorted(whole)[::97]
    assert all(len(expected(WORD, w)) == 1 for w in some)


def test_every_text_is_counted(spark):
    for docs in (documents(spark), awkward(spark)):
        text = {(r["doc_id"], r["text"]) for r in docs.collect()}
        found = tokens.token_counts(docs, limit=100).collect()
        assert len(found) == docs.count()
        want = sorted(((i, len((t or "").encode()), len(expected(WORD, t or ""))) for i, t in
                       ((r["doc_id"], r["text"]) for r in docs.collect())), key=repr)
        assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in found), key=repr) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in found) and text
    assert tokens.token_counts(documents(spark).limit(0)).count() == 0
