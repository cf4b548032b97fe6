"""Exact token counts and ids from vocabulary files, with most words looked up.

White space that stands alone between two other characters is a border that no
pre-token crosses, and in the vocabularies used here the blank belongs to the
text behind it or is dropped. So the pieces between such borders are encoded
independently of each other. Pieces of common letters are cut into pre-tokens
here and merged by the library's model; all others are encoded by the library
whole. Either way the result stays in a table of bounded size. Counts are added
up text by text; for ids, many texts are cut at once and Arrow finds their
distinct pieces and puts the ids together.
"""
from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_SETTLED: dict = {}
#: Entries of a generation of a worker's table.
TABLE_ENTRIES = 300_000
#: Longer pieces are encoded each time and not kept.
KEPT_CHARS = 48


def library(path: str):
    """The tokenizer of `path`, once per process, without padding or truncation."""
    if ("library", path) not in _SETTLED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        _SETTLED["library", path] = tokenizer
    return _SETTLED["library", path]


def vocabulary_path(name: str) -> str:
    """Where this machine keeps the public vocabulary file `name`."""
    import public_tokenizers
    return public_tokenizers.path(name)


def whole_tokens(path: str, word_end: str = "</w>") -> frozenset[str]:
    """Strings of lower-case ASCII letters that the library encodes as one token.

    The proof is by trial: every candidate of the vocabulary is encoded alone,
    and only those that give exactly their own entry are listed. Such a string,
    met as a whole pre-token, is one token.
    """
    if ("whole", path) not in _SETTLED:
        tokenizer = library(path)
        plain = re.compile(r"[a-z]+")
        found = {w[:-len(word_end)]: i for w, i in tokenizer.get_vocab(False).items()
                 if w.endswith(word_end) and plain.fullmatch(w[:-len(word_end)])}
        words = list(found)
        codes = tokenizer.encode_batch_fast(words, add_special_tokens=False)
        _SETTLED["whole", path] = frozenset(
            w for w, c in zip(words, codes) if c.ids == [found[w]])
    return _SETTLED["whole", path]


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def _spelled(pretoken: str) -> str:
    """`pretoken` in the byte-level alphabet, as the vocabulary's model takes it."""
    if pretoken.isascii():
        return pretoken.replace(" ", _LETTERS[32])
    return pretoken.encode("utf-8").decode("latin-1").translate(_LETTERS)


class Table(dict):
    """Piece -> value, made when missed; two generations of at most `entries` pieces each.

    When the young generation is full it becomes the old one, from which pieces
    that are met again move back; so frequent pieces stay.
    """

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[piece] = value
        return value


#: Characters whose lower case, normal form and class are the same in the library and here.
_COUNTED = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_COUNTED_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Counter:
    """Token counts of a vocabulary whose pre-tokens never hold white space.

    A pre-token that is proved to be a whole token counts one; only the others
    are merged. Pieces with other characters, or with the beginning of a special
    string, are left to the library as they are.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        self.tokenizer, self.whole = library(path), whole_tokens(path)
        self.model = self.tokenizer.model
        self.table = Table(self._piece, entries)

    def _piece(self, piece: str) -> int:
        if not piece:
            return 0
        if "<|" in piece or not _COUNTED.fullmatch(piece):
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        parts = _COUNTED_PARTS.findall(piece.lower())
        if len(parts) == 1:
            return 1 if parts[0] in self.whole else len(self.model.tokenize(_spelled(parts[0])))
        return sum(map(self.table.__getitem__, parts))

    def counts(self, texts: list[str]) -> list[int]:
        look = self.table.__getitem__
        return [sum(map(look, t.replace("\n", " ").split(" "))) for t in texts]


#: Letters, digits and marks, which the byte-level rule cuts into runs; an
#: apostrophe may begin a contraction and is left to the library.
_LETTER, _DIGIT, _MARK = "[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ]", "[0-9]", "[!-&(-/:-@[-`{-~]"
_RUN = re.compile(f" ?(?:{_LETTER}+|{_DIGIT}+|{_MARK}+)")
_SPACE, _OTHER = 0, 4


def _character_kinds() -> np.ndarray:
    """The kind of every code point up to U+3000, the last white space; behind it that of all others."""
    kinds = np.full(0x3002, _OTHER, np.uint8)
    characters = "".join(map(chr, range(0x3001)))
    for kind, pattern in enumerate([r"\s", _LETTER, _DIGIT, _MARK]):
        kinds[[m.start() for m in re.finditer(pattern, characters)]] = kind
    return kinds


_KINDS = _character_kinds()
#: The kinds of single bytes; those of longer characters are filled in behind.
_BYTE_KINDS = _KINDS[:256].tobytes()


def _byte_kinds(utf8: bytes) -> np.ndarray:
    """The kind of the character that each byte belongs to."""
    code, kind = np.frombuffer(utf8, np.uint8), np.frombuffer(bytearray(utf8.translate(_BYTE_KINDS)), np.uint8)
    first = np.flatnonzero(code >= 0xC0)
    lead = code[first].astype(np.int32)
    point = (lead & 0x1F) << 6 | code[first + 1] & 0x3F
    long = lead >= 0xE0
    point[long] = (point[long] & 0x3FF) << 6 | code[first[long] + 2] & 0x3F
    point[lead >= 0xF0] = len(_KINDS)
    found = _KINDS[np.minimum(point, len(_KINDS) - 1)]
    for i, least in enumerate((0xC0, 0xC0, 0xE0, 0xF0)):
        kind[first[lead >= least] + i] = found[lead >= least]
    return kind


def _units(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Units that are encoded independently of each other, and which of them stand for the ends of the texts.

    A blank between two other characters leads the unit behind it, a newline
    between two others is one by itself; no pre-token crosses these borders.
    What lies between them is cut into runs of letters, digits and marks if it
    holds nothing else, and no beginning of a special string. A newline behind
    each text, which is no part of it, keeps the texts apart.
    """
    encoded = [t.encode("utf-8") for t in texts]
    utf8 = b"\n".join(encoded) + b"\n"
    ends = np.cumsum([len(t) + 1 for t in encoded]) - 1
    code, kind = np.frombuffer(utf8, np.uint8), _byte_kinds(utf8)
    space = kind == _SPACE
    newline = code == ord("\n")
    alone = (code == ord(" ")) | newline
    alone[0] = alone[ends] = False
    alone[1:] &= ~space[:-1]
    alone[:-1] &= ~space[1:]

    border = alone.copy()
    border[1:] |= (alone & newline)[:-1]
    border[0] = border[ends] = border[ends[:-1] + 1] = True
    run = np.zeros(len(code), bool)
    run[1:] = (kind[1:] != kind[:-1]) & ~space[1:] & ~space[:-1]
    odd = (kind == _OTHER) | (space & ~alone)
    odd[:-1] |= (code[:-1] == ord("<")) & (code[1:] == ord("|"))
    starts = np.flatnonzero(border)
    whole = np.zeros(len(starts), bool)
    whole[np.searchsorted(starts, np.flatnonzero(odd), "right") - 1] = True
    run &= ~np.repeat(whole, np.diff(starts, append=len(code)))
    starts = np.flatnonzero(border | run)
    units = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(code)).astype(np.int64)), pa.py_buffer(utf8))
    return units.dictionary_encode(), np.searchsorted(starts, ends)


class Encoder:
    """Little-endian 32-bit ids of a byte-level vocabulary whose blanks lead their word.

    Texts are cut many at a time, and each distinct unit of them is looked up once.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        self.tokenizer = library(path)
        self.model = self.tokenizer.model
        self.first, self.after_blank = Table(self._unit, entries), Table(self._unit, entries)

    def _unit(self, unit: str) -> bytes:
        if "<|" not in unit and _RUN.fullmatch(unit):
            ids = [t.id for t in self.model.tokenize(_spelled(unit))]
        else:
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, texts: list[str], closing: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, `closing` behind each, and where each text ends there."""
        if not texts:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        units, last = _units(texts)
        codes = [self.after_blank[u] if u[0] == " " else self.first[u]
                 for u in units.dictionary.to_numpy(zero_copy_only=False).tolist()]
        index = units.indices.to_numpy().copy()
        index[last] = len(codes)
        taken = pa.array([*codes, closing], pa.large_binary()).take(pa.array(index))
        _, offsets, ids = taken.buffers()
        ends = np.frombuffer(offsets, np.int64, len(index) + 1)[last + 1] // 4
        return np.frombuffer(ids, "<u4", ends[-1]) if ends[-1] else np.empty(0, "<u4"), ends

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.ids(texts)
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def batches_of(texts: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """(start, texts) in runs of about `limit` characters, null as empty."""
    start, run, size = 0, [], 0
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        if run and size + len(text) > limit:
            yield start, run
            start, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def _count(name_or_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = name_or_path if os.path.sep in name_or_path else vocabulary_path(name_or_path)
        if ("counter", path) not in _SETTLED:
            _SETTLED["counter", path] = Counter(path)
        counter = _SETTLED["counter", path]
        for batch in batches:
            ids = batch.column(0)
            for start, texts in batches_of(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [ids[start:start + len(texts)],
                     pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                     pa.array(counter.counts(texts), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text, in one pass without a shuffle.

    Counts are those of the library without begin, end or added special tokens;
    special strings inside texts count as the library's default has it. A null
    or empty text has no tokens; null and repeated doc_ids are carried along;
    other columns are ignored. `vocabulary` is a file name of the public
    vocabularies, looked up on each executor, or a path.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(_count(vocabulary), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
