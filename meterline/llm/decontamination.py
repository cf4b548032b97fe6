"""Benchmark decontamination: exact pieces by the pigeonhole principle, then Myers' distance.

An item is searched by its passages: windows of a fixed length, each starting
half a window behind the one before; an item of one window or less is a passage
itself. A passage that occurs in a text with at most k edits, cut into k + 1
pieces, has a piece that occurs unchanged. One automaton finds all pieces of a
block of items in one pass over a text, and only the places around hits are
verified. A passage too short for any edit is searched as whole words.
"""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import ship, written

#: Edits allowed per character of an item, and the shortest piece that is searched.
EDIT_RATE, PIECE_CHARS = 0.06, 16
#: Characters of a passage.
PASSAGE_CHARS = 256
#: Characters of items that one pass over the documents takes along.
BLOCK_CHARS = 4_000_000
_NO_WORD = re.compile(r"[\W_]+")
_BUILT: dict = {}


def normal(text: str | None) -> str:
    """Lower-case words with single blanks between them."""
    return _NO_WORD.sub(" ", (text or "").lower()).strip()


def passages(text: str) -> list[str]:
    """The windows of `text`; the last one ends where the text does."""
    last = max(0, len(text) - PASSAGE_CHARS)
    return [text[i:i + PASSAGE_CHARS] for i in [*range(0, last, PASSAGE_CHARS // 2), last]]


def budget(size: int) -> int:
    """Edits allowed for a passage, so that its pieces keep PIECE_CHARS characters."""
    return max(0, min(int(size * EDIT_RATE), size // PIECE_CHARS - 1))


def pieces(passage: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces of nearly equal length."""
    n = errors + 1
    cuts = [len(passage) * i // n for i in range(n + 1)]
    return [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, limit: int) -> tuple[int, int]:
    """(distance, end) of the best occurrence of `pattern` in `text`; distance limit + 1 if there is none.

    Columns of the edit matrix are bit vectors of vertical differences, in one
    integer of the pattern's length; an occurrence may start anywhere.
    """
    size = len(pattern)
    if not size:
        return 0, 0
    at = defaultdict(int)
    for i, c in enumerate(pattern):
        at[c] |= 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = min(size, limit + 1), 0
    for j, c in enumerate(text):
        equal = at.get(c, 0)
        vertical = equal | down
        equal |= (((equal & up) + up) ^ up)
        right, left = down | (~(equal | up) & full), up & equal
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1) & full, (left << 1) & full
        up, down = left | (~(vertical | right) & full), right & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Items (item_id, normal text) of a block, and where they occur in a text."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick
        self.units, found = [], defaultdict(list)
        for item, text in items:
            for passage in passages(text) if text else ():
                errors = budget(len(passage))
                if errors:
                    for offset, piece in pieces(passage, errors):
                        found[piece].append((len(self.units), offset))
                else:
                    found[f" {passage} "].append((len(self.units), -1))
                self.units.append((item, passage, errors))
        self.automaton = ahocorasick.Automaton() if found else None
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def occurrences(self, text: str) -> dict[int, tuple[int, int]]:
        """item -> (distance, end) of its best occurrence in the normal form `text`."""
        out, spans = {}, defaultdict(list)
        for end, (size, places) in self.automaton.iter(f" {text} ") if self.automaton else ():
            for unit, offset in places:
                item, passage, errors = self.units[unit]
                start = end - size - offset  # in `text`, which has no blank in front
                if not errors:
                    out[item] = min(out.get(item, (0, start + len(passage))), (0, start + len(passage)))
                    continue
                lo, hi = max(0, start - errors), start + len(passage) + errors
                around = spans[unit]
                if around and lo <= around[-1][1]:
                    around[-1][0] = min(around[-1][0], lo)
                    around[-1][1] = max(around[-1][1], hi)
                else:
                    around.append([lo, hi])
        for unit, around in spans.items():
            item, passage, errors = self.units[unit]
            for lo, hi in around:
                distance, end = myers(passage, text[lo:hi], errors)
                if distance <= errors and (item not in out or (distance, lo + end) < out[item]):
                    out[item] = (distance, lo + end)
        return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("end", pa.int64())])


def _search(items, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Matcher(items.value)
        matcher = _BUILT[key]
        for batch in batches:
            rows = [{"doc_id": doc.as_py(), "item_id": item, "distance": d, "end": end}
                    for doc, text in zip(batch.column(0), batch.column(1))
                    for item, (d, end) in matcher.occurrences(normal(text.as_py())).items()]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, distance, end): every document that holds a passage of a benchmark item.

    Texts are compared as lower-case words. A passage of n characters may
    differ by EDIT_RATE * n edits, as long as its pieces keep PIECE_CHARS
    characters, so one below twice that has to occur as it is, between blanks.
    `distance` and `end` are those of the item's best passage, `end` in the
    document's normal form. So any run of one and a half passages of an item is
    found, and a shorter item wherever it stands in a text. Documents are never
    shuffled: the items go to them in blocks of about BLOCK_CHARS characters,
    each block one pass. Of several blocks, each is collected, sent, searched
    and let go of before the next.

    Null or empty items match nothing and null or empty texts hold nothing; repeated documents are each reported, repeated items once by their item_id; an item
    without item_id is reported without one; other columns are ignored; empty
    tables give no rows.
    """
    import uuid

    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    base = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.length("text") > 0)
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    placed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        rows = placed.where(F.col("block") == block).select("item_id", "text").distinct().collect()
        shared = spark.sparkContext.broadcast([(r["item_id"], normal(r["text"])) for r in rows])
        found = base.mapInArrow(_search(shared, uuid.uuid4().hex), "doc_id long, item_id long, distance long, end long")
        if blocks > 1:
            found = written(found, "contaminated")
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark item; rows without doc_id are judged one by one.

    All columns are kept. A row goes if any row of its doc_id is contaminated.
    """
    named = docs.where("doc_id is not null")
    gone = contaminated(named, benchmark).select(F.col("doc_id").alias("__op_gone")).distinct()
    kept = named.join(gone, named["doc_id"] == gone["__op_gone"], "left_anti")
    unnamed = docs.where("doc_id is null").withColumn("__op_row", F.xxhash64("text"))
    bad = contaminated(unnamed, benchmark, "__op_row").select(F.col("doc_id").alias("__op_gone")).distinct()
    return kept.unionByName(unnamed.join(bad, unnamed["__op_row"] == bad["__op_gone"], "left_anti").drop("__op_row"))
