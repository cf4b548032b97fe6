"""Cheapest repair of damaged conversations, by an auction for shortest paths.

A repair is a path through a lattice of (rows behind, role said last). Keep,
Rerole and Delete lead to the next row, Insert to another role at the same row.
Every node has a price that never exceeds the cost from there to the end. From
the origin a path is extended along an arc that is tight (price = cost + price
ahead); where none is, the price of the last node is raised to the least of its
arcs and the path contracts. When the path reaches the end, the prices of its
nodes are exact, and as tight arcs are tried in the order of their letters, it
is the least in ASCII of all cheapest paths.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import ship, written

# Costs of the edits, what an undeleted truncated row adds, blanks, and ends of a finished row.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: Conversations beyond so many rows or code points are repaired in pieces of that many rows.
LONG_ROWS = 1_024
LONG_CHARS = 4_000_000
#: Rows whose prices are settled together, from the end backwards.
SEGMENT = 8

START, SYSTEM, USER, ASSISTANT = range(4)
#: Role said last and initial of the row -> role said next, for rows that stay as they are.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only role that may be inserted or given next.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 60
#: The end of a conversation: nothing, or a turn of the assistant last.
FINAL = (0, _NEVER, _NEVER, 0)
#: What it costs to get there from each role behind the last row.
CLOSING = (0, 2 * INSERT, INSERT, 0)


def code(role: str, fault: str | None) -> str:
    """A row as one letter: its initial (o if that can never stay), upper-case if truncated; x if it has to go."""
    if fault in ("blank", "duplicate"):
        return "x"
    letter = role[0] if role[:1] in ("s", "u", "a") else "o"
    return letter.upper() if fault == "truncated" else letter


def _least(letter: str) -> int:
    return DELETE if letter == "x" else TRUNCATED if letter.isupper() else 0


@lru_cache(maxsize=4096)
def _arcs(letter: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(letter of the edit, cost, rows consumed, next role) from a role at a row, in ASCII order."""
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state])]
    if letter != "x":
        more = TRUNCATED if letter.isupper() else 0
        if (to := _KEPT.get((state, letter.lower()))) is not None:
            arcs.append(("K", more, 1, to))
        arcs.append(("R", REROLE + more, 1, _NEXT[state]))
    return tuple(arcs)


class Auction:
    """Prices over the lattice of one run of rows; `ends` are the costs from each role behind the last row.

    `last`: whether the run ends the conversation, so that rows may be inserted
    behind it; else those belong to the run that follows.
    """

    def __init__(self, rows: str, ends: Sequence[int], last: bool = True):
        self.rows, self.ends, self.last = rows, tuple(ends), last
        self.price = [min(ends)] * 4 * (len(rows) + 1)
        self.start(0, len(rows))

    def start(self, first: int, to: int) -> None:
        """Opening prices of rows `first` to `to`: the least price at `to` and what every row in between costs at least."""
        least = min(self.price[4 * to:4 * to + 4])
        for at in range(to - 1, first - 1, -1):
            least += _least(self.rows[at])
            self.price[4 * at:4 * at + 4] = [least] * 4

    def arcs(self, at: int, state: int):
        if at < len(self.rows):
            return _arcs(self.rows[at], state)
        return (("I", INSERT, 0, _NEXT[state]),) if self.last else ()

    def path(self, at: int, state: int, to: int | None = None) -> tuple[str, int]:
        """Extends and contracts from a node until the end, or until row `to`; the edits and the last role."""
        price, edits = self.price, []
        nodes = [(at, state)]
        while True:
            at, state = nodes[-1]
            if to is not None and at >= to:
                return "".join(edits), state
            best, arc = _NEVER, None
            if at == len(self.rows) and self.ends[state] < _NEVER:
                best, arc = self.ends[state], ("", 0, 0, state)
            for one in self.arcs(at, state):
                value = one[1] + price[4 * (at + one[2]) + one[3]]
                if value < best:
                    best, arc = value, one
            if best > price[4 * at + state] or arc is None:
                price[4 * at + state] = best
                if len(nodes) == 1 and best == _NEVER:
                    return "", state  # no way to the end
                if len(nodes) > 1:
                    nodes.pop()
                    edits.pop()
            elif arc[0] == "":
                return "".join(edits), state
            else:
                edits.append(arc[0])
                nodes.append((at + arc[2], arc[3]))

    def settle(self) -> list[int]:
        """Makes the prices at every `SEGMENT`-th row exact, from the end backwards; those of the first row.

        A segment's prices open from the settled row behind it, where its paths
        end: no path is contracted over more than a segment, and no price has
        far to rise.
        """
        to = None
        for first in range((len(self.rows) - 1) // SEGMENT * SEGMENT, -1, -SEGMENT):
            if to is not None:
                self.start(first, to)
            for state in range(4):
                self.path(first, state, to)
            to = first
        return self.price[:4]


@lru_cache(maxsize=65_536)
def repaired(rows: str) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair of a whole conversation."""
    auction = Auction(rows, FINAL)
    if len(rows) > SEGMENT:
        auction.settle()
    edits, _ = auction.path(0, START)
    return auction.price[START], edits


def crossing(rows: str) -> list[int]:
    """Costs from every role before a run of rows to every role behind it, row by row of the 4 x 4 table.

    USER and ASSISTANT can be reached from any role. Behind a run, START means
    that all was deleted, and SYSTEM that one system row at most was not.
    """
    out = [_NEVER] * 16
    for to in (USER, ASSISTANT):
        prices = Auction(rows, [0 if s == to else _NEVER for s in range(4)], last=False).settle()
        for state in range(4):
            out[4 * state + to] = prices[state]
    gone = DELETE * len(rows)
    out[4 * START + START] = out[4 * SYSTEM + SYSTEM] = gone
    kept = [gone - DELETE + _least(r) for r in rows if r in "sS"]
    out[4 * START + SYSTEM] = min(kept, default=_NEVER)
    return out


def fault(text: str, seen: bool) -> str | None:
    """The first fault of a row."""
    end = text.rstrip(BLANKS)
    return "blank" if not end else "duplicate" if seen else "truncated" if end[-1] not in ENDS else None


def lines(rows: Iterator[tuple[str, str]], edits: Iterator[str], state: int = START) -> Iterator[str]:
    """The role:text lines that `edits` make of `rows`."""
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            yield f"{_ROLE[state]}:"
            continue
        role, text = next(rows)
        if edit == "K":
            state = _KEPT[state, role[0]]
            yield f"{role}:{text}"
        elif edit == "R":
            state = _NEXT[state]
            yield f"{_ROLE[state]}:{text}"


# --- tables ---------------------------------------------------------------------------------


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def plain(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, alive) of every row, as it is."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _text("role").alias("role"), _text("text").alias("text"), F.lit(True).alias("alive"))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, alive): every row of `turns`, damaged by the checksum of its `conv_id:turn`.

    Of 20 remainders, 0 drops the row (alive is false), 1 empties its text, 2
    removes `[.!?]`, 3 repeats it, 4 makes its role user. Null texts and roles
    are one blank, and so is a null conv_id or turn in the checksum.
    """
    rows = plain(turns).withColumn(
        "hit", F.crc32(F.concat_ws(":", _text("conv_id"), _text("turn")).cast("binary")) % 20)
    text = F.when(F.col("hit") == 1, F.lit("")).when(
        F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("hit") != 0).alias("alive"))


_RESULT = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired_sha256", pa.string())])
_COLUMNS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")


def one(conv_id, rows: list[tuple]) -> dict:
    """The result for a conversation's (turn, role, text) rows in order."""
    seen, counts, letters = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
    for _, role, text in rows:
        kind = fault(text, (role, text) in seen)
        seen.add((role, text))
        letters.append(code(role, kind))
        if kind:
            counts[kind] += 1
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = repaired("".join(letters))
    text = "\n".join(lines(((r, t) for _, r, t in rows), iter(audit)))
    return counts | {
        "conv_id": conv_id, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "illegal": sum(a[1][:1] + b[1][:1] not in _LEGAL for a, b in zip(rows, rows[1:])), "cost": cost,
        "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, one result per conversation out; holds one conversation at a time."""
    key, rows, out = None, [], []
    for batch in batches:
        for conv_id, turn, role, text, alive in zip(*[c.to_pylist() for c in batch.columns]):
            if key != (conv_id,):
                if key:
                    out.append(one(*key, rows))
                key, rows = (conv_id,), []
            if alive:
                rows.append((turn, role, text))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
            out = []
    if key:
        yield pa.RecordBatch.from_pylist([one(*key, rows)], schema=_RESULT)


def repair(turns: DataFrame, damage: bool = True, long_rows: int = LONG_ROWS,
           long_chars: int = LONG_CHARS) -> DataFrame:
    """Faults and cheapest repair of every conversation of `turns` (conv_id, turn, role, text).

    With `damage` the rows are damaged first. Rows go by (turn, role, text),
    null turns first; audit holds the initials of the cheapest edits (Keep,
    Rerole, Delete, Insert), the least in ASCII if several cost the same, and
    repaired_sha256 the digest of the `role:text` lines they leave. Defined
    edge cases: a null role or text is one blank; a role counts by its first
    character, and one that is neither s, u nor a can only be reroled or
    deleted; rows without conv_id form one conversation; repeated rows are
    duplicates; a conversation without rows has zeros, an empty audit and the
    digest of nothing; an empty table gives no rows; other columns are ignored.

    Conversations beyond `long_rows` rows or `long_chars` code points are cut
    into pieces that are priced by tasks of their own, see `_long`.
    """
    ship(turns.sparkSession)
    rows = damaged(turns) if damage else plain(turns)
    long = written(rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).where(
        (F.col("n") > long_rows) | (F.col("chars") > long_chars)).select(F.col("conv_id").alias("long_id")), "long")
    if long.isEmpty():
        return _short(rows)
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return _short(rows.join(long, same, "left_anti")).unionByName(
        _long(rows.join(long, same, "left_semi"), long_rows))


def _short(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(_whole, _COLUMNS)


# --- long conversations -----------------------------------------------------------------------


def _pieces(size: int):
    """Narrow sorted rows in; runs of at most `size` rows of one conversation out, as letters and illegal pairs."""
    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("letters", pa.string()),
                        ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, letters, starts, out = None, None, [], [], []

        def done():
            illegal = sum(a + b not in _LEGAL for a, b in zip(starts, starts[1:]))
            out.append({"conv_id": key[0], "piece": piece, "letters": "".join(letters), "illegal": illegal,
                        "first": starts[0], "last": starts[-1]})
        for batch in batches:
            for conv_id, place, start, letter in zip(*[c.to_pylist() for c in batch.columns]):
                if letters and (key != (conv_id,) or len(letters) == size):
                    done()
                    letters, starts = [], []
                if not letters:
                    key, piece = (conv_id,), place
                letters.append(letter)
                starts.append(start)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if letters:
            done()
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([crossing(r) for r in batch.column(2).to_pylist()], pa.list_(pa.int64()))],
            names=["conv_id", "piece", "costs"])


def _borders(group: pd.DataFrame) -> pd.DataFrame:
    """Exact prices behind every piece of a conversation, from the last piece backwards."""
    group = group.sort_values("piece", ascending=False)
    ends, out = list(CLOSING), []
    for costs in group["costs"]:
        out.append(ends if out else list(FINAL))
        ends = [min(int(costs[4 * s + t]) + ends[t] for t in range(4)) for s in range(4)]
        ends = [min(e, _NEVER) for e in ends]
    return pd.DataFrame({"piece": group["piece"], "ends": out,
                         "final": [i == 0 for i in range(len(out))]})


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece and role before it: the edits, their cost to the end, and the role behind."""
    for batch in batches:
        audits, exits, costs = [], [], []
        for letters, ends, last in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)]):
            auction = Auction(letters, ends, last)
            costs.append(list(auction.settle()))
            paths = [auction.path(0, s) for s in range(4)]
            audits.append([p for p, _ in paths])
            exits.append([s for _, s in paths])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(audits, pa.list_(pa.string())),
             pa.array(exits, pa.list_(pa.int32())), pa.array(costs, pa.list_(pa.int64()))],
            names=["conv_id", "piece", "audits", "exits", "costs"])


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The role before every piece of a conversation, and its illegal pairs across the piece's start."""
    group = group.sort_values("piece")
    state, before, entry, illegal = START, None, [], []
    for exits, first, last in zip(group["exits"], group["first"], group["last"]):
        entry.append(state)
        illegal.append(int(before is not None and before + first not in _LEGAL))
        state, before = int(exits[state]), last
    return pd.DataFrame({"piece": group["piece"], "entry": entry, "border": illegal})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows behind the edits of their piece; holds one digest."""
    key, digest, state, edits, some, out = None, None, START, None, False, []

    def put(line):
        nonlocal some
        digest.update((("\n" if some else "") + line).encode())
        some = True
    for batch in batches:
        for conv_id, _, kind, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if key != (conv_id,):
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest, state, some = (conv_id,), hashlib.sha256(), START, False
            if kind == 0:
                edits, state = text, int(role)
                at = 0
                while edits[at:at + 1] == "I":  # also behind the last row
                    state = _NEXT[state]
                    put(f"{_ROLE[state]}:")
                    at += 1
                continue
            edit = edits[at]
            at += 1
            if edit == "K":
                state = _KEPT[state, role[0]]
                put(f"{role}:{text}")
            elif edit == "R":
                state = _NEXT[state]
                put(f"{_ROLE[state]}:{text}")
            while edits[at:at + 1] == "I":
                state = _NEXT[state]
                put(f"{_ROLE[state]}:")
                at += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out])],
                                             names=["conv_id", "repaired_sha256"])
            out = []
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([digest.hexdigest()])],
                                         names=["conv_id", "repaired_sha256"])


def _long(rows: DataFrame, size: int) -> DataFrame:
    """Long conversations, in pieces of `size` rows spread over all tasks.

    Rows are placed by a range partitioning that splits a conversation; the
    first place of every (role, text) tells duplicates. Each piece is priced
    for both ends it can have; the 16 costs of each piece give the exact prices
    at its borders; with those each piece is traced from every role, and the
    roles at the borders choose among the traces. Only the digest of the
    repaired text needs a conversation's rows in one order: they are streamed
    through one task, which holds a row and the edits of a piece.
    """
    alive = rows.where("alive")
    placed = written(alive.withColumn("digest", F.sha2(F.concat("role", F.lit("\0"), "text"), 256)).repartitionByRange(
        rows.sparkSession.sparkContext.defaultParallelism, "conv_id", F.asc_nulls_first("turn"), "role", "text",
        F.monotonically_increasing_id()).sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text").withColumn("place", F.monotonically_increasing_id()), "placed")
    first = placed.groupBy("conv_id", "digest").agg(F.min("place").alias("first_place")).select(
        F.col("conv_id").alias("of_id"), F.col("digest").alias("of_digest"), "first_place")
    end = F.regexp_replace("text", "[\\x20\\x09-\\x0D]+\\z", "")
    kind = F.when(end == "", F.lit("blank")).when(F.col("place") > F.col("first_place"), F.lit("duplicate")).when(
        ~F.substring(end, -1, 1).isin(*ENDS), F.lit("truncated"))
    start = F.substring("role", 1, 1)
    known = F.when(start.isin("s", "u", "a"), start).otherwise(F.lit("o"))
    letter = F.when(F.col("fault").isin("blank", "duplicate"), F.lit("x")).when(
        F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    narrow = written(placed.join(first, F.col("conv_id").eqNullSafe(F.col("of_id")) & (
        F.col("digest") == F.col("of_digest"))).withColumn("fault", kind).select(
        "conv_id", "place", "turn", start.alias("start"), "fault", letter.alias("letter")), "letters")
    pieces = written(narrow.select("conv_id", "place", "start", "letter").repartitionByRange(
        rows.sparkSession.sparkContext.defaultParallelism, "conv_id", "place").sortWithinPartitions(
        "conv_id", "place").mapInArrow(
        _pieces(size), "conv_id long, piece long, letters string, illegal long, first string, last string"), "pieces")
    costs = pieces.select("conv_id", "piece", "letters").mapInArrow(
        _crossings, "conv_id long, piece long, costs array<long>")
    borders = costs.groupBy("conv_id").applyInPandas(
        _borders, "piece long, ends array<long>, final boolean")
    traced = written(pieces.join(borders, "piece").select(
        "conv_id", "piece", "letters", "ends", "final").mapInArrow(
        _traced, "conv_id long, piece long, audits array<string>, exits array<int>, costs array<long>"), "traced")
    entries = traced.join(pieces.select("piece", "first", "last"), "piece").select(
        "conv_id", "piece", "exits", "first", "last").groupBy("conv_id").applyInPandas(
        _entries, "piece long, entry int, border long")
    chosen = written(traced.join(entries, "piece").join(pieces.select("piece", "illegal"), "piece").select(
        "conv_id", "piece", F.col("audits")[F.col("entry")].alias("audit"), "entry",
        (F.col("illegal") + F.col("border")).alias("illegal"), F.col("costs")[0].alias("cost")), "chosen")

    stream = chosen.select("conv_id", F.col("piece").alias("place"), F.lit(0).alias("kind"),
                           F.col("entry").cast("string").alias("role"), F.col("audit").alias("text")).unionByName(
        placed.select("conv_id", "place", F.lit(1).alias("kind"), "role", "text"))
    digests = stream.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind").mapInArrow(
        _digests, "conv_id long, repaired_sha256 string")
    whole = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.min(F.struct("piece", "cost"))["cost"].alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda p: p["audit"]), "").alias(
            "audit"))
    turned = narrow.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)).alias("span"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    several = narrow.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.count("*").alias("turns"))
    out = rows.select("conv_id").distinct()
    for part in (turned, several, whole, digests):
        part = part.withColumnRenamed("conv_id", "of_id")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("of_id")), "left").drop("of_id")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long")
    return out.select(
        "conv_id", (zero("span") - zero("turns")).alias("gaps"),
        *[zero(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
