import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from meterline.llm import conversation_repair as cr, queries
from tests.llm.inputs import SMALL
from tests.oracle_compare import database, differences

SCHEMA = "conv_id long, turn long, role string, text string, audit string, place int"
LETTERS = "suaoSUAOx"


def cheapest(letters: str) -> tuple[int, str]:
    """Least (cost, edits) over all edit strings, by dynamic programming over (rows, grammar state)."""
    never = (10**9, "")
    best = [(0, ""), never, never, never]  # nothing, s, u, a said last

    def add(x, cost, letter):
        return (x[0] + cost, x[1] + letter)

    def inserts(b):
        b = list(b)
        b[2] = min(b[2], add(b[0], 2, "I"), add(b[1], 2, "I"), add(b[3], 2, "I"))
        b[3] = min(b[3], add(b[2], 2, "I"))
        return b
    for c in letters:
        b = inserts(best)
        best = [add(x, 3, "D") for x in b]
        if c != "x":
            t, role = int(c.isupper()), c.lower()
            if role == "s":
                best[1] = min(best[1], add(b[0], t, "K"))
            for s in (0, 1, 3):
                best[2] = min(best[2], add(b[s], 2 + t, "R"), *([add(b[s], t, "K")] if role == "u" else []))
            best[3] = min(best[3], add(b[2], 2 + t, "R"), *([add(b[2], t, "K")] if role == "a" else []))
    b = inserts(best)
    return min(b[0], b[3])


def brute(rows):
    """The whole result in plain Python."""
    out = []
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if hit == 1 else "".join(x for x in text if x not in ".!?") if hit == 2 else text
            after += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, letters = [0, 0, 0], ""
        for i, (_, role, text) in enumerate(after):
            body = text.strip(" \t\n\v\f\r")
            kind = 0 if not body else 1 if any(r[1:] == (role, text) for r in after[:i]) else \
                2 if body[-1] not in ".!?" else None
            if kind is not None:
                counts[kind] += 1
            one = role[0] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if kind in (0, 1) else one.upper() if kind == 2 else one
        cost, audit = cheapest(letters)
        said, text, left = "", [], iter(after)
        for edit in audit:
            following = {"": "user", "s": "user", "u": "assistant", "a": "user"}[said[-1:]]
            if edit == "I":
                said += following[0]
                text.append(following + ":")
                continue
            _, role, words = next(left)
            if edit != "D":
                role = following if edit == "R" else role
                said += role[0]
                text.append(f"{role}:{words}")
        turns = {t for t, _, _ in after if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
                    hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def repaired(spark, rows, **options):
    out = cr.repair(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA), **options)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def awkward():
    rows = [(1, 0, "user", "hi."), (1, 1, "assistant", "so!"), (2, None, "user", None), (2, None, None, "x."),
            (2, 5, "system", "late. \n"), (2, 5, "", "no role?"), (2, 9, "tool", "odd role."), (None, 3, "user", "who?"),
            (None, None, "assistant", "me"), (3, 2**40, "user", "far."), (3, -5, "user", " "), (4, 1, "User", "A."),
            (5, 0, "sys", "kept by its initial."), (5, 1, "user", "a. "), (5, 1, "user", "a. "), (5, 2, "alien", "b?")]
    rows += [(6, i, random.Random(i).choice(["user", "assistant", "system", None]), random.Random(i).choice(
        ["ok.", "ok", "", "long " * 50 + ".", " \t", "é?"]) + (str(i) + "!" if i % 3 else "")) for i in range(150)]
    rows += [(7, i % 3, "user", "same.") for i in range(30)]
    rows += [(100 + i, t, r, f"{i} {t}.") for i in range(60) for t, r in enumerate(["system", "user", "assistant", "user"])]
    return rows


@pytest.mark.parametrize("length", range(5))
def test_every_short_run_of_rows(length):
    for letters in itertools.product(LETTERS, repeat=length):
        letters = "".join(letters)
        assert cr.repaired(letters) == cheapest(letters)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=150), st.integers(1, 40))
def test_prices_of_pieces_join_up(letters, size):
    expected = cheapest(letters)
    assert cr.repaired(letters) == expected
    pieces = [letters[i:i + size] for i in range(0, len(letters), size)]
    ends = [list(cr.CLOSING)]
    for piece in reversed(pieces):
        costs = cr.crossing(piece)
        ends.append([min(cr._NEVER, *(costs[4 * s + t] + ends[-1][t] for t in range(4))) for s in range(4)])
    assert ends[-1][0] == expected[0]
    edits, state = "", cr.START
    ends[0] = list(cr.FINAL)
    for i, piece in enumerate(pieces):
        auction = cr.Auction(piece, ends[len(pieces) - 1 - i], i == len(pieces) - 1)
        auction.settle()
        more, state = auction.path(0, state)
        edits += more
    assert edits == expected[1] or not pieces


def test_a_long_run_of_faults_is_settled_in_linear_time():
    steps = [0]

    class Counted(cr.Auction):
        def arcs(self, at, state):
            steps[0] += 1
            return super().arcs(at, state)
    for n in (2_000, 4_000):
        steps[0] = 0
        auction = Counted("uUuoax" * (n // 6), cr.FINAL)
        auction.settle()
        auction.path(0, cr.START)
        assert steps[0] < 400 * n


@pytest.mark.parametrize("options", [{}, {"long_rows": 7}, {"long_chars": 300, "long_rows": 20}])
def test_awkward_conversations(spark, options):
    assert repaired(spark, awkward(), **options) == brute(awkward())


def test_empty_and_dropped(spark):
    assert repaired(spark, []) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repaired(spark, [(gone, 0, "user", "hi.")]) == [nothing]
    assert repaired(spark, [(gone, 0, "user", "hi.")] * 3, long_rows=2) == [nothing]


def test_without_damage(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "user", "a."), (2, 1, "user", "c.")]
    out = {r[0]: r for r in repaired(spark, rows, damage=False)}
    assert out[1][6:8] == (0, "KK") and out[2][6:8] == (2, "KR")


def test_query_equals_sql(spark):
    df = queries.QUERIES["op12_conversation_repair"](spark, SMALL)
    n, only_spark, only_sql = differences(df, database(SMALL), queries.ORACLE_SQL["op12_conversation_repair"])
    assert not only_spark and not only_sql and df.count() == 20
