"""Chat formatting by a state machine over roles, with a loss flag per segment."""
from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import ship, written


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, which roles may follow which, and whose text is trained on.

    `{role}` in `before` stands for the escaped role. `follows` maps a state (a
    role, or "" for the start) to the roles allowed next; a conversation may
    end after a role of `ends`. `reserved` lists strings that must not occur in
    a text as they are; the template's own marks are reserved as well. A
    template that cannot be read back (no `{role}` with something behind it, no
    closing mark, a backslash in a mark) is refused with a ValueError.
    """
    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)})
    ends: tuple[str, ...] = ("assistant",)
    reserved: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")


DEFAULT = Template()
#: Characters of a formatted row; a longer conversation continues in further rows.
PART_CHARS = 4_000_000
#: Codes behind the backslash that are taken where they are free.
_CODES = {"<": "l", "[": "b", "\n": "n"}


def _overlaps_itself(mark: str) -> bool:
    return any(mark.startswith(mark[k:]) for k in range(1, len(mark)))


class Marks:
    """Escaping and parsing under a template.

    The first character of a reserved string in a text becomes a backslash and
    a code. No reserved string begins with a code or holds a backslash, so none
    can arise from the escapes.
    """

    def __init__(self, template: Template):
        head, hole, tail = template.before.partition("{role}")
        if not (hole and tail and template.after):
            raise ValueError("a template needs {role}, something behind it, and a closing mark")
        reserved = {r for r in (*template.reserved, head, template.after) if r}
        if _overlaps_itself(template.after):
            reserved.add(template.after[0])  # the end of a text and the mark could form an earlier mark
        in_role = {"\n", tail[0]}
        if any("\\" in r for r in reserved | in_role):
            raise ValueError("marks and reserved strings must not hold a backslash")
        firsts = {r[0] for r in reserved | in_role}
        self._codes = {"\\": "\\"} | {c: k for c, k in _CODES.items() if c in firsts and k not in firsts}
        free = (k for k in string.ascii_letters + string.digits if k not in firsts and k not in _CODES.values())
        for char in sorted(firsts - self._codes.keys()):
            code = next(free, None)
            if code is None:
                raise ValueError("too many reserved strings to escape")
            self._codes[char] = code
        starts = "|".join(re.escape(r) for r in sorted(reserved, key=len, reverse=True))
        self._hide = re.compile(rf"\\|(?=(?:{starts})).", re.S)
        self._in_role = re.compile("[" + "".join(map(re.escape, sorted(in_role))) + "]")
        self._show = re.compile(r"\\(.?)", re.S)
        self._decode = {code: char for char, code in self._codes.items()}
        self.turn = re.compile(re.escape(head) + r"([^\n]*?)" + re.escape(tail) + r"(.*?)" + re.escape(template.after),
                               re.S)

    def escaped(self, text: str) -> str:
        """No reserved string is left; every change is undone by `plain`."""
        return self._hide.sub(lambda m: "\\" + self._codes[m.group()], text)

    def role(self, role: str) -> str:
        """Escaped, and without line breaks and whatever begins the mark behind it."""
        return self._in_role.sub(lambda m: "\\" + self._codes[m.group()], self.escaped(role))

    def plain(self, text: str) -> str:
        """Undoes `escaped` and `role`; raises ValueError at a code that they do not write."""
        def shown(m):
            if m.group(1) not in self._decode:
                raise ValueError(f"text with the code {m.group(1)!r} cannot be read back")
            return self._decode[m.group(1)]
        return self._show.sub(shown, text)


def segments(role: str, text: str, template: Template, marks: Marks) -> list[tuple[str, bool]]:
    """(text, loss) of one turn: opening mark, body, closing mark."""
    return [(template.before.replace("{role}", marks.role(role)), False),
            (marks.escaped(text), role in template.loss_roles), (template.after, False)]


_FORMATTED = ("conv_id long, part long, last boolean, formatted string, "
              "loss array<struct<start:long,end:long>>, n_turns long, valid boolean, first_error long")


def _format(template: Template, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(template)
        rows, state = [], None

        def row(last: bool) -> dict:
            error = state["error"]
            if last and error is None and state["role"] not in template.ends:
                error = state["n"]
            return {"conv_id": state["id"], "part": state["part"], "last": last, "formatted": "".join(state["out"]),
                    "loss": state["loss"], "n_turns": state["n"], "valid": error is None, "first_error": error}

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(rows, schema=_arrow())
            rows.clear()
            return batch
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state is None or state["id"] != conv:
                    if state is not None:
                        rows.append(row(True))
                    state = {"id": conv, "part": 0, "n": 0, "size": 0, "out": [], "loss": [], "role": "", "error": None}
                elif state["size"] >= part_chars:
                    rows.append(row(False))
                    state.update(part=state["part"] + 1, size=0, out=[], loss=[])
                if state["error"] is None and role not in template.follows.get(state["role"], ()):
                    state["error"] = state["n"]
                for body, loss in segments(role or "", text or "", template, marks):
                    if loss:
                        state["loss"].append({"start": state["size"], "end": state["size"] + len(body)})
                    state["out"].append(body)
                    state["size"] += len(body)
                state["role"] = role or ""
                state["n"] += 1
                if len(rows) >= 200 or rows and state["size"] >= part_chars:
                    yield flush()
        if state is not None:
            rows.append(row(True))
        if rows:
            yield flush()
    return run


def _arrow() -> pa.Schema:
    return pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int64()), ("last", pa.bool_()), ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("n_turns", pa.int64()), ("valid", pa.bool_()), ("first_error", pa.int64())])


def format_conversations(turns: DataFrame, template: Template = DEFAULT, part_chars: int = PART_CHARS) -> DataFrame:
    """One formatted row per conversation of `turns` (conv_id, turn, role, text).

    loss holds the [start, end) ranges of `formatted`, in code points, to train
    on. valid tells whether the state machine accepts the order of roles, and
    first_error the position of the first turn it does not (the number of turns
    if only the end is wrong); rejected orders are formatted all the same.

    Turns of a conversation are streamed in the order of (turn, role, text), so
    memory holds one part: a conversation beyond `part_chars` goes on in rows
    with part 1, 2, …, of which the final one has last = true and the counts. A
    null text or role is empty, an unknown role is an error; rows without
    conv_id form one conversation; repeated rows are turns of their own; other
    columns are ignored; an empty table gives no rows.
    """
    Marks(template)
    ship(turns.sparkSession)
    base = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"), F.col("turn").alias("turn"))
    ordered = base.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format(template, part_chars), _FORMATTED)


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(template)
        state = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["part"] == 0:
                    state = {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "chars": 0, "size": 0}
                at = 0
                for m in marks.turn.finditer(r["formatted"]):
                    if m.start() != at:
                        raise ValueError(f"conversation {r['conv_id']} cannot be read back at {at}")
                    at = m.end()
                    role, text = marks.plain(m.group(1)), marks.plain(m.group(2))
                    state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    state["n"] += 1
                if at != len(r["formatted"]):
                    raise ValueError(f"conversation {r['conv_id']} cannot be read back at {at}")
                for span in r["loss"]:
                    text = marks.plain(r["formatted"][span["start"]:span["end"]])
                    state["loss"].update(text.encode("utf-8", "surrogatepass"))
                    state["chars"] += len(text)
                state["size"] += len(r["formatted"])
                if r["last"]:
                    rows.append({
                        "conv_id": r["conv_id"], "n_turns": state["n"], "turns_sha256": state["turns"].hexdigest(),
                        "loss_chars": state["chars"], "loss_sha256": state["loss"].hexdigest(),
                        "formatted_chars": state["size"], "valid": r["valid"], "first_error": r["first_error"]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                ("valid", pa.bool_()), ("first_error", pa.int64())]))
    return run


_DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long, valid boolean, first_error long")


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests of turns and trained text, parsed out of formatted rows.

    Rows that are whole conversations are read where they lie; parts of longer
    ones are brought together and streamed in order. Raises ValueError at text
    that the template cannot have produced.
    """
    ship(formatted.sparkSession)
    whole = formatted.where("part = 0 and last")
    parts = formatted.where("not (part = 0 and last)").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.mapInArrow(_read(template), _DIGESTS).unionByName(parts.mapInArrow(_read(template), _DIGESTS))


def written_and_read(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Formats `turns` into a table of the shared folder and reads the digests back from it."""
    return read_back(written(format_conversations(turns, template), "formatted"), template)
