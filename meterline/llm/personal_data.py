"""Personal data: fixed kinds by pattern, further identifiers by bootstrapped context.

Spans of the fixed kinds seed the search. Every token with a digit is an
instance, and so are the tokens under one span together; the words around it,
other tokens with digits as a class, are its patterns. A pattern is as credible as the
share of its distinct instances that are credible, an instance as credible as
its best pattern; a few rounds over the distinct pattern-instance edges spread
credibility from the seeds, and patterns above a bar mark the other instances
they hold. Distinct instances count, so copies of a text lend no weight.
Everything is DataFrame code.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import let, text_or_empty, written

#: Fixed patterns, in the order of the kinds. Look-behinds and \G only spare
#: starts that cannot match, so that each scan is linear in the text.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: A token of five or more characters with a digit, tried at the start of each token only.
TOKEN = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]{5})[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
BLANKS = r"[\x20\x09-\x0D]+"
MIN_SUPPORT, MIN_CONFIDENCE, ROUNDS = 4, 0.8, 3
#: Matches of a text that are gathered at a time.
RUN = 256
_EDGE = r"^[^\p{L}\p{N}+(]+"


def _located(pattern: str) -> Column:
    """Matches of `pattern` in `__op_text` as structs (start, end, value, before, after), in code points."""
    hits = F.regexp_extract_all("__op_text", F.lit(pattern), F.lit(0))
    gaps = F.split("__op_text", pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.expr(
        "cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>)").alias("out"))

    def step(acc, i):
        def body(g):
            gap, hit, nxt = g["g"][i], g["h"][i], g["g"][i + 1]
            start = acc["at"] + F.length(gap)
            end = start + F.length(hit)
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
                start.alias("start"), end.alias("end"), hit.alias("value"), gap.alias("before"),
                nxt.alias("after")))).alias("out"))
        return body

    def joined(acc, c):
        moved = F.transform(c["out"], lambda m: F.struct(
            (m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["value"].alias("value"),
            m["before"].alias("before"), m["after"].alias("after")))
        return F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def build(parts):
        # Appending copies the list so far, so matches are gathered in runs, and then the runs.
        n = F.size(parts["h"])
        runs = F.transform(F.sequence(F.lit(0), n - 1, F.lit(RUN)), lambda s: F.aggregate(
            F.sequence(s, F.least(s + RUN, n) - 1), zero, lambda acc, i: step(acc, i)(parts)))
        start = F.struct(F.lit(0).alias("at"), F.expr(
            "cast(array() as array<array<struct<start:int,end:int,value:string,before:string,after:string>>>)").alias("out"))
        return F.aggregate(runs, start, joined, lambda acc: F.flatten(acc["out"]))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>)")
    return let(hits, lambda h: F.when(F.size(h) == 0, empty).otherwise(
        let(F.struct(h.alias("h"), gaps.alias("g")), build)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(plain) <= 3) & F.coalesce(plain.try_cast("int") <= 255, F.lit(False))


_VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), _small),
    "card": lambda v: let(_digits(v), lambda d: F.length(d).between(13, 19) & F.coalesce(F.call_function("luhn_check", d), F.lit(False))),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}
#: A text without this character has no match of the kind.
_GATE = {"email": "@", "phone": "+", "ip": "."}


def _base(kind: str, pattern: str) -> Column:
    found = F.transform(
        F.filter(_located(pattern), lambda m: _VALID[kind](m["value"])),
        lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    if kind in _GATE:
        empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
        found = F.when(F.contains(F.col("__op_text"), F.lit(_GATE[kind])), found).otherwise(empty)
    return found


def base_spans(text: str = "__op_text") -> Column:
    """Spans of the fixed kinds, by kind as listed and then by start."""
    assert text == "__op_text"
    return F.concat(*[_base(k, p) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE))])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _counted(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _words(part: Column) -> Column:
    """The words of a text in lower case, those with digits as one class."""
    return F.transform(F.filter(F.split(F.lower(part), BLANKS), lambda w: w != ""),
                       lambda w: F.when(w.rlike("[0-9]"), "#").otherwise(w))


def _word(parts: Column, place: int) -> Column:
    return F.coalesce(F.try_element_at(parts, F.lit(place)), F.lit(""))


def _occurrences() -> Column:
    """Tokens with digits: trimmed value and place, place in full, and the line around, two words at least."""
    def one(hits):
        def body(m, i):
            back, far, ahead = F.get(hits, i - 1), F.get(hits, i - 2), F.get(hits, i + 1)
            lead = F.length(m["value"]) - F.length(F.regexp_replace(m["value"], _EDGE, ""))
            value = F.regexp_replace(F.regexp_replace(m["value"], _EDGE, ""), r"[^\p{L}\p{N})]+$", "")
            none = F.lit("")
            return F.struct(
                (m["start"] + lead).alias("start"), (m["start"] + lead + F.length(value)).alias("end"),
                value.alias("value"), m["start"].alias("from"), m["end"].alias("to"),
                F.concat(F.coalesce(far["value"], none), F.coalesce(back["before"], none),
                         F.coalesce(back["value"], none), m["before"]).alias("before"),
                F.concat(m["after"], F.coalesce(ahead["value"], none)).alias("after"))
        return F.transform(hits, body)
    return F.filter(let(_located(TOKEN), one), lambda o: F.length(o["value"]) >= 5)


def _instance(first: Column, last: Column, value: Column, start: Column, end: Column, seed: bool) -> Column:
    """An instance from `first` to `last` token, whose context lies outside of `start` to `end`."""
    inner, outer = F.greatest(first["from"] - start, F.lit(0)), F.greatest(end - last["to"], F.lit(0))
    before = F.substring(first["before"], F.lit(1), F.length(first["before"]) - inner)
    after = F.substring(last["after"], outer + 1, F.length(last["after"]))
    around = F.struct(_words(F.substring_index(before, "\n", -1)).alias("b"),
                      _words(F.substring_index(after, "\n", 1)).alias("a"))
    patterns = let(around, lambda w: F.array(
        F.concat(_word(w["b"], -2), F.lit(" "), _word(w["b"], -1), F.lit(" _")),
        F.concat(_word(w["b"], -1), F.lit(" _ "), _word(w["a"], 1))))
    return F.struct(first["start"].alias("start"), last["end"].alias("end"), value.alias("value"),
                    F.filter(patterns, lambda p: p.rlike(r"\p{L}")).alias("patterns"), F.lit(seed).alias("seed"))


def _leading(items: Column, holds) -> Column:
    """How many of the sorted `items` come before the first that does not meet `holds`, by halving."""
    start = F.struct(F.lit(0).alias("lo"), F.size(items).alias("hi"))
    halvings = F.sequence(F.lit(1), F.ceil(F.log2(F.size(items) + 1)).cast("int") + 1)

    def halve(a, _):
        middle = ((a["lo"] + a["hi"]) / 2).cast("int")
        return let(middle, lambda m: F.when(a["lo"] >= a["hi"], a).when(
            holds(F.get(items, m)), F.struct((m + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(
            F.struct(a["lo"].alias("lo"), m.alias("hi"))))
    return F.aggregate(halvings, start, halve, lambda a: a["lo"])


def _instances(parts: Column) -> Column:
    """The tokens of `parts.found` under each span of `parts.base` as one seed, and the other tokens one by one.

    Tokens lie in order and apart, so those under a span are a slice of them.
    """
    found = parts["found"]
    groups = F.filter(F.transform(parts["base"], lambda b: F.struct(
        b["start"].alias("start"), b["end"].alias("end"),
        _leading(found, lambda o: o["end"] <= b["start"]).alias("lo"),
        _leading(found, lambda o: o["start"] < b["end"]).alias("hi"))), lambda g: g["lo"] < g["hi"])

    def build(g):
        seeds = F.transform(g, lambda s: _instance(
            F.get(found, s["lo"]), F.get(found, s["hi"] - 1),
            F.array_join(F.transform(F.slice(found, s["lo"] + 1, s["hi"] - s["lo"]), lambda o: o["value"]), " "),
            s["start"], s["end"], True))
        under = F.flatten(F.transform(g, lambda s: F.sequence(s["lo"], s["hi"] - 1)))
        others = F.array_except(F.sequence(F.lit(0), F.size(found) - 1), under)
        return F.concat(seeds, F.transform(others, lambda i: let(F.get(found, i), lambda o: _instance(
            o, o, o["value"], o["from"], o["to"], False))))
    return F.when(F.size(found) > 0, let(groups, build))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, occurrences) of every row, in one pass without a shuffle."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("__op_text"))
    d = d.select("doc_id", F.xxhash64("__op_text").alias("text_key"), base_spans().alias("base"),
                 F.when(F.col("__op_text").rlike("[0-9]"), _occurrences()).alias("found"))
    return d.select("doc_id", "text_key", "base", let(F.struct("base", "found"), _instances).alias("occurrences"))


def credible_patterns(edges: DataFrame, min_support: int = MIN_SUPPORT,
                      min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence) above the bar, from distinct edges (pattern, value, seed)."""
    edges = written(edges, "edges")
    scores = edges.select("pattern", "value", F.col("seed").cast("double").alias("score"))
    for _ in range(rounds):
        patterns = scores.groupBy("pattern").agg(
            F.sum("score").alias("support"), (F.sum("score") / (F.count("*") + 1)).alias("confidence")).where(
            (F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
        patterns = written(patterns, "patterns")
        reached = edges.where("not seed").join(patterns, "pattern").groupBy("value").agg(
            F.max("confidence").alias("reached"))
        scores = edges.join(reached, "value", "left").select(
            "pattern", "value", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("reached", F.lit(0.0))).alias("score"))
    return patterns.select("pattern", "confidence")


def discovered(scanned: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text_key, extra): spans of kind `context` that credible patterns mark."""
    seen = scanned.select("doc_id", "text_key", F.explode("occurrences").alias("o")).select(
        "doc_id", "text_key", "o.start", "o.end", "o.value", "o.seed", F.explode("o.patterns").alias("pattern"))
    edges = seen.groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    patterns = credible_patterns(edges, min_support, min_confidence, rounds)
    return seen.where("not seed").join(patterns, "pattern").groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct(
            F.lit("context").alias("kind"), "start", "end"))).alias("extra"))


def find(docs: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, counts of the fixed kinds, base_sha256, spans) for every row of `docs`.

    spans lists `kind:start:end` in code points, the fixed kinds first, then
    the discovered ones (`context`). A null or empty text has none; repeated
    rows are each reported; null doc_ids are carried along; other columns are
    ignored; an empty table gives no rows.
    """
    scanned = written(scan(docs), "scanned")
    extra = discovered(scanned, min_support, min_confidence, rounds).select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "extra")
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    joined = scanned.join(extra, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left")
    return joined.select(
        "doc_id",
        *[_counted(k) for k in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", F.coalesce("extra", none))).alias("spans"))


def redact(docs: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
           rounds: int = ROUNDS) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets, and n_chars to match.

    Overlapping spans are replaced together, named after the first. Null texts
    stay null. All columns are kept.
    """
    scanned = written(scan(docs), "scanned")
    extra = discovered(scanned, min_support, min_confidence, rounds).select(
        F.col("doc_id").alias("__op_d"), F.col("text_key").alias("__op_t"), F.col("extra").alias("__op_extra"))
    d = docs.withColumn("__op_text", text_or_empty())
    d = d.withColumn("__op_base", base_spans())
    d = d.join(extra, F.col("doc_id").cast("long").eqNullSafe(F.col("__op_d"))
               & (F.xxhash64("__op_text") == F.col("__op_t")), "left")
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    spans = F.array_sort(F.transform(F.concat("__op_base", F.coalesce("__op_extra", none)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        lead = F.when(fresh, F.concat(
            F.substring(F.col("__op_text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        ).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], lead).alias("out"))

    def run(acc, first):
        # Appending copies the text so far, so it is built in runs of spans.
        part = F.aggregate(F.slice("__op_spans", first, RUN), F.struct(acc["at"].alias("at"), F.lit("").alias("out")), step)
        return let(part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))
    text = F.aggregate(
        F.sequence(F.lit(1), F.size("__op_spans"), F.lit(RUN)),
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")), run,
        lambda acc: F.concat(F.array_join(acc["out"], ""),
                             F.substring(F.col("__op_text"), acc["at"] + 1, F.length("__op_text"))))
    d = d.withColumn("__op_spans", spans)
    d = d.withColumn("__op_new", F.when(F.size("__op_spans") == 0, F.col("__op_text")).otherwise(text))
    changed = F.col("text").isNotNull() & (F.col("__op_new") != F.col("__op_text"))
    out = {"text": F.when(changed, F.col("__op_new")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(changed, F.length("__op_new").cast(kind)).otherwise(F.col("n_chars"))
    return d.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
