"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses. Weighted acceptors over the characters of a word
(`Spelling`) rewrite it to a symbol: an insult, with the largest weight of the
arcs on its way, a threat, a target, a negation, a verb of saying, or another
word. Three transducers over symbols (negation with a limited scope, reported
speech, target) are composed into one machine that rewrites each insult or
threat to the pattern it stands in, such as a targeted, a negated or a reported
insult; a second machine reads the clause from its end for targets that follow.
A document is scored by the weights of the patterns its clauses match, never by
a word outside of them.

The insult lexicon (words and word beginnings) and the pattern weights are
learned from labelled documents; the words of the other classes are listed.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import text_or_empty, written

#: Labelled rows that lexicon and weights are learned from, at most: those with
#: the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
#: Evidence for a lexicon entry: least share of toxic groups among those that
#: hold it, and least log-likelihood ratio against the base rate.
LEAST_SHARE, LEAST_RATIO = 0.9, 18.0
PREFIX_CHARS = (4, 5, 6, 7, 8)
NEGATION_SCOPE = 3

#: Closed classes in the four languages of the texts.
WORDS = {
    "T": "kill killing hurt beat destroy shoot stab burn tuer tuerai frapper matar mataré golpear töten umbringen "
         "schlagen verletzen",
    "Y": "you your yours yourself u he she they him her them his their du dich dir dein deine euch ihr sie er tu toi te "
         "vous votre ton il elle eux tú usted ustedes vosotros él ella ellos",
    "N": "not no never neither nor isn aren wasn don doesn didn nicht kein keine keinen nie niemals pas jamais aucun "
         "aucune nunca jamás ningún ninguna",
    "R": "said says say told tells wrote writes reported quoted claims claimed called sagte sagt schrieb berichtete "
         "dit disait écrit dijo dice escribió",
}
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """A machine over symbols: `step(state, symbol)` gives (state, output); `states[0]` is its start."""
    states: tuple
    step: object

    def table(self, symbols: tuple[str, ...]) -> dict:
        return {(s, x): self.step(s, x) for s in self.states for x in symbols}


def negation(scope: int) -> Transducer:
    """Marks an insult or threat at most `scope` words behind a negation with `n`."""
    def step(state, symbol):
        if symbol[0] == "N":
            return scope, symbol
        return max(0, state - 1), symbol + "n" if symbol[0] in "IT" and state else symbol
    return Transducer(tuple(range(scope + 1)), step)


def reported() -> Transducer:
    """Marks insults and threats behind a verb of saying in the same clause with `r`."""
    def step(state, symbol):
        state = state or symbol[0] == "R"
        return state, symbol + "r" if symbol[0] in "IT" and state else symbol
    return Transducer((False, True), step)


def targeted() -> Transducer:
    """Marks insults and threats behind a person in the same clause with `y`."""
    def step(state, symbol):
        state = state or symbol[0] == "Y"
        return state, symbol + "y" if symbol[0] in "IT" and state else symbol
    return Transducer((False, True), step)


def targeted_behind() -> Transducer:
    """Read from the end of the clause: marks what stands before a person, unless it is marked, with `y`."""
    def step(state, symbol):
        state = state or symbol[0] == "Y"
        return state, symbol + "y" if symbol[0] in "IT" and state and symbol[-1] != "y" else symbol
    return Transducer((False, True), step)


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The machine that hands each output of `first` to `second`."""
    def step(state, symbol):
        a, middle = first.step(state[0], symbol)
        b, out = second.step(state[1], middle)
        return (a, b), out
    return Transducer(tuple((a, b) for a in first.states for b in second.states), step)


GRAMMAR = composed(composed(negation(NEGATION_SCOPE), reported()), targeted())
SYMBOLS = ("I", "T", "Y", "N", "R", "o")
TABLE = GRAMMAR.table(SYMBOLS)
START = GRAMMAR.states[0]
#: Every pattern an insult or threat can be rewritten to, in a fixed order.
PATTERNS = tuple(h + n + r + y for h in "IT" for n in ("", "n") for r in ("", "r") for y in ("", "y"))
FEATURES = PATTERNS + ("any",)
BEHIND = targeted_behind().table(SYMBOLS + PATTERNS)


class Spelling:
    """A weighted acceptor over characters, as a trie.

    `=word` entries give their weight to the arc that ends the word, the others
    to the arc of their last character, after which any characters follow. The
    weight of a word is the largest on its way, 0 if it meets none.
    """

    def __init__(self, entries: dict[str, float]):
        self.arcs: list[dict[str, int]] = [{}]
        self.passing, self.ending = [0.0], [0.0]
        for entry, weight in entries.items():
            node = 0
            for char in entry.removeprefix("="):
                if char not in self.arcs[node]:
                    self.arcs[node][char] = len(self.arcs)
                    self.arcs.append({})
                    self.passing.append(0.0)
                    self.ending.append(0.0)
                node = self.arcs[node][char]
            at = self.ending if entry.startswith("=") else self.passing
            at[node] = max(at[node], weight)

    def weight(self, word: str) -> float:
        node, best = 0, 0.0
        for char in word:
            node = self.arcs[node].get(char)
            if node is None:
                return best
            best = max(best, self.passing[node])
        return max(best, self.ending[node])


CLOSED = {symbol: Spelling({"=" + w: 1.0 for w in words.split()}) for symbol, words in WORDS.items()}


class Lexicon(dict):
    """Word -> (symbol, weight) by the acceptors, insults first; filled as words are met, bounded."""

    def __init__(self, insults: dict[str, float], entries: int = 500_000):
        super().__init__()
        self.entries = entries
        self.acceptors = {"I": Spelling(insults)} | CLOSED

    def __missing__(self, word: str):
        found = ("o", 0.0)
        for symbol, acceptor in self.acceptors.items():
            weight = acceptor.weight(word)
            if weight > 0:
                found = (symbol, weight)
                break
        if len(self) >= self.entries:
            self.clear()
        self[word] = found
        return found


def matches(text: str, lexicon: Lexicon) -> Iterator[tuple[str, float]]:
    """(pattern, weight) of every insult and threat in its clause."""
    for clause in _CLAUSE.split(text.lower()):
        words = [lexicon[w] for w in _WORD.findall(clause)]
        if not any(s in "IT" for s, _ in words):
            continue
        state, marked = START, []
        for symbol, weight in words:
            state, out = TABLE[state, symbol]
            marked.append((out, weight))
        state, found = False, []
        for symbol, weight in reversed(marked):
            state, out = BEHIND[state, symbol]
            if out[0] in "IT":
                found.append((out, weight))
        yield from reversed(found)


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Weight per pattern, each clause match added and the sum damped; the last tells whether any matched."""
    sums = dict.fromkeys(PATTERNS, 0.0)
    for pattern, weight in matches(text, lexicon):
        sums[pattern] += weight
    damped = [math.log1p(v) for v in sums.values()]
    return damped + [float(any(damped))]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic, same) of at most `rows` labelled documents outside the held-out fold; one text of each doc_id.

    `same` is shared by most copies of a text (two minimum hashes of its long
    words), so that a text in many copies counts as few pieces of evidence.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) >= 5)
    return picked.select("text", "toxic", words.alias("words")).select(
        "text", "toxic", F.xxhash64(
            F.array_min(F.transform("words", lambda w: F.xxhash64(w))),
            F.array_min(F.transform("words", lambda w: F.xxhash64(w, F.lit(1))))).alias("same"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Insult words (`=word`) and beginnings, with weights in (0, 1].

    Evidence are groups of alike documents that hold an entry. Since `rows` are
    bounded and an entry takes several groups, so is the result.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) >= 4)
    exact = F.transform(words, lambda w: F.concat(F.lit("="), w))
    starts = [F.transform(F.filter(words, _longer(k)), _start(k)) for k in PREFIX_CHARS]
    held = rows.select("toxic", "same", F.explode(F.array_distinct(F.concat(exact, *starts))).alias("entry"))
    groups = rows.groupBy("same").agg(F.max("toxic").alias("toxic"))
    total, toxic = groups.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic or toxic == total:
        return {}
    counts = held.groupBy("entry", "same").agg(F.min("toxic").alias("toxic")).groupBy("entry").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("k"))
    rate = toxic / total
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    ratio = 2 * (k * F.log(F.greatest(k, F.lit(1e-9)) / (n * rate))
                 + (n - k) * F.log(F.greatest(n - k, F.lit(1e-9)) / (n * (1 - rate))))
    found = counts.where((k / n >= LEAST_SHARE) & (ratio >= LEAST_RATIO)).select("entry", (k / n).alias("weight")).collect()
    return {r["entry"]: float(r["weight"]) for r in found}


def _longer(size: int):
    return lambda w: F.length(w) > size


def _start(size: int):
    return lambda w: F.substring(w, 1, size)


@dataclass(frozen=True)
class Model:
    insults: dict
    weights: tuple[float, ...]
    bias: float

    def score(self, values: list[float]) -> float:
        z = self.bias + sum(w * v for w, v in zip(self.weights, values))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _featurize(insults: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(insults)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(t.as_py() or "", lexicon) for t in batch.column(0)], pa.list_(pa.float64())),
                 batch.column(1)], names=["values", "label"])
    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and pattern weights from labels (doc_id, toxic) outside the held-out fold."""
    rows = written(_training_rows(docs, labels, sample_rows), "labelled")
    insults = learn_lexicon(rows)
    examples = rows.select("text", F.col("toxic").cast("double").alias("label")).mapInArrow(
        _featurize(insults), "values array<double>, label double")
    if examples.select("label").distinct().count() < 2:
        return Model(insults, (0.0,) * len(FEATURES), -4.0)
    fit = LogisticRegression(regParam=1e-3, maxIter=60, standardization=False).fit(
        examples.select(array_to_vector("values").alias("features"), "label"))
    return Model(insults, tuple(float(w) for w in fit.coefficients), float(fit.intercept))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        lexicon = Lexicon(m.insults)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m.score(features(t.as_py() or "", lexicon)) for t in batch.column(1)],
                                           pa.float64())], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    The score needs the text alone. A null or empty text has the score of a
    text without a match. Null and repeated doc_ids are carried along (a null
    one is not held out); labels that repeat a document count once, as toxic if
    any is; without labels of both kinds no text is judged toxic; other columns
    are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(_score(model), "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keep(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        lexicon = Lexicon(m.insults)
        at = names.index("text")
        for batch in batches:
            good = [m.score(features(t.as_py() or "", lexicon)) < 0.5 for t in batch.column(at)]
            yield batch.filter(pa.array(good, pa.bool_()))
    return run


def acceptable(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of `docs` that are not judged toxic, with all their columns; no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))
    return docs.mapInArrow(_keep(model, docs.columns), docs.schema)
