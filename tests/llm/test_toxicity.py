import math
import random
from zlib import crc32

from pyspark.sql import functions as F
import pytest

from meterline.llm import toxicity as t
from tests.llm.inputs import awkward, documents

SF = "/root/testdata/sf0.01"
LEX = {"=fool": 1.0, "rott": 0.9}


def patterns(text):
    return [p for p, _ in t.matches(text, t.Lexicon(LEX))]


@pytest.mark.parametrize("text,found", [
    ("what a fool", ["I"]), ("you are a fool", ["Iy"]), ("not a fool", ["In"]), ("you are not a fool", ["Iny"]),
    ("he said a fool", ["Iry"]), ("it says fool", ["Ir"]), ("not one two three four fool", ["I"]),
    ("you. fool", ["I"]), ("no, rotten and rotter", ["In", "In"]), ("I kill time", ["T"]), ("she will kill you", ["Ty"]),
    ("never kill", ["Tn"]), ("foolish", []), ("", []), ("FOOL!", ["I"])])
def test_clauses_are_rewritten_in_context(text, found):
    assert patterns(text) == found


def test_composition_equals_the_machines_in_turn():
    parts = [t.negation(t.NEGATION_SCOPE), t.reported(), t.targeted()]
    words = ["N", "o", "I", "R", "T", "Y", "I", "o", "o", "o", "I"]
    states, single = [m.states[0] for m in parts], []
    for symbol in words:
        for k, m in enumerate(parts):
            states[k], symbol = m.step(states[k], symbol)
        single.append(symbol)
    state, out = t.START, []
    for symbol in words:
        state, symbol = t.TABLE[state, symbol]
        out.append(symbol)
    assert out == single and set(out) - set(t.SYMBOLS) <= set(t.PATTERNS)


def test_targets_count_on_either_side():
    assert patterns("fool, you") == ["Iy"] and patterns("not a fool, are you") == ["Iny"]
    assert patterns("fool. you") == ["I"] and patterns("fool you fool") == ["Iy", "Iy"]


def test_spelling_takes_the_largest_weight_on_the_way():
    machine = t.Spelling({"=ab": 0.5, "abc": 0.7, "abcd": 0.2, "=abcde": 0.9, "b": 0.1})
    assert [machine.weight(w) for w in ("", "a", "ab", "abx", "abc", "abcd", "abcdx", "abcde", "b", "bb", "c")] == [
        0, 0, 0.5, 0, 0.7, 0.7, 0.7, 0.9, 0.1, 0.1, 0]


def test_scores_equal_a_plain_reading_of_the_clauses():
    """Brute force: every insult and threat judged by looking at the words of its clause."""
    rng, closed = random.Random(8), {s: set(w.split()) for s, w in t.WORDS.items()}
    words = ["fool", "rotten", "kill", "you", "not", "said", "plain", "word", "rot", "foolish"]
    model = t.Model(LEX, tuple(rng.uniform(-1, 2) for _ in t.FEATURES), -0.5)
    for _ in range(300):
        clauses = [[rng.choice(words) for _ in range(rng.randrange(9))] for _ in range(rng.randrange(4))]
        sums = dict.fromkeys(t.PATTERNS, 0.0)
        for clause in clauses:
            for i, word in enumerate(clause):
                weight = 1.0 if word == "fool" else 0.9 if word.startswith("rott") else 0.0
                head = "I" if weight else "T" if word in closed["T"] else ""
                if head:
                    negated = any(w in closed["N"] for w in clause[max(0, i - t.NEGATION_SCOPE):i])
                    said = any(w in closed["R"] for w in clause[:i])
                    aimed = any(w in closed["Y"] for w in clause)
                    sums[head + "n" * negated + "r" * said + "y" * aimed] += weight or 1.0
        values = [math.log1p(v) for v in sums.values()] + [float(any(sums.values()))]
        z = model.bias + sum(w * v for w, v in zip(model.weights, values))
        text = ". ".join(" ".join(c) for c in clauses)
        assert model.score(t.features(text, t.Lexicon(LEX))) == pytest.approx(1 / (1 + math.exp(-z)))


def test_held_out_accuracy(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r["doc_id"]: r for r in t.score(docs, labels).collect()}
    assert len(scores) == docs.count()
    assert all(r["held_out"] == (crc32(str(i).encode()) % 5 == 0) for i, r in scores.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scores.values())
    fold = [(r["toxic"], scores[r["doc_id"]]["predicted"]) for r in labels.collect() if scores[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in fold) >= 0.93 * len(fold)
    assert not any(b and not a for a, b in fold)


def test_held_out_labels_are_never_read(spark):
    docs, labels = documents(spark), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = labels.withColumn("toxic", F.when(t.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r["doc_id"]: r["score"] for r in t.score(docs, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in t.score(docs, other).collect()}
    assert one == two


def test_awkward_documents(spark):
    rng = random.Random(4)

    def prose():
        return " ".join("".join(rng.choices("aeioulnrst", k=8)) for _ in range(12))
    toxic = [(1000 + i, f"{prose()} you wretchling {prose()}") for i in range(60)]
    clean = [(2000 + i, f"{prose()} you gentle {prose()}") for i in range(200)]
    docs = spark.createDataFrame(toxic + clean, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, "x") for i, _ in toxic] + [(i, 0, "x") for i, _ in clean]
                                   + [(None, 1, "x"), (5, None, "x"), (1000, 1, "x")], "doc_id long, toxic int, text string")
    mixed = docs.unionByName(awkward(spark, extra=False).select("doc_id", "text")).withColumn("score", F.lit("clash"))
    scores = t.score(mixed, labels).collect()
    assert len(scores) == mixed.count()
    assert all(r["predicted"] == (1000 <= (r["doc_id"] or 0) < 2000) for r in scores)
    kept = t.acceptable(mixed, labels)
    assert kept.columns == mixed.columns and kept.count() == mixed.count() - len(toxic)
    assert t.score(mixed.limit(0), labels).count() == 0
    none = t.score(mixed, labels.limit(0)).collect()
    assert len(none) == mixed.count() and not any(r["predicted"] for r in none)


def test_copies_are_one_piece_of_evidence(spark):
    rows = [(f"some ordinary text with a peculiar wordling in it number {i % 2}", 1) for i in range(60)]
    rows += [(f"plain talk about matter{i} and thing{i}", 0) for i in range(200)]
    frame = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    assert t.learn_lexicon(t._training_rows(frame, frame.select("doc_id", "toxic"), 1000)) == {}
