import hashlib
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from meterline.llm import personal_data as p
from tests.llm.inputs import awkward, documents

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(re.sub("[^0-9]", "", v)) <= 19 and luhn(re.sub("[^0-9]", "", v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
}


def base(text):
    return [(k, m.start(), m.end()) for k, (pattern, good) in PLAIN.items()
            for m in re.finditer(pattern, text or "") if good(m.group())]


def check(docs):
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    want = []
    for i, t in texts:
        spans = base(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((i, *[sum(s[0] == k for s in spans) for k in PLAIN], hashlib.sha256(joined.encode()).hexdigest(),
                     joined))
    found = []
    for r in p.find(docs).collect():
        kinds = [s for s in r["spans"].split(",") if s and not s.startswith("context:")]
        found.append((*tuple(r)[:6], ",".join(kinds)))
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_documents_match_plain_patterns(spark):
    check(documents(spark, SF))


PARTS = st.sampled_from(list("a@.-+ 1450()é😀\n") + ["4111111111111111", "4111 1111-1111 1111", "10.0.0.255", "1.2.3.256",
                        "a.b+c@d-e.fg.h", "@x.y", "+1 (678) 555-5272", "00000012.1.1.1", "٣٣٣", "a@b.c@d.e", "  "])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), min_size=80, max_size=80))
def test_odd_strings_match_plain_patterns(spark, texts):
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_awkward_and_very_long_texts(spark):
    check(awkward(spark))
    texts = ["x" * 300_000, "a." * 100_000, "1." * 1_000, "1 " * 20_000, "+1" * 20_000, "a@b." * 500, "@" * 100_000,
             "mail a.b@c.de " * 700]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert p.find(awkward(spark).limit(0)).count() == 0


def planted(spark):
    """A context that holds addresses in many documents holds other identifiers in a few."""
    rows = [(i, f"please contact user{i}.x@mail.example today about item {i}0000 of list") for i in range(40)]
    rows += [(100 + i, f"please contact ZX-77{i}-QQ today about nothing") for i in range(3)]
    rows += [(200 + i, f"please count 55{i}55{i} apples") for i in range(40)]
    rows += [(300 + i, "see the copy same.one@mail.example here") for i in range(30)]
    rows += [(400, "see the 123456 here")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, extra string")


def test_credible_contexts_find_other_identifiers(spark):
    found = {r["doc_id"]: r["spans"] for r in p.find(planted(spark)).collect()}
    for i in range(3):
        assert found[100 + i] == "context:15:24"
    assert all(not s or s.startswith("email") and "context" not in s for i, s in found.items() if not 100 <= i < 103)


def test_context_reaches_over_other_tokens_with_digits(spark):
    """The halves of a number are one instance; words count on either side of other tokens with digits."""
    rows = [(i, f"call me +1 (0{i % 90 + 10}) 555-77{i + 10} now") for i in range(40)]
    rows += [(100, "99123 first"), (101, "AB-1234 CD-5678 second"), (102, "\n77777\n88888 99999\n")]
    rows += [(110 + i, f"ticket 2024-{i} mail u{i}x@mail.example soon") for i in range(40)]
    rows += [(200, "ticket 2024-7 mail ZZ-4711-Y soon"), (201, "call me XK-4711 now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in p.find(docs).collect()}
    assert all("context" not in found[i] for i in [*range(40), 100, 101, 102])
    assert found[200] == "context:19:28" and found[201] == "context:8:15"
    scanned = {r["doc_id"]: r["occurrences"] for r in p.scan(docs).collect()}
    assert [(o["value"], o["patterns"], o["seed"]) for o in scanned[3]] == [
        ("(013) 555-7713", ["call me _", "me _ now"], True)]
    assert {o["value"]: o["patterns"] for o in scanned[101]} == {"AB-1234": [], "CD-5678": ["# _ second"]}
    assert [o["patterns"] for o in scanned[115] if o["seed"]] == [["# mail _", "mail _ soon"]]


def test_copies_lend_no_weight(spark):
    patterns = p.credible_patterns(spark.createDataFrame(
        [("a", "x", True), ("b", "y1", True), ("b", "y2", True), ("b", "y3", True), ("b", "y4", True), ("b", "z", False),
         ("c", "z", False), ("c", "w", False), ("d", "y1", True), ("d", "y2", True), ("d", "n1", False),
         ("d", "n2", False), ("d", "n3", False)], "pattern string, value string, seed boolean"),
        min_confidence=0.6)
    assert {r["pattern"] for r in patterns.collect()} == {"b"}


def test_many_identifiers_of_one_text(spark):
    """Spans, instances and redaction of a text of tens of thousands of identifiers."""
    n = 20_000
    text = " ".join(f"mail u{i}x@mail.example or AB-{i:05d}" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "mail u1@mail.example +49 (30) 1234567, 12.5.7.9 x12345")],
                                 "doc_id long, text string")
    scanned = {r["doc_id"]: r for r in p.scan(docs).collect()}
    assert len(scanned[1]["base"]) == n and len(scanned[1]["occurrences"]) == 2 * n
    assert sum(o["seed"] for o in scanned[1]["occurrences"]) == n
    assert [(o["value"], o["seed"]) for o in scanned[2]["occurrences"]] == [
        ("u1@mail.example", True), ("12.5.7.9", True), ("1234567", True), ("x12345", False)]
    out = {r["doc_id"]: r["text"] for r in p.redact(docs).collect()}
    assert out[1].count("[email]") == n and "@" not in out[1]
    assert out[2] == "mail [email] [phone], [ip] x12345"


def test_redaction(spark):
    docs = planted(spark).withColumn("n_chars", F.length("text")).withColumn("__op", F.lit(1))
    out = {r["doc_id"]: r for r in p.redact(docs).collect()}
    assert out[101]["text"] == "please contact [context] today about nothing"
    assert out[3]["text"] == "please contact [email] today about item 30000 of list"
    assert out[250 - 30]["text"].startswith("please count 55")
    assert all(r["n_chars"] == len(r["text"]) and r["extra"] == "clash" for r in out.values()) and len(out) == 114
    assert p.redact(docs).columns == docs.columns
    odd = {r["doc_id"]: r["text"] for r in p.redact(awkward(spark)).collect() if r["doc_id"]}
    assert odd[3] is None and odd[4] == "" and odd[12] == "a\n\n\nb  c \n d\u00a0e\x1cf"


def test_no_python_in_the_plans(spark):
    for df in (p.scan(documents(spark)), p.find(documents(spark)), p.redact(documents(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Exchange" not in p.scan(documents(spark))._jdf.queryExecution().executedPlan().toString()
