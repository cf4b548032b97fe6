import random
from itertools import combinations

from pyspark.sql import functions as F

from meterline.llm import queries, url_rules as u
from tests.llm.inputs import SMALL

RULES = queries.URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path


def listed(url):
    host, path = split(url)
    fits = []
    for text, verdict in RULES:
        name, rest = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


ODD = [None, "", "no scheme", "http://", "http:///x", "HTTP://A.EXAMPLE.NET/EN/x", "http://a.example.net/en/x?y#z",
       "http://example.net/en", "http://net/", "http://a.net", "http://a.net?x=/", "http://xnet/", "ftp://example.com/de/1",
       "http://notexample.com/de/1", "http://q.org/fr/2#a?b", "http://a://b.net/c", "http://É.NET/x\ny?z", "x\ny://a.net/b",
       "http://a.org/fr"]


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, x, "c") for i, x in enumerate(ODD)], "page_id long, url string, host string")
    for r in u.judge(pages.union(pages.where("page_id < 3")), RULES).collect():
        url = ODD[r["page_id"]]
        rule, verdict = listed(url)
        assert (r["host"], r["path"], r["rule"]) == (*split(url), rule), url
        assert r["verdict"] == verdict or rule is None
        if not split(url)[0]:
            assert r["verdict"] == "allow"
    assert u.judge(pages.limit(0), RULES).count() == 0
    lone = u.judge(pages.where("page_id = 3"), RULES).collect()
    assert [r["verdict"] for r in lone] == ["allow"]


def test_pages_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    items = {r["page_id"]: (r["url"], frozenset(r["items"])) for r in pages.select(
        "page_id", "url", u.url_items(F.col("url")).alias("items")).collect()}
    restated = {"host:net", "host:example", "host:com", "host:org", "path:en", "path:de", "path:fr"}
    assert set(u.rule_tokens(RULES)) == restated
    items = {i: (x, s - restated) for i, (x, s) in items.items()}
    labelled = [(s, listed(x)[1] == "block") for x, s in items.values() if listed(x)[0]]
    least = u.MIN_SUPPORT * len(labelled)
    sets = {frozenset(c) for s, _ in labelled for k in range(1, len(s) + 1) for c in combinations(sorted(s), k)}
    rules, usual = {}, sum(b for _, b in labelled) / len(labelled)
    for s in sets:
        both = sum(b for t, b in labelled if s <= t)
        all_ = sum(s <= t for t, _ in labelled)
        if both >= least and both >= u.MIN_CONFIDENCE * all_ and both / all_ > usual:
            rules[s] = both / all_
    found = u.judge(pages, RULES).collect()
    assert len(found) == len(items)
    for r in found:
        url, own = items[r["page_id"]]
        rule, verdict = listed(url)
        assert (r["host"], r["path"], r["rule"]) == (*split(url), rule)
        best = max((c for s, c in rules.items() if s <= own), default=None)
        assert r["verdict"] == (verdict or ("block" if best else "allow"))
        assert rule or r["mined_confidence"] == best
    # Two thirds were blocked while tokens of the listed rules were mined.
    assert sum(r["verdict"] == "block" for r in found if r["rule"] is None) < 0.5 * sum(r["rule"] is None for r in found)


def test_planted_tokens_are_found_and_matched_like_all_subsets(spark):
    """Tokens of random urls: any subset of a url's tokens may be a rule."""
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        words = rnd.sample(["ads", "win", "cash", "news", "blog", "shop", "tips"], rnd.randint(1, 4))
        words += ["promo", "deal"] if i % 4 == 0 else []  # always together: one class
        blocked = "promo" in words or {"ads", "win"} <= set(words) or rnd.random() < 0.1
        host = "bad.net" if blocked else "good.example.net"
        rows.append((i, f"http://{host}/{'' if blocked else 'en/'}{'/'.join(words)}"))
    rows += [(1000 + i, f"http://other.info/{w}") for i, w in enumerate(
        ["promo", "deal/news", "ads/win", "win", "ads/x/win/tips", "blog", "news/shop", "none"])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r for r in u.judge(pages, RULES, 0.02, 0.85).collect()}
    own = {i: frozenset(x.split("://")[1].split("/")[1:]) - {"en"} for i, x in rows}
    labelled = [(own[i], found[i]["verdict"] == "block") for i, _ in rows if i < 1000]
    usual, rules = sum(b for _, b in labelled) / len(labelled), {}
    for s in {frozenset(c) for t, _ in labelled for k in range(1, len(t) + 1) for c in combinations(sorted(t), k)}:
        both, all_ = sum(b for t, b in labelled if s <= t), sum(s <= t for t, _ in labelled)
        if both >= 0.02 * len(labelled) and both >= 0.85 * all_ and both / all_ > usual:
            rules[s] = both / all_
    for i in range(1000, 1008):
        assert found[i]["mined_confidence"] == max((c for s, c in rules.items() if s <= own[i]), default=None)
    assert [found[i]["verdict"] for i in range(1000, 1008)][:3] == ["block"] * 3 and found[1007]["verdict"] == "allow"


def test_a_long_url_in_many_copies_is_one_item(spark):
    long = "/".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))
    rows = [(i, f"http://bad.net/{long}") for i in range(50)] + [
        (100 + i, f"http://h{i}.example.net/en/page/{i}") for i in range(400)] + [
        (900, "http://new.info/wordab"), (901, "http://new.info/page"), (902, "http://new.info/wordan/wordbn/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in u.judge(pages, RULES).collect()}
    assert (found[900], found[901], found[902], found[0], found[100]) == ("block", "allow", "block", "block", "allow")


def test_weaker_longer_rules_are_dropped(spark):
    rows = [(["a", "b"], True)] * 30 + [(["a", "c"], True)] * 30 + [(["c"], False)] * 30 + [(["d"], False)] * 5
    labelled = spark.createDataFrame(rows, "items array<string>, blocked boolean")
    rules = {tuple(r["items"]): r["confidence"] for r in u.mine(labelled, 0.1, 0.4).collect()}
    assert rules == {("a",): 1.0, ("b",): 1.0}  # c implies blocking less often than not knowing anything


def test_query_reads_all_pages(spark):
    assert queries.urls(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
