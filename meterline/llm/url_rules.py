"""URL filtering: listed host and path rules, else association rules mined by FP-growth."""
from __future__ import annotations

import math
import re

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import written

BLOCK = "label=block"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.85


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; `rules` are (rule, verdict).

    A rule is `host/path`; it fits its host and all subdomains if the url's
    path starts with the rule's. Of equally long rules the first listed wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(reversed(rules), key=lambda r: len(r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def url_items(url: Column) -> Column:
    """Distinct tokens of a url with their place: host labels, path words, query keys.

    Digits become `0`, so that numbered pages share tokens. A null url and one
    without `://` have none.
    """
    def tokens(text: Column, at: str, kind: str) -> Column:
        parts = F.filter(F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), at), lambda x: x != "")
        return F.transform(parts, lambda x: F.concat(F.lit(kind), x))
    query = F.regexp_extract(url, r"(?s)://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    items = F.concat(
        tokens(host_of(url), r"\.", "host:"), tokens(path_of(url), "[/._-]+", "path:"),
        F.transform(F.filter(keys, lambda x: x != ""), lambda x: F.concat(F.lit("query:"), F.lower(x))))
    return F.when(F.coalesce(F.contains(url, F.lit("://")), F.lit(False)), F.array_sort(F.array_distinct(items))) \
        .otherwise(F.expr("cast(array() as array<string>)"))


def rule_tokens(rules: list[tuple[str, str]]) -> list[str]:
    """The tokens that hosts and paths of listed rules bring into every url they fit.

    Such a token goes with a label because the label was given for it; it says
    nothing about other urls.
    """
    out = set()
    for text, _ in rules:
        host, _, path = text.lower().partition("/")
        for kind, at, part in (("host:", r"\.", host), ("path:", r"[/._-]+", path)):
            out |= {kind + x for x in re.split(at, re.sub("[0-9]+", "0", part)) if x}
    return sorted(out)


def token_classes(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(item, token_class, n): the tokens that can be part of a rule.

    Tokens that occur in exactly the same labelled sets (told by two sums of
    the sets' hashes) are one class, named by its least token: no rule can tell
    them apart. Tokens of too few blocked urls are left out. There are at most
    (tokens of a url) / min_support of them.
    """
    sets = labelled.groupBy("items").agg(F.count("*").alias("n"), F.count_if("blocked").alias("k"))
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    each = sets.select(F.explode("items").alias("item"), "n", "k", *[
        F.xxhash64(F.lit(seed), "items").cast("decimal(38,0)").alias(name) for seed, name in ((1, "low"), (2, "high"))])
    tokens = each.groupBy("item").agg(*[F.sum(c).alias(c) for c in ("n", "k", "low", "high")]).where(
        F.col("k") >= math.ceil(min_support * total))
    same = tokens.groupBy("n", "k", "low", "high").agg(F.min("item").alias("token_class"))
    return tokens.join(same, ["n", "k", "low", "high"]).select("item", "token_class", "n")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, items, confidence, support): sets of token classes that imply blocking.

    `labelled` has items and blocked. All rows are mined, each with the classes
    of its tokens (see `token_classes`), so that a url of many tokens in many
    copies is one item and not all subsets of its tokens. A rule must raise the
    share of blocked urls, and is dropped if a part of its classes implies
    blocking with no less confidence.
    """
    names = sorted(r["token_class"] for r in token_classes(labelled, min_support).select("token_class").distinct().collect())
    kept = F.filter("items", lambda x: x.isin(names)) if names else F.expr("cast(array() as array<string>)")
    baskets = labelled.select(F.when(F.col("blocked"), F.concat(kept, F.array(F.lit(BLOCK)))).otherwise(kept).alias("items"))
    usual = labelled.agg(F.avg(F.col("blocked").cast("double"))).first()[0] or 0.0
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = written(model.associationRules.where((F.col("consequent")[0] == BLOCK) & (
            F.col("confidence") > usual) & (F.size("antecedent") > 0)).select(
        F.array_sort("antecedent").alias("items"), "confidence", "support").withColumn(
        "rule_id", F.sha2(F.array_join("items", "\n"), 256)), "rules")
    held = rules.select(F.explode("items").alias("anchor"), F.col("items").alias("longer"),
                        F.col("confidence").alias("c"), F.col("rule_id").alias("weaker"))
    firsts = rules.withColumn("anchor", F.col("items")[0])
    beaten = held.join(firsts, "anchor").where(
        (F.col("c") <= F.col("confidence")) & (F.size("items") < F.size("longer"))
        & (F.size(F.array_except("items", "longer")) == 0)).select("weaker").distinct()
    return rules.join(beaten, F.col("rule_id") == F.col("weaker"), "left_anti")


def index(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """`rules` with `anchor`, the rarest of their classes: the key of the inverted index."""
    counts = classes.groupBy("token_class").agg(F.min("n").alias("n"))
    anchors = rules.select("rule_id", F.explode("items").alias("token_class")).join(counts, "token_class").groupBy(
        "rule_id").agg(F.min(F.struct("n", "token_class"))["token_class"].alias("anchor"))
    return rules.join(anchors, "rule_id")


def matched(item_sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """(items, rule_id, confidence): the most confident indexed rule that each distinct set holds.

    A set holds a class if it has any of its tokens.
    """
    held = item_sets.select("items", F.explode("items").alias("item")).join(
        classes.select("item", "token_class"), "item").groupBy("items").agg(F.collect_set("token_class").alias("held"))
    found = held.select("items", "held", F.explode("held").alias("anchor")).join(
        rules.select("anchor", "rule_id", "confidence", F.col("items").alias("needed")), "anchor").where(
        F.size(F.array_except("needed", "held")) == 0)
    best = found.groupBy("items").agg(F.max(F.struct("confidence", "rule_id")).alias("b"))
    return best.select("items", F.col("b.rule_id").alias("rule_id"), F.col("b.confidence").alias("confidence"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_confidence) for every row of `pages`.

    Urls that a listed rule decides are the labels: FP-growth mines token sets
    that go with blocking, and these judge the other urls, which are allowed if
    no mined rule matches. The tokens of the listed rules themselves are not
    mined, as they would only carry those rules over to other hosts. A null url or one without `://` has an empty host
    and path and is allowed; repeated rows are judged alike; null page_ids are
    carried along; other columns are ignored; without labels nothing is mined.
    """
    url = F.col("url").cast("string")
    restated = rule_tokens(rules)
    items = F.filter(url_items(url), lambda x: ~x.isin(restated)) if restated else url_items(url)
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"), items.alias("items"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    base = written(base.withColumn("rule", rule).withColumn("_listed", verdict), "urls")
    labelled = base.where("_listed is not null").select("items", (F.col("_listed") == "block").alias("blocked"))
    open_sets = base.where("_listed is null and size(items) > 0").select("items").distinct()
    if labelled.isEmpty():
        return base.select("page_id", "host", "path", "rule", F.lit("allow").alias("verdict"),
                           F.lit(None).cast("double").alias("mined_confidence"))
    classes = written(token_classes(labelled, min_support), "classes")
    known = index(mine(labelled, min_support, min_confidence), classes)
    hits = matched(open_sets, known, classes).select(F.col("items").alias("_items"), "confidence")
    judged = base.where("_listed is null").join(hits, F.col("items") == F.col("_items"), "left")
    return base.where("_listed is not null").select(
        "page_id", "host", "path", "rule", F.col("_listed").alias("verdict"),
        F.lit(None).cast("double").alias("mined_confidence")).unionByName(judged.select(
            "page_id", "host", "path", "rule",
            F.when(F.col("confidence").isNotNull(), "block").otherwise("allow").alias("verdict"),
            F.col("confidence").alias("mined_confidence")))
