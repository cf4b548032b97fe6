"""Quality rules with thresholds that follow each language and source.

Base counts come from array expressions over one text at a time. Thresholds are
fences around tail quantiles of each measure, as far off as the quantile is
from the median, read from KLL sketches per language and source; sketches of
the sources of a language, and of all languages, are merged for groups too
small to speak for themselves. Everything is DataFrame code.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import text_or_empty, written

BLANKS = r"[\x20\x09-\x0D]+"
#: Measures with a fence above and, where the first entry says so, below; the rank
#: of the quantile from which it is measured; and the part of REACH that counts
#: from there. Repetition is rare and the base rules judge the bulk of it, so its
#: fences start far out in the tail.
MEASURES = {
    "word_length": (True, 0.85, 1.0),
    "symbol_share": (False, 0.85, 1.0),
    "duplicate_line_share": (False, 0.98, 0.25),
    "repeat_share": (False, 0.98, 0.25),
    "upper_share": (False, 0.85, 1.0),
}
SKETCHED = (*MEASURES, "n_words")
REACH = 4.0
#: Where a group has next to no spread: a share may exceed the quantile by this
#: part of it, and any measure by one word in a document of the group's shorter
#: ones, which are those at this rank of the word counts.
EVEN, SHORTER = 0.25, 0.15
#: Accuracy of the sketches; ranks are off by about half a percent.
SKETCH = 800
MIN_GROUP = 200


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source) with the base counts of every text; no shuffle."""
    words = F.filter(F.split("_text", BLANKS), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), text_or_empty().alias("_text"))
    d = d.withColumn("_w", words).withColumn("_lines", lines).withColumn("_n", F.size("_w"))
    windows = F.greatest(F.col("_n") - 2, F.lit(0))
    d = d.withColumn("_sorted", F.sort_array(F.arrays_zip(
        F.slice("_w", 1, windows).alias("a"), F.slice("_w", 2, windows).alias("b"),
        F.slice("_w", 3, windows).alias("c"),
        F.when(windows > 0, F.sequence(F.lit(0), windows - 1)).otherwise(F.expr("array()").cast("array<int>")).alias("i"))))
    pairs = F.greatest(F.size("_sorted") - 1, F.lit(0))
    neighbours = F.arrays_zip(F.slice("_sorted", 1, pairs).alias("x"), F.slice("_sorted", 2, pairs).alias("y"))
    equal = F.filter(neighbours, lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"])
                     & (p["x"]["c"] == p["y"]["c"]))
    places = F.flatten(F.transform(equal, lambda p: F.array(
        *[p[side]["i"] + k for side in ("x", "y") for k in range(3)])))
    return d.select(
        "doc_id", "lang", "source", F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(places)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"))


def _measures() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")
    return {
        "word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"),
        "duplicate_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "upper_share": share("n_upper", "word_chars"),
    }


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """(lang, source, low_*, high_*): the fences of each language and source.

    A group of fewer than `min_group` documents takes the fences of its
    language, and a language of fewer those of all documents.
    """
    groups = counts.where("not base_failed").groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(SKETCH)).alias(m)
                                   for m in SKETCHED])
    groups = written(groups, "sketches", compact=True)
    by_lang = groups.groupBy("lang").agg(
        F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(SKETCH)).alias(m) for m in SKETCHED])
    overall = groups.agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(SKETCH)).alias(m) for m in SKETCHED])

    def fences(df: DataFrame, level: str) -> DataFrame:
        out = []
        grain = 1 / F.greatest(F.lit(1.0), F.kll_sketch_get_quantile_double(F.col("n_words"), F.lit(SHORTER)))
        for m, (below, rank, part) in MEASURES.items():
            q = F.kll_sketch_get_quantile_double(F.col(m), F.array(F.lit(1 - rank), F.lit(0.5), F.lit(rank)))
            even = F.lit(0.0) if below else EVEN * q[2]
            up = F.greatest(reach * part * (q[2] - q[1]), even, grain)
            down = F.greatest(reach * part * (q[1] - q[0]), grain)
            out.append(F.struct((q[0] - down if below else F.lit(None).cast("double")).alias("low"),
                                (q[2] + up).alias("high")).alias(m))
        return df.select(*[c for c in ("lang", "source") if c in df.columns],
                         F.when(F.col("n") >= (0 if level == "all" else min_group), F.struct(*out)).alias(level))
    sources, langs = fences(groups, "own"), fences(by_lang, "lang_level")
    rest = fences(overall, "all").select("all.*").first()  # two numbers per measure
    everything = F.struct(*[F.struct(*[F.lit(rest[m][side] if rest[m] else None).cast("double").alias(side)
                                       for side in ("low", "high")]).alias(m) for m in MEASURES])
    joined = sources.join(langs.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")))
    chosen = joined.select("lang", "source", F.coalesce("own", "lang_level", everything).alias("t"))
    return chosen.select("lang", "source", *[F.col(f"t.{m}.{s}").alias(f"{s}_{m}") for m in MEASURES
                                            for s in ("low", "high")])


def judge(docs: DataFrame, min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """Base counts and the two verdicts for every row of `docs`.

    base_failed: fewer than 50 words, or over half of the words in repeated
    3-word windows. kept: not base_failed, and every measure inside the fences
    of its language and source. A null or empty text has no words and fails;
    null languages and sources form groups of their own; repeated rows count
    each time. Ranks of the sketches are off by about half a percent and depend
    on the order of their rows, so a document that close to a fence may be
    judged otherwise in another run. Other columns are ignored; an empty table gives no rows.
    """
    counts = base_counts(docs).withColumn("base_failed", (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    counts = written(counts.select("*", *[c.alias(m) for m, c in _measures().items()]), "counts", compact=True)
    fences = thresholds(counts, min_group, reach).select(
        F.col("lang").alias("_l"), F.col("source").alias("_s"),
        *[f"{s}_{m}" for m in MEASURES for s in ("low", "high")])
    inside = reduce(lambda a, b: a & b, [
        F.col(m).between(F.coalesce(F.col(f"low_{m}"), F.lit(float("-inf"))), F.col(f"high_{m}"))
        for m in MEASURES])
    joined = counts.join(fences, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"), *MEASURES)
