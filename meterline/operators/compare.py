"""Equivalence of two builds of the same tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterline.session import settle

# Tolerance for floating point cells.
RELATIVE = 1e-12
ABSOLUTE = 1e-9


def _canonical(field: T.StructField) -> Column:
    """A text for the value that any SQL engine can write as well; floats to six places."""
    value = F.col(field.name)
    text = value.cast("string")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
        text = F.when(finite, value.cast("decimal(38,6)").cast("string")).when(value.isNotNull(), text)
    return F.coalesce(text, F.lit("~"))


def content_fingerprint(df: DataFrame, by: str = "source_period") -> DataFrame:
    """Row count and sums of both halves of the rows' MD5 per group; independent of row order.

    The sums are decimal, so they cannot overflow 64 bits, and they aggregate
    partially: a hot group costs no more than any other.
    """
    digest = F.md5(F.concat_ws("|", *[_canonical(f) for f in df.schema.fields]))

    def half(start: int) -> Column:
        number = F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)")
        return F.sum(number).cast("decimal(38,0)").cast("string")
    return df.groupBy(by).agg(
        F.count("*").alias("row_count"), half(1).alias("high_sum"), half(17).alias("low_sum"))


def _close(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    bound = F.greatest(F.abs(a), F.abs(b)) * RELATIVE
    return a.eqNullSafe(b) | F.coalesce(gap <= F.greatest(bound, F.lit(ABSOLUTE)), F.lit(False))


def compare_tables(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row: matched keys, keys on one side only, differing rows, largest float gap.

    A null-safe full outer join on the grain. Only counts leave the executors.
    """
    values = [f for f in left.schema.fields if f.name not in keys]
    packed = F.struct(*[F.col(f.name) for f in values])
    a = left.select(*[F.col(k).alias(f"a_{k}") for k in keys], packed.alias("a"))
    b = right.select(*[F.col(k).alias(f"b_{k}") for k in keys], packed.alias("b"))
    on = reduce(
        lambda x, y: x & y, (F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    floats = [f.name for f in values if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    same = reduce(lambda x, y: x & y, [
        _close(F.col(f"a.{f.name}"), F.col(f"b.{f.name}")) if f.name in floats
        else F.col(f"a.{f.name}").eqNullSafe(F.col(f"b.{f.name}"))
        for f in values], F.lit(True))
    gaps = [F.abs(F.col(f"a.{n}") - F.col(f"b.{n}")) for n in floats]
    gap = F.greatest(F.lit(0.0), *gaps) if gaps else F.lit(0.0)
    return a.join(b, on, "full_outer").agg(
        F.lit(name).alias("table_name"),
        F.count_if(both).alias("matched"),
        F.count_if(F.col("b").isNull()).alias("only_before"),
        F.count_if(F.col("a").isNull()).alias("only_after"),
        F.count_if(both & ~same).alias("differing"),
        F.coalesce(F.max(F.when(both, gap)), F.lit(0.0)).alias("max_float_gap"),
    )


#: Buckets per group of rows; one that differs is compared row by row.
BUCKETS = 256


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_prints(df: DataFrame, keys: list[str], group: Column, buckets: int = BUCKETS) -> DataFrame:
    """(group, bucket, rows, low, high): row count and sums of two hashes of whole rows, per bucket of the keys.

    Doubles count bit by bit and nulls by their place, so rows that differ in
    anything give different hashes. Only partial sums are shuffled.
    """
    names = sorted(df.columns)
    nulls = F.concat(*[F.when(F.col(n).isNull(), "1").otherwise("0") for n in names])
    prints = [F.sum(F.xxhash64(F.lit(seed), nulls, *names).cast("decimal(38,0)")).alias(alias)
              for seed, alias in ((1, "low"), (2, "high"))]
    return df.groupBy(group.cast("string").alias("group"), _bucket(keys, buckets).alias("bucket")).agg(
        F.count("*").alias("rows"), *prints)


def changed_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(group, bucket) whose prints are not the same on both sides."""
    both = left.select(F.lit(1).alias("side"), "*").unionByName(right.select(F.lit(-1).alias("side"), "*"))
    signed = [F.sum(F.col(n) * F.col("side")).alias(n) for n in ("rows", "low", "high")]
    return both.groupBy("group", "bucket").agg(*signed).where("rows <> 0 or low <> 0 or high <> 0").select(
        "group", "bucket")


def rows_of(df: DataFrame, changed: DataFrame, keys: list[str], group: Column, buckets: int) -> DataFrame:
    """The rows of `df` that lie in a changed bucket."""
    marked = df.withColumns({"__group": group.cast("string"), "__bucket": _bucket(keys, buckets)})
    on = F.col("__group").eqNullSafe(F.col("group")) & (F.col("__bucket") == F.col("bucket"))
    return marked.join(changed, on, "left_semi").drop("__group", "__bucket")


def differing_keys(
    left: DataFrame, right: DataFrame, keys: list[str], name: str, group: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(table_name, key, kind) of the rows that differ: only_before, only_after or differing.

    First the buckets' prints are compared, then only rows of buckets that are
    not the same are joined on their key (shown as text, parts joined by |).
    Floats within the tolerance do not differ. `keys` are unique on each side.
    """
    group = F.lit("") if group is None else group
    changed = settle(changed_buckets(
        bucket_prints(left, keys, group, buckets), bucket_prints(right, keys, group, buckets)), "changed-buckets")
    values = [f for f in left.schema.fields if f.name not in keys]
    sides = []
    for side, df in (("a", left), ("b", right)):
        rows = rows_of(df, changed, keys, group, buckets)
        sides.append(rows.select(
            *[F.col(k).alias(f"{side}_{k}") for k in keys], F.lit(True).alias(f"{side}_here"),
            *[F.col(f.name).alias(f"{side}__{f.name}") for f in values]))
    on = reduce(lambda x, y: x & y, (F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys))
    same = reduce(lambda x, y: x & y, [
        _close(F.col(f"a__{f.name}"), F.col(f"b__{f.name}")) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f"a__{f.name}").eqNullSafe(F.col(f"b__{f.name}")) for f in values], F.lit(True))
    key = F.concat_ws("|", *[F.coalesce(F.when(
        F.col("a_here"), F.col(f"a_{k}").cast("string")).otherwise(F.col(f"b_{k}").cast("string")), F.lit("~"))
        for k in keys])
    kind = F.when(F.col("b_here").isNull(), "only_before").when(F.col("a_here").isNull(), "only_after").when(
        ~same, "differing")
    return sides[0].join(sides[1], on, "full_outer").select(
        F.lit(name).alias("table_name"), key.alias("key"), kind.alias("kind")).where("kind is not null")


def equivalent(report: DataFrame) -> bool:
    return report.where("only_before + only_after + differing > 0").isEmpty()
