"""The commit log as data: which entries a generation consists of, and which folders nobody needs.

A commit holds only the entries that its run changed. The state of a generation
is the last version of every (source, period) up to it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

KEYS = ("source", "period")


def state(versions: DataFrame, upto: int | None = None) -> DataFrame:
    """The entries of the generation `upto` (the last one by default).

    `versions` has sequence, source, period and the entry's columns. One
    partially aggregated maximum per key, whatever the length of the log.
    """
    seen = versions if upto is None else versions.where(F.col("sequence") <= upto)
    rest = [n for n in versions.columns if n not in ("sequence", *KEYS)]
    last = F.max(F.struct("sequence", *rest)).alias("last")
    return seen.groupBy(*KEYS).agg(last).select(
        *KEYS, "last.sequence", *[F.col("last")[n].alias(n) for n in rest])


def live(versions: DataFrame, first: int) -> DataFrame:
    """Versions that some generation from `first` on consists of.

    A version lives until the next one of its (source, period) is committed;
    versions of generations before `first` alone are of no use to anybody.
    """
    following = F.lead("sequence").over(Window.partitionBy(*KEYS).orderBy("sequence"))
    return versions.withColumn("replaced_at", following).where(
        F.col("replaced_at").isNull() | (F.col("replaced_at") > first)).drop("replaced_at")


def unreferenced(listing: DataFrame, referenced: DataFrame, column: str = "folder") -> DataFrame:
    """Listed folders that nothing refers to."""
    return listing.join(referenced.select(column).distinct(), column, "left_anti")
