"""Contiguous patterns over a series: each step must match the very next record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def match_next(df: DataFrame, steps: list[Column], keys: list[str], within: int | None = None) -> DataFrame:
    """A row per match: keys, first_seq, last_seq, first_ms, last_ms. ``within`` (ms) bounds the time from first to last."""
    w = W.partitionBy(*keys).orderBy("ms", "seq")
    d = df
    for i, step in enumerate(steps):
        d = d.withColumn(f"_m{i}", F.coalesce(step, F.lit(False)))
    hit = F.lit(True)
    for i in range(len(steps)):
        hit = hit & (F.col("_m0") if i == 0 else F.coalesce(F.lead(f"_m{i}", i).over(w), F.lit(False)))
    k = len(steps) - 1
    d = d.withColumn("_hit", hit).withColumn("last_seq", F.lead("seq", k).over(w) if k else F.col("seq")).withColumn("last_ms", F.lead("ms", k).over(w) if k else F.col("ms"))
    out = d.where("_hit").select(*keys, F.col("seq").alias("first_seq"), "last_seq", F.col("ms").alias("first_ms"), "last_ms")
    return out if within is None else out.where(F.col("last_ms") - F.col("first_ms") < within)


def times(step: Column, n: int) -> list[Column]:
    """The steps of a pattern in which ``n`` records in a row match ``step``."""
    if n < 1:
        raise ValueError("a step happens once at least")
    return [step] * n


def match_times(df: DataFrame, steps: list[tuple[Column, int]], keys: list[str], within: int | None = None) -> DataFrame:
    """A row per match of steps that each hold for n records in a row, all contiguous, as ``match_next`` gives them.

    How many records in a row match is counted once per different step, from the end of the series backwards, so a step's
    cost does not grow with its n; a step's records begin where those of the one before end.
    """
    w = W.partitionBy(*keys).orderBy("ms", "seq")
    d = df.withColumn("_place", F.row_number().over(w))
    at, hit = 0, F.lit(True)
    for i, (step, n) in enumerate(steps):
        times(step, n)
        d = d.withColumn(f"_m{i}", F.coalesce(step, F.lit(False)))
        miss = F.min(F.when(~F.col(f"_m{i}"), F.col("_place"))).over(w.rowsBetween(0, W.unboundedFollowing))
        d = d.withColumn(f"_run{i}", F.coalesce(miss, F.max("_place").over(w.rowsBetween(0, W.unboundedFollowing)) + 1) - F.col("_place"))
        hit = hit & F.coalesce(F.lead(f"_run{i}", at).over(w) >= n, F.lit(False))
        at += n
    k = at - 1
    d = d.withColumn("_hit", hit).withColumn("last_seq", F.lead("seq", k).over(w)).withColumn("last_ms", F.lead("ms", k).over(w))
    out = d.where("_hit").select(*keys, F.col("seq").alias("first_seq"), "last_seq", F.col("ms").alias("first_ms"), "last_ms")
    return out if within is None else out.where(F.col("last_ms") - F.col("first_ms") < within)


def match_switching(df: DataFrame, before: list[Column], after: list[Column], switch: Column, keys: list[str], within: int | None = None) -> DataFrame:
    """``before`` holds until the record that ``switch`` marks, ``after`` from behind it; the mark itself matches nothing."""
    w = W.partitionBy(*keys).orderBy("ms", "seq").rowsBetween(W.unboundedPreceding, 0)
    d = df.withColumn("_switch", F.coalesce(switch, F.lit(False))).withColumn("_epoch", F.sum(F.col("_switch").cast("int")).over(w))
    d = d.where("not _switch")
    one = match_next(d.where("_epoch = 0"), before, [*keys, "_epoch"], within)
    two = match_next(d.where("_epoch > 0"), after, [*keys, "_epoch"], within)
    return one.unionByName(two).drop("_epoch")
