"""Mix sources to target weights by hash-threshold histograms, with DataFrame operations only.

Each document has a fixed place u in [0, 2^60) from the md5 of its id. A source takes every document floor(target/size)
times and, once more, those whose u lies below a threshold. The threshold comes from nested histograms: words are
summed by source and the top bits of u, the bucket in which the budget runs out is found, and only that bucket's
documents are looked at again with the next bits. Nothing is sorted but the histograms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, table

#: Weights in turn for the sources in order, words the mix takes per word there is, most uses of a text.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
BITS, LEVELS = 10, 6  # 60 bits of the hash in six histograms of 1024 buckets
#: A source's documents meet its one row of plan in so many parts, as one source may hold a third of all rows.
SALTS = 64


def place(doc_id: Column) -> Column:
    """60 bits of the md5 of an id; a null id has a place too."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Sources stand by code point, null last, and take the weights in turn. The common level L solves
    sum(min(most * size, L * weight)) = share * sum(size): sources are filled in the order of size / weight, so those
    before the level are full. One row per source, whatever the number of documents.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    by = W.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    s = sizes.withColumn("w", w).withColumn("cap", (most * F.col("source_size")).cast("double"))
    s = s.withColumn("full", F.coalesce(F.sum("cap").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("w").over(by.rowsBetween(0, W.unboundedFollowing)))
    every = W.partitionBy()
    s = s.withColumn("level", (share * F.sum("source_size").over(every) - F.col("full")) / F.col("open"))
    # the level grows up to the first source that it does not fill, and falls after it
    s = s.withColumn("fits", F.col("level") * F.col("w") < F.col("cap"))
    level = F.max(F.when(F.col("fits"), F.col("level"))).over(every)
    s = s.withColumn("target", F.least("cap", F.coalesce(level * F.col("w"), F.col("cap"))))
    return s.select("source", "source_size", "target")


def _salted(small: DataFrame) -> DataFrame:
    return small.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def plan(thin: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, size, u) -> per source: source_size, target, whole turns, and the place below which one more is taken."""
    goal = targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = goal.withColumn("turns", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = scratch.write(goal.withColumn("budget", F.col("target") - F.col("turns") * F.col("source_size")), "goals")

    # boundary: the prefix of u (so far) in which the source's budget runs out, and what is left of it there
    edge = goal.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    here = thin.where("size > 0")
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        top = F.shiftright("u", shift + BITS) if level else F.lit(0).cast("long")
        inside = here.join(_salted(edge), F.col("source").eqNullSafe(F.col("s")) & (F.pmod("u", F.lit(SALTS)) == F.col("part")) & (top == F.col("prefix")))
        histogram = inside.groupBy("s", "prefix", "left", F.shiftright("u", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        by = W.partitionBy("s").orderBy("bucket")
        run = histogram.withColumn("below", F.sum("words").over(by) - F.col("words"))
        edge = run.where("below <= left and below + words > left").select("s", F.col("bucket").alias("prefix"), (F.col("left") - F.col("below")).alias("left"))
        edge = scratch.write(edge, "edge")
    # the last bucket is one place: its rows go in if that is nearer
    last = here.join(_salted(edge), F.col("source").eqNullSafe(F.col("s")) & (F.pmod("u", F.lit(SALTS)) == F.col("part")) & (F.col("u") == F.col("prefix"))).groupBy("s", "prefix", "left").agg(F.sum("size").alias("words"))
    cut = last.select("s", (F.col("prefix") + (F.col("words") - F.col("left") < F.col("left")).cast("long")).alias("below"))
    found = goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
    return scratch.write(found.select("source", "source_size", "target", "turns", F.coalesce("below", F.when(F.col("budget") > 0, F.lit(1 << 60)).otherwise(F.lit(0))).alias("below")), "plan")


def _sized(docs: DataFrame) -> DataFrame:
    """``docs`` with _size and _u."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.withColumn("_size", size).withColumn("_u", place(F.col("doc_id")))


def _taken(sized: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """``sized`` with _source_size, _target and _taken."""
    goals = _salted(goals).toDF(*(f"_{c}" for c in (*goals.columns, "part")))
    out = sized.join(goals, F.col("source").eqNullSafe(F.col("_source")) & (F.pmod("_u", F.lit(SALTS)) == F.col("_part")))
    copies = F.least(F.col("_turns") + (F.col("_u") < F.col("_below")).cast("long"), F.lit(most))
    return out.withColumn("_taken", F.col("_size") * copies)


def mix(docs: DataFrame, scratch: Scratch, keep: bool = False, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken (words, repeats counted).

    With ``keep``, instead, the rows that are taken with all their columns and these five (a column of the caller's of
    the same name as one of them is replaced). A null text has size 0 and is taken 0 times; a null source is a source
    of its own; rows that share an id have the same place and are taken together. Whole documents are taken; at the
    boundary the last one goes in only if that brings its source nearer to the target. An empty table gives an empty
    result.
    """
    thin = _sized(docs.select("doc_id", "source", "text")).select("doc_id", "source", "_size", "_u")
    thin = scratch.write(thin, "sizes")
    goals = plan(thin.select("source", F.col("_size").alias("size"), F.col("_u").alias("u")), scratch, weights, share, most)
    named = [F.col(f"_{c}").alias(c) for c in ("size", "source_size", "target", "taken")]
    if not keep:
        return _taken(thin, goals, most).select("doc_id", *named)
    mine = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    return _taken(_sized(docs.select(*mine)), goals, most).where("_taken > 0").select(*mine, *named)


def op2_mix(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to the weights 3, 1, 2."""
    return mix(table(spark, sf_dir, "documents"), Scratch(spark, "mix"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][((row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3) + 1] AS DOUBLE) AS w,
             CAST(2 * source_size AS DOUBLE) AS cap FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, (source IS NULL), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(w) OVER (ORDER BY cap / w, (source IS NULL), source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_,
             sum(source_size) OVER () AS total FROM w),
l AS (SELECT *, (1.5 * total - full_) / open_ AS level FROM f),
t AS (SELECT source, source_size, cap, w, max(CASE WHEN level * w < cap THEN level END) OVER () AS lv FROM l),
g AS (SELECT source, source_size, least(cap, coalesce(lv * w, cap)) AS target FROM t),
h AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS turns FROM g),
b AS (SELECT *, target - turns * source_size AS budget FROM h),
p AS (SELECT d.source, d.u, CAST(sum(d.size) AS BIGINT) AS words FROM d WHERE size > 0 GROUP BY d.source, d.u),
c AS (SELECT p.source, p.u, p.words, b.budget,
             sum(p.words) OVER (PARTITION BY p.source ORDER BY p.u) - p.words AS below
      FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source),
e AS (SELECT source, u + CASE WHEN words - (budget - below) < budget - below THEN 1 ELSE 0 END AS cut
      FROM c WHERE below <= budget AND below + words > budget)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * least(b.turns + CASE WHEN d.u < coalesce(e.cut, CASE WHEN b.budget > 0 THEN 1152921504606846976 ELSE 0 END) THEN 1 ELSE 0 END, 2) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the mix takes, with how many of their words it takes.

    Null and empty texts have no words and are not taken; rows that repeat an id are taken together; a null source is a
    source of its own; an empty table stays empty. Columns called size, source_size, target or taken are replaced.
    """
    return mix(docs, Scratch(spark, "stage-mix"), keep=True)
