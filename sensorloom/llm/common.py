"""Helpers that every corpus operator shares: tables, intermediate results, components, blocks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a temporary one only where all is one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="sensorloom-")
    return _LOCAL[app]


class Scratch:
    """Intermediate tables of one operator call, written to the shared folder so that a lost executor loses nothing."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back, which cuts its lineage."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in frames:
            self.delete(df._scratch_path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Write the result and delete all tables before it; only its own folder stays, as it may be read at any time."""
        out = self.write(df, "result")
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        store = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        last = out._scratch_path.rpartition("/")[2]
        for x in store.listStatus(root):
            if x.getPath().getName() != last:
                store.delete(x.getPath(), True)
        return out

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


#: Nodes whose edges are dealt to several tasks, at most, and to how many.
HUBS, SALTS = 500, 64


def _met(edges: DataFrame, low: DataFrame, many: int) -> DataFrame:
    """``edges`` (u, v) joined with ``low`` (u, m, deg) by u.

    Nodes with more than ``many`` / HUBS edges are hubs; as all degrees sum to ``many`` at most, there are fewer than
    HUBS of them, so their ids may stand in the plan. A hub's edges are dealt to SALTS tasks, each with the hub's row.
    """
    hubs = [r[0] for r in low.where(F.col("deg") > max(200, many // HUBS)).select("u").collect()]
    if not hubs:
        return edges.join(low, "u").select("u", "v", "m")
    hub = F.col("u").isin(hubs)
    one, all_ = F.array(F.lit(0).cast("long")), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = edges.withColumn("salt", F.when(hub, F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0)).cast("long"))
    return salted.join(low.select("u", "m", F.explode(F.when(hub, all_).otherwise(one)).alias("salt")), ["u", "salt"]).select("u", "v", "m")


#: Edges that one task joins by itself: rounds of shuffles would cost more than they spread.
FEW = 100_000


def _joined(batches):
    """All of a few edges -> (id, component), by passing the least id along edges and along what was passed before."""
    import numpy as np
    import pandas as pd

    pairs = [x for x in batches]
    u, v = (np.concatenate([np.zeros(0, np.int64), *(x[c].to_numpy() for x in pairs)]) for c in ("u", "v"))
    ids, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(ids))
    while True:
        before = low.copy()
        least = np.minimum(low[a], low[b])
        for end in (low[a], low[b], a, b):
            np.minimum.at(low, end, least)
        while not (low[low] == low).all():
            low = low[low]
        if (low == before).all():
            break
    yield pd.DataFrame({"id": ids, "component": ids[low]})


def connected_components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node of ``edges``: the smallest id that is reachable.

    Large-star and small-star steps alternate until the stars stand still, so the number of rounds follows the
    logarithm of the longest path, and no group is ever gathered: each step is a minimum and a join. The few nodes that
    hold very many edges have them dealt to several tasks (see ``_met``).
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = scratch.write(e, "edges")
    count, seen = e.count(), None
    if count <= FEW:
        return scratch.write(e.coalesce(1).mapInPandas(_joined, "id long, component long"), "components")
    while True:
        many = 2 * count
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg")).select("u", F.least("u", "m").alias("m"), "deg")
        large = _met(both.where("v > u"), low, many).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = scratch.write(small, "stars")
        scratch.drop(e)
        e = after
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        count = now[0]
        if now == seen:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v"), F.col("v")).distinct())
        seen = now


def block_pairs(rows: DataFrame, size: int) -> DataFrame:
    """Spread buckets over bounded tasks: (key, id, grp, ...) -> the same rows with task (long) and side (0 both, 1, 2).

    Rows of one ``key`` are to be compared with each other, except rows of one ``grp``, which need it no more. A
    bucket is cut into blocks of about ``size`` rows; a group larger than that has blocks of its own, which never
    meet each other. Each pair of blocks is a task; its rows come with side 0 (a block with itself), 1 or 2.
    """
    count = rows.groupBy("key", "grp").agg(F.count("*").alias("c"))
    big = count.where(F.col("c") > size).select("key", F.col("grp").alias("grp"), F.ceil(F.col("c") / size).cast("int").alias("nb"))
    rest = count.where(F.col("c") <= size).groupBy("key").agg(F.count("*").alias("k"), F.sum("c").alias("c"))
    rest = rest.select("key", F.greatest(F.lit(1), F.ceil(F.col("c") / size)).cast("int").alias("rb"))
    placed = rows.join(big, ["key", "grp"], "left").join(rest, "key", "left")
    placed = placed.withColumn("own", F.when(F.col("nb").isNotNull(), F.col("grp")))
    placed = placed.withColumn("blk", F.when(F.col("nb").isNotNull(), F.pmod(F.xxhash64("id"), F.col("nb"))).otherwise(F.pmod(F.xxhash64("grp"), F.col("rb"))).cast("int"))
    placed = placed.drop("nb", "rb")
    single = big.select("key", F.col("grp").alias("own"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("blk"))
    mixed = rest.select("key", F.lit(None).cast("long").alias("own"), F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("blk"))
    blocks = single.union(mixed).select("key", "own", "blk", F.struct(F.col("own").isNull().alias("m"), F.coalesce("own", F.lit(0)).alias("o"), F.col("blk").alias("k")).alias("at"))
    l, r = blocks.alias("l"), blocks.alias("r")
    pairs = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.at") <= F.col("r.at")) & ~F.coalesce(F.col("l.own") == F.col("r.own"), F.lit(False)))
    pairs = pairs.select(F.col("l.key").alias("key"), F.col("l.own").alias("lo"), F.col("l.blk").alias("lb"), F.col("r.own").alias("ro"), F.col("r.blk").alias("rb"), F.xxhash64("l.key", F.coalesce("l.own", F.lit(0)), F.col("l.own").isNull(), "l.blk", F.coalesce("r.own", F.lit(0)), F.col("r.own").isNull(), "r.blk").alias("task"))
    same = F.col("lo").eqNullSafe(F.col("ro")) & (F.col("lb") == F.col("rb"))
    sides = pairs.where(same).select("key", F.col("lo").alias("own"), F.col("lb").alias("blk"), "task", F.lit(0).alias("side"))
    sides = sides.union(pairs.where(~same).select("key", "lo", "lb", "task", F.lit(1))).union(pairs.where(~same).select("key", "ro", "rb", "task", F.lit(2)))
    p, s = placed.alias("p"), sides.alias("s")
    met = p.join(s, (F.col("p.key") == F.col("s.key")) & F.col("p.own").eqNullSafe(F.col("s.own")) & (F.col("p.blk") == F.col("s.blk")))
    return met.select("p.*", "s.task", "s.side").drop("own", "blk")
