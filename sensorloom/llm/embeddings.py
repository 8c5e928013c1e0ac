"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Normalised vectors fall into buckets of several tables; a bucket is k quantised Gaussian projections. For unit vectors a
cosine is a distance, so the chance that a pair at the threshold shares a bucket is known, and the number of tables
follows from the recall that is asked for. Dense groups (a third of all rows may be one) are not compared pair by
pair: vectors within half the threshold's angle of one leader are all linked by the triangle inequality, so a core
counts its links in closed form and is only compared with vectors outside it, in blocks of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, block_pairs, connected_components, table
from .textops import K1, mix

WIDTH, OCCUPANCY, RECALL = 1.0, 20, 0.9995
CORE, CORE_TABLES, BLOCK, DEAL = 64, 4, 1024, 4000


def collide(distance: float, width: float = WIDTH) -> float:
    """The chance that one quantised Gaussian projection agrees for two points at a distance."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def plan(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(projections a bucket, tables): unrelated vectors share a bucket with about OCCUPANCY others at any size."""
    far, near = collide(math.sqrt(2)), collide(math.sqrt(2 - 2 * threshold))
    k = max(2, math.ceil(math.log(max(rows, 1) / OCCUPANCY) / -math.log(far))) if rows > OCCUPANCY else 2
    return k, math.ceil(math.log(1 - recall) / math.log1p(-(near**k)))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def buckets(x: np.ndarray, k: int, tables: int, seed: int = 11) -> np.ndarray:
    """(rows, tables) bucket numbers of unit vectors, 63 bits with the table mixed in."""
    rng = np.random.default_rng([seed, x.shape[1], k, tables])
    a = rng.standard_normal((x.shape[1], tables * k))
    q = np.floor((x @ a) / WIDTH + rng.random(tables * k)).astype(np.int64).astype(np.uint64).reshape(len(x), tables, k)
    h = np.broadcast_to(mix(np.arange(tables, dtype=np.uint64) + K1 * np.array([x.shape[1]], np.uint64)), (len(x), tables)).copy()
    for j in range(k):
        h = mix(h * K1 + q[:, :, j])
    return (h >> np.uint64(1)).astype(np.int64)


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _by_width(vectors):
    """Row numbers of the vectors of each length."""
    size = np.array([len(v) for v in vectors])
    for d in np.unique(size):
        yield np.flatnonzero(size == d)


def _hashed(batches, k, tables):
    for pdf in batches:
        out = np.zeros((len(pdf), tables), np.int64)
        vec = pdf.embedding.to_numpy()
        step = max(1, 8_000_000 // (k * tables))  # projections of a part of the batch at a time
        for who in _by_width(vec) if len(pdf) else []:
            for at in range(0, len(who), step):
                part = who[at : at + step]
                out[part] = buckets(unit(_matrix(vec[part])), k, tables)
        yield pd.DataFrame({"id": np.repeat(pdf.id.to_numpy(), tables), "t": np.tile(np.arange(tables, dtype=np.int32), len(pdf)), "key": out.ravel()})


def _led(batches, least):
    """Members that stand close enough to their bucket's leader."""
    for pdf in batches:
        ok = np.zeros(len(pdf), bool)
        a, b = pdf.embedding.to_numpy(), pdf.lead_vec.to_numpy()
        for i in range(len(pdf)):
            ok[i] = len(a[i]) == len(b[i])
        who = np.flatnonzero(ok)
        for part in _by_width(a[who]) if len(who) else []:
            at = who[part]
            ok[at] = (unit(_matrix(a[at])) * unit(_matrix(b[at]))).sum(axis=1) >= least
        yield pdf.loc[ok, ["id", "leader"]]


def _linked(pdf, k, tables, threshold):
    """One deal of block pairs -> link counts (a, n) and edges (a, b).

    A pair is counted in the first table in which its two vectors share a bucket, and nowhere else.
    """
    ids, cnt, grp = pdf.id.to_numpy(), pdf.cnt.to_numpy(), pdf.grp.to_numpy()
    vec, table_ = pdf.embedding.to_numpy(), pdf.t.to_numpy()
    order = np.argsort(pdf.task.to_numpy(), kind="stable")
    task, side = pdf.task.to_numpy()[order], pdf.side.to_numpy()[order]
    edge = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
    a, b, n = [], [], []
    for s, e in zip(edge[:-1], edge[1:]):
        who = order[s:e]
        left, right = who[side[s:e] <= 1], who[side[s:e] != 1]
        if not len(left) or not len(right):
            continue
        x, y = unit(_matrix(vec[left])), unit(_matrix(vec[right]))
        hit = (x @ y.T >= threshold) & (grp[left][:, None] != grp[right][None, :])
        i, j = np.nonzero(hit)
        if side[s] == 0:
            i, j = i[left[i] != right[j]], j[left[i] != right[j]]
        if not len(i):
            continue
        t = table_[left[0]]
        if t:
            some, back = np.unique(np.r_[i, len(left) + j], return_inverse=True)
            rows = np.r_[left, right][some]
            h = buckets(unit(_matrix(vec[rows])), k, tables)[:, :t]
            first = np.zeros(len(i), bool)
            p, q = back[: len(i)], back[len(i) :]
            for at in range(0, len(i), 100_000):
                part = slice(at, at + 100_000)
                first[part] = ~(h[p[part]] == h[q[part]]).any(axis=1)
            i, j = i[first], j[first]
        a += [ids[left], ids[right]] if side[s] else [ids[left]]
        b += [np.zeros(len(left) + (len(right) if side[s] else 0), np.int64)]
        n += [np.bincount(i, cnt[right[j]], len(left))]
        if side[s]:
            n += [np.bincount(j, cnt[left[i]], len(right))]
        keep = np.zeros(len(i), bool)  # a forest is enough for components: each vector's first partner on either side
        keep[np.unique(i, return_index=True)[1]] = True
        keep[np.unique(j, return_index=True)[1]] = True
        if keep.sum() < len(i):
            keep |= _bridges(i, j, len(left), len(right), keep)
        a.append(ids[left[i[keep]]])
        b.append(ids[right[j[keep]]])
        n.append(np.zeros(keep.sum()))
    if not a:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
    out = pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "n": np.concatenate(n).astype(np.int64)})
    return out[(out.n > 0) | (out.b != 0)].groupby(["a", "b"], as_index=False).n.sum()


def _bridges(i, j, m, n, keep):
    """Links whose ends the kept ones leave apart."""
    label = np.arange(m + n)
    while True:
        low = np.minimum(label[i[keep]], label[m + j[keep]])
        before = label.copy()
        np.minimum.at(label, i[keep], low)
        np.minimum.at(label, m + j[keep], low)
        label = label[label]
        if (label == before).all():
            return label[i] != label[m + j]


#: Bits of the first hash that names a vector.
HASH_BITS = 64


def link_vectors(vectors: DataFrame, scratch: Scratch, threshold: float = 0.95, recall: float = RECALL) -> DataFrame:
    """(vec_id, embedding) -> vec_id, n_links (other rows linked directly), component_id (smallest vec_id), kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different
    lengths never link. Equal vectors are one node with a count; they are told by 128 bits of hashes. Rows that repeat an id count as rows of their own.
    """
    e = F.col("embedding")
    fit = F.size(e) > 0
    fit = fit & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(e, lambda v: v != 0)
    short, long_ = F.shiftright(F.xxhash64("embedding"), 64 - HASH_BITS), F.xxhash64(F.lit(1), "embedding")
    rows = scratch.write(vectors.select("vec_id", "embedding", F.coalesce(e.isNotNull() & fit, F.lit(False)).alias("ok")).withColumns({"h": F.when(F.col("ok"), short), "h2": F.when(F.col("ok"), long_)}), "vectors")
    node = scratch.write(rows.where("ok").groupBy("h", "h2").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("rep"), F.count("*").alias("cnt")), "distinct")
    # of different vectors with one hash all but the first go by their second hash
    twice = scratch.write(node.groupBy("h").agg(F.min("h2").alias("first"), F.count("*").alias("c")).where("c > 1").select("h", "first"), "collisions")
    meet = (lambda df: df.join(twice, "h", "left")) if not twice.isEmpty() else (lambda df: df.withColumn("first", F.lit(None).cast("long")))
    own = F.when(F.col("first").isNull() | (F.col("h2") == F.col("first")), F.col("h")).otherwise(F.xxhash64(F.lit(2), "h2"))
    rows = meet(rows).select("vec_id", F.when(F.col("ok"), own).alias("id"))
    node = scratch.write(meet(node).select(own.alias("id"), "embedding", "rep", "cnt"), "nodes")
    k, tables = plan(node.count(), threshold, recall)

    hashed = scratch.write(node.select("id", "embedding").mapInPandas(lambda it: _hashed(it, k, tables), "id long, t int, key long"), "buckets")
    hot = hashed.where(F.col("t") < CORE_TABLES).groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("leader")).where(F.col("c") >= CORE).select("key", "leader")
    led = hashed.where(F.col("t") < CORE_TABLES).join(hot, "key").select("id", "leader").distinct()
    vec = node.select("id", "embedding")
    led = led.join(vec, "id").join(vec.toDF("leader", "lead_vec"), "leader").select("id", "leader", "embedding", "lead_vec")
    half = math.cos(math.acos(threshold) / 2 - 1e-6)
    led = led.mapInPandas(lambda it: _led(it, half), "id long, leader long").groupBy("id").agg(F.min("leader").alias("core"))
    grouped = scratch.write(node.select("id", "cnt", "rep").join(led, "id", "left"), "cores")
    core = grouped.where("core is not null").groupBy("core").agg(F.sum("cnt").alias("inside"), F.min("id").alias("first"))

    placed = hashed.join(grouped.select("id", F.coalesce("core", "id").alias("grp")), "id")
    mixed = placed.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi").select("key")
    tasks = block_pairs(placed.join(mixed, "key").select("key", "id", "grp", "t"), BLOCK).select("task", "side", "id", "grp", "t")
    tasks = scratch.write(tasks, "tasks")
    deals = max(1, tasks.count() // DEAL)
    full = tasks.join(node.select("id", "cnt", "embedding"), "id").withColumn("deal", F.pmod("task", F.lit(deals)))
    links = full.groupBy("deal").applyInPandas(lambda pdf: _linked(pdf, k, tables, threshold), "a long, b long, n long")
    links = scratch.write(links, "links")

    counted = links.where("n > 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("across"))
    inner = grouped.where("core is not null").join(core, "core")
    edges = links.where("n = 0").select("a", "b").union(inner.select(F.col("id").alias("a"), F.col("first").alias("b")))
    comp = scratch.write(connected_components(scratch, edges), "components")
    info = grouped.join(inner.select("id", "inside"), "id", "left").join(counted, "id", "left").join(comp, "id", "left")
    info = info.select("id", "rep", (F.coalesce("inside", "cnt") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component"))
    small = info.groupBy("component").agg(F.min("rep").alias("component_id"))
    info = info.join(small, "component").select("id", "n_links", "component_id")
    out = rows.select("vec_id", "id").join(info, "id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return scratch.finish(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op1_embeddings(spark, sf_dir: str) -> DataFrame:
    """All vectors of ``embeddings`` linked at cosine 0.95."""
    return link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), Scratch(spark, "vectors"))


OP1_SQL = """
WITH RECURSIVE r AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT vec_id, e FROM r WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
c(x, y) AS (SELECT x, y FROM l UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x),
m AS (SELECT x, min(y) AS low FROM c GROUP BY x), n AS (SELECT x, count(*) AS k FROM l GROUP BY x)
SELECT r.vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, least(r.vec_id, coalesce(low, r.vec_id)) AS component_id, least(r.vec_id, coalesce(low, r.vec_id)) = r.vec_id AS kept
FROM r LEFT JOIN m ON m.x = r.vec_id LEFT JOIN n ON n.x = r.vec_id
"""
