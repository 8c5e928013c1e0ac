"""Near-duplicate documents by SetSketch: bands of registers propose pairs, likelihood prunes them, full sets decide.

A document's set is its distinct k-word shingles. Register i holds the truncated, exponentially spaced minimum
floor(1 - log_b(h_i)) of its elements' exponential hashes, so registers of a union are the maxima of the registers, and
the chance that two documents agree in a register follows their Jaccard similarity.

Documents with the same words are one node. Each band bucket is a star round its busiest node, so that thousands of
copies cost one link each; after those links are confirmed on full sets, only buckets that still hold more than one
component are compared pair by pair, in blocks of bounded size and across components only.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, block_pairs, connected_components, table
from .textops import Words, mix, pieces, text_bytes

REGISTERS, BASE = 256, 1.2
#: Greatest chance that a pair at the threshold meets in no band.
MISS = 1e-4
#: Standard deviations of the sketch estimate that a pair may lie below the threshold and still be checked.
SLACK = 5.0
BLOCK = 400
_RNG = np.random.default_rng(20240607)
_A = (_RNG.integers(0, 2**32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint64).astype(np.uint32)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Per set and register the least 32-bit hash of its elements."""
    out = np.full((len(sets), REGISTERS), 2**32 - 1, np.uint32)
    for i, x in enumerate(sets):
        low = out[i]
        y = (mix(x) >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(y), 1024):
            v = _A[:, None] * y[at : at + 1024]
            v ^= v >> np.uint32(15)
            v += _B[:, None]
            np.minimum(low, v.min(axis=1), out=low)
    return out


def registers(low: np.ndarray) -> np.ndarray:
    """SetSketch registers (one byte each) of minima: floor(1 - log_b(h)), truncated to 0..255; an empty set is all 0."""
    u = (low.astype(np.float64) + 0.5) / 2**32
    k = np.floor(1 - np.log(-np.log1p(-u)) / math.log(BASE))
    return np.clip(k, 0, 255).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimate(greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard by maximum likelihood from how many registers of a exceed, or fall below, those of b, and the set sizes."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    equal = REGISTERS - greater - less

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def value(j):
        a, b = p(u - v * j), p(v - u * j)
        return greater * np.log(a) + less * np.log(b) + equal * np.log(np.maximum(1 - a - b, 1e-12))

    lo, hi = np.zeros_like(u), top.copy()
    for _ in range(32):  # the likelihood is unimodal: narrow the bracket by thirds
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = value(a) < value(b)
        lo, hi = np.where(left, a, lo), np.where(left, hi, b)
    return (lo + hi) / 2


def missed(similarity: float, rows: int) -> float:
    """The chance that a pair of this similarity meets in no band of ``rows`` registers, at the worst ratio of sizes."""
    u = similarity / (1 + similarity)
    p = [-math.log1p(-max(x, 0) * (BASE - 1) / BASE) / math.log(BASE) for x in (u - (1 - u) * similarity, 1 - u - u * similarity)]
    return (1 - (1 - sum(p)) ** rows) ** (REGISTERS // rows)


def band_rows(similarity: float) -> int:
    """The most registers of a band with which no more than MISS is lost at the threshold; 8 at most."""
    return next((k for k in range(8, 1, -1) if missed(similarity, k) <= MISS), 1)


def cut(similarity: float) -> float:
    """The least estimate at which a pair of at least ``similarity`` is still expected."""
    return similarity - SLACK * math.sqrt(similarity * (1 - similarity) / REGISTERS)


def band_codes(sketch: np.ndarray, rows: int) -> np.ndarray:
    """Each sketch's bands of ``rows`` registers (8 at most) as one number a band, equal where all its registers are."""
    bands = REGISTERS // rows
    wide = np.zeros((len(sketch), bands, 8), np.uint8)
    wide[:, :, :rows] = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    return wide.view(np.uint64)[:, :, 0]


SIGNATURE = "doc_id long, n long, s1 long, s2 long, sketch binary, h long"


def signatures(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, set size, two hashes of the word sequence, sketch, hash of the text; null texts are empty sets. No shuffle."""
    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                w = Words(*text_bytes(batch.column("text")))
                sets = list(w.shingles(words))
                seq = w.sequences().view(np.int64)
                sketch = registers(minima(sets))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(seq[:, 0]), pa.array(seq[:, 1]), pa.array([r.tobytes() for r in sketch], pa.binary()), batch.column("h")
                ], names=["doc_id", "n", "s1", "s2", "sketch", "h"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(work, SIGNATURE)


def _jaccard(batches, similarity, words):
    """Keep the pairs (a, b, ta, tb) whose full sets reach the similarity; sets of recent texts are kept at hand."""
    hundred = round(100 * similarity)
    kept: OrderedDict = OrderedDict()
    for whole in batches:
        for batch in pieces(whole, "ta", 2_000_000):
            need = {}
            for side in ("a", "b"):
                ids, col = batch.column(side).to_pylist(), batch.column("t" + side)
                for i, d in enumerate(ids):
                    if d not in kept and d not in need:
                        need[d] = col[i]
            if need:
                w = Words(*text_bytes(pa.array([v.as_py() for v in need.values()], pa.large_string())))
                kept.update(zip(need, w.shingles(words)))
            ok = []
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                p, q = kept[x], kept[y]
                both = len(p) + len(q) - len(np.union1d(p, q))
                ok.append(len(p) > 0 and len(q) > 0 and 100 * both >= hundred * (len(p) + len(q) - both))
            while len(kept) > 512:
                kept.popitem(last=False)
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])


def _plausible(batches, least):
    """Pairs with sketches and sizes -> pairs whose estimate is high enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.frombuffer(b"".join(batch.column("ka").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        y = np.frombuffer(b"".join(batch.column("kb").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        j = estimate((x > y).sum(1), (x < y).sum(1), batch.column("na").to_numpy().astype(float), batch.column("nb").to_numpy().astype(float))
        ok = pa.array(j >= least)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])


def _across(pdf, least, similarity, words, rows):
    """One pair of blocks -> confirmed links between different components, as few as join them.

    Sketches leave the plausible pairs; a pair is only looked at in its first common band. Full sets then decide, the
    likeliest pairs first, and a pair whose components a link has joined meanwhile needs no look.
    """
    import pandas as pd

    side = pdf.side.to_numpy()
    left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
    none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    if not len(left) or not len(right):
        return none
    sketch = np.frombuffer(b"".join(pdf.sketch), np.uint8).reshape(-1, REGISTERS)
    band = band_codes(sketch, rows)
    t, comp, ids, n = int(pdf.t.iat[0]), pdf.grp.to_numpy(), pdf.id.to_numpy(), pdf.n.to_numpy(float)
    p, q = [], []
    for k, i in enumerate(left):
        near = (comp[right] != comp[i]) & (np.minimum(n[right], n[i]) >= (similarity - 1e-9) * np.maximum(n[right], n[i]))
        if side[i] == 0:
            near[: k + 1] = False
        who = right[near]
        if t and len(who):
            who = who[~(band[who, :t] == band[i, :t]).any(axis=1)]
        if len(who):
            who = who[(sketch[who] == sketch[i]).sum(axis=1) >= REGISTERS * (least - 0.1)]
            p.append(np.full(len(who), i))
            q.append(who)
    if not p:
        return none
    p, q = np.concatenate(p), np.concatenate(q)
    j = np.concatenate([estimate((sketch[p[c : c + 20_000]] > sketch[q[c : c + 20_000]]).sum(1), (sketch[p[c : c + 20_000]] < sketch[q[c : c + 20_000]]).sum(1), n[p[c : c + 20_000]], n[q[c : c + 20_000]]) for c in range(0, len(p), 20_000)] or [np.zeros(0)])
    order = np.argsort(-j, kind="stable")
    order = order[j[order] >= least]
    p, q = p[order].tolist(), q[order].tolist()
    text, root, sets, out = pdf.text.to_numpy(), {}, {}, []

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def full(i):
        if i not in sets:
            sets[i] = frozenset(next(Words(*text_bytes(pa.array([text[i]], pa.large_string()))).shingles(words)).tolist())
        return sets[i]

    hundred = round(100 * similarity)
    for x, y in zip(p, q):
        a, b = find(comp[x]), find(comp[y])
        if a != b:
            u, v = full(x), full(y)
            both = len(u & v)
            if 100 * both >= hundred * (len(u) + len(v) - both):
                root[max(a, b)] = min(a, b)
                out.append((ids[x], ids[y]))
    return pd.DataFrame(out, columns=["a", "b"]) if out else none


def near_duplicates(docs: DataFrame, scratch: Scratch, words: int = 3, similarity: float = 0.85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Texts with fewer than ``words`` words are one shingle; null or empty ones are empty sets, linked with nothing.
    doc_id names a document: rows that share one are one node, which is compared with others by one of its texts, that
    of the least hash. A row with a null doc_id is linked with nothing and kept. Every link is confirmed on full sets; what the bands may miss is a link that no other link of its component
    replaces, with a chance below one in ten thousand at the threshold.
    """
    sig = scratch.write(signatures(docs, words), "signatures")
    live = sig.where("n > 0 and doc_id is not null")
    # written, so that joins back to it deal both sides anew and a very frequent text can be split
    node = scratch.write(live.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = live.join(node.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("id")).agg(F.min_by(F.struct("n", "sketch", "h"), "h").alias("x"))
    reps = scratch.write(reps.select("id", "x.n", "x.sketch", "x.h"), "nodes")

    rows = band_rows(similarity)
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sketch", k * rows + 1, rows)) for k in range(REGISTERS // rows)])
    band = reps.select("id", F.posexplode(keys).alias("t", "key"))
    shared = band.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    hot = scratch.write(band.join(shared, "key").select("key", "id", "t", "c"), "buckets")
    busy = hot.groupBy("id").agg(F.sum("c").alias("deg"))
    ranked = hot.join(busy, "id").select("key", "id", "deg")
    hub = ranked.groupBy("key").agg(F.max(F.struct("deg", (-F.col("id")).alias("i"))).alias("h")).select("key", (-F.col("h.i")).alias("b"))
    star = hot.join(hub, "key").where("id <> b").select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
    least = cut(similarity)

    def sketched(pairs):
        k = reps.select("id", "n", "sketch")
        p = pairs.join(k.toDF("a", "na", "ka"), "a").join(k.toDF("b", "nb", "kb"), "b")
        p = p.where(F.least("na", "nb") >= F.lit(similarity - 0.01) * F.greatest("na", "nb"))
        return p.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(lambda it: _plausible(it, least), "a long, b long")

    wanted = reps.select("id", "h").join(hot.select("id").distinct(), "id")
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text").join(wanted.hint("shuffle_hash"), ["id", "h"])
    texts = scratch.write(texts.select("id", "text"), "texts")

    def confirmed(pairs, name):
        p = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
        return scratch.write(p.mapInArrow(lambda it: _jaccard(it, similarity, words), "a long, b long"), name)

    first = confirmed(scratch.write(sketched(star), "plausible"), "links")
    comp = connected_components(scratch, first)
    placed = scratch.write(hot.select("key", "id", "t").join(comp, "id", "left").select("key", "id", "t", F.coalesce("component", "id").alias("grp")), "placed")
    mixed = placed.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi").select("key")
    open_ = placed.join(mixed, "key").select("key", "id", "grp", "t")
    tasks = block_pairs(open_, BLOCK).select("task", "side", "id", "grp", "t").join(reps.drop("h"), "id").join(texts, "id")
    second = scratch.write(tasks.groupBy("task").applyInPandas(lambda pdf: _across(pdf, least, similarity, words, rows), "a long, b long"), "links")
    comp = scratch.write(connected_components(scratch, first.union(second)), "components")

    named = node.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", F.coalesce("component", "rep").alias("c"))
    out = sig.join(named, ["s1", "s2"], "left")
    own = F.when((F.col("n") > 0) & F.col("c").isNotNull() & F.col("doc_id").isNotNull(), F.col("c")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    return scratch.finish(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op7_neardup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``documents``: 3-word shingles, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "neardup"), 3, 0.85)


def one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates (5-word shingles, 0.8) the smallest doc_id stays, in one row.

    Rows that repeat an id are one document, of which one row stays (the one whose columns hash least). Rows with a null
    id, and null and empty texts, are near nothing and stay, the latter once an id. An empty table stays empty; columns of
    any name keep their values.
    """
    scratch = Scratch(spark, "stage-neardup")
    names = docs.columns
    plain = docs.select(F.col("doc_id"), F.col("text"))
    found = near_duplicates(plain, scratch, 5, 0.8)
    gone = found.where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(names)
    twice = scratch.write(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"), "repeated")
    if twice.isEmpty():
        return left
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    one = left.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.xxhash64(row)).alias("_one")).select("_one.*")
    return left.join(twice, "doc_id", "left_anti").select(names).unionByName(one)


OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c(x, y) AS (SELECT x, y FROM e UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x),
m AS (SELECT x, min(y) AS low FROM c GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = d.doc_id
"""
