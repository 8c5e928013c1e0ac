"""Ranked lexical search over postings in the order of their impact.

The impact of a term in a document is a whole number, so postings of a term fall into groups of equal impact. A query
takes the groups of its terms by what they add to a score, greatest first, and adds them up. What the groups that are
left can add at most bounds every score; once no other document can reach the k-th best, the scores of those that
still can are completed from the documents' own postings. Nothing is left out: without such a proof all groups are read.

Documents are dealt to tasks as they are stored. A task holds the postings of a bounded number of documents at a time,
carries the best of each query from one such stretch to the next, and gives k rows a query at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, table
from .textops import Words, pieces, text_bytes

#: Results of a query; rows (query, term) that one search takes at once, so that what tasks are sent is bounded.
TOP, BLOCK = 20, 200_000
#: Postings that a task holds at once (one document at least).
STRETCH = 1_000_000
#: Parts of a query's best rows that are ranked by themselves before all of them are.
PARTS = 64

# The weights and lengths of the ranking.
SCALE, FIXED_SHARE, LENGTH_SHARE, SATURATION = 1_000_000_000, 75, 25, 12

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: Column) -> Column:
    """The terms of a text in their order: only A to Z are lower-cased; a null text has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(f"({TERM})"), F.lit(1))


class Vocabulary:
    """Some different terms, each found by the bytes of a word."""

    def __init__(self, terms: list[str]):
        data, off = text_bytes(pa.array([" ".join(terms)], pa.large_string()))
        self.words = Words(data, off, classes=_TERM)
        self.order = np.argsort(self.words.hash)
        self.sorted = self.words.hash[self.order]

    def places(self, w: Words) -> np.ndarray:
        """The number of each word's term, or -1."""
        out = np.full(len(w.hash), -1)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, w.hash), len(self.sorted) - 1)
            hit = np.flatnonzero(self.sorted[at] == w.hash)
            term = self.order[at[hit]]
            ok = w.same(hit, self.words, term)
            out[hit[ok]] = term[ok]
        return out


def postings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (all terms of the text), terms (those of the vocabulary that it has, each once) and tfs; no shuffle."""
    many = len(vocabulary.sorted)

    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                w = Words(*text_bytes(batch.column("text")), classes=_TERM)
                term = vocabulary.places(w)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
                keys, tf = np.unique(doc[term >= 0] * many + term[term >= 0], return_counts=True)
                off = pa.array(np.r_[0, np.cumsum(np.bincount(keys // max(many, 1), minlength=batch.num_rows))], pa.int32())
                lists = [pa.ListArray.from_arrays(off, pa.array(x, pa.int32())) for x in (keys % max(many, 1), tf)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(w.first), pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, n long, terms array<int>, tfs array<int>")


class Stretch:
    """The postings of some documents, grouped by term and impact, and by document."""

    def __init__(self, doc_id, n, off, term, tf, n_docs: int, n_terms: int, terms: int):
        length = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // max(n_terms, 1)
        self.doc_id, self.off, self.term = doc_id, off, term
        doc = np.repeat(np.arange(len(n)), np.diff(off))
        tf = tf.astype(np.int64)
        self.impact = (SCALE * tf) // (1000 * tf + SATURATION * length[doc])
        order = np.lexsort((-self.impact, term))
        t, i = term[order], self.impact[order]
        start = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (i[1:] != i[:-1])]) if len(order) else np.zeros(0, np.int64)
        self.doc, self.start, self.size = doc[order], start, np.diff(np.r_[start, len(order)])
        self.group_impact = i[start]
        self.groups = np.searchsorted(t[start], np.arange(terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, places) of documents among which are all that are of the k best, if ``least`` is a score to reach."""
        spans = [(self.groups[t], self.groups[t + 1], w) for t, w in zip(terms.tolist(), weights.tolist())]
        spans = [s for s in spans if s[0] < s[1] and s[2] > 0]
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not spans:
            return nothing
        group = np.concatenate([np.arange(a, b) for a, b, _ in spans])
        adds = np.concatenate([w * self.group_impact[a:b] for a, b, w in spans])
        after = np.concatenate([np.r_[w * self.group_impact[a + 1 : b], 0] for a, b, w in spans])  # the same term's next
        order = np.argsort(-adds, kind="stable")
        group, adds, after = group[order], adds[order], after[order]
        left = sum(w * int(self.group_impact[a]) for a, _, w in spans) + np.cumsum(after - adds)  # what may come, behind each group
        read = np.cumsum(self.size[group])
        total, score = int(read[-1]), np.zeros(len(self.doc_id), np.int64)
        at, reach = 0, max(total // 16, 4096)
        while at < len(group):
            end = max(at + 1, int(np.searchsorted(read, reach, "right")))
            size = self.size[group[at:end]]
            place = np.repeat(self.start[group[at:end]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            np.add.at(score, self.doc[place], np.repeat(adds[at:end], size))
            at, rest = end, int(left[end - 1])
            bar = max(least, int(np.partition(score, -k)[-k]) if len(score) >= k else 0, 1)
            if rest >= bar and at < len(group):  # a document not seen yet may still be among the best
                reach = int(read[end - 1]) * 2
                continue
            found = np.flatnonzero((score + rest >= bar) & (score > 0))
            if at == len(group):
                return score[found], found
            if (self.off[found + 1] - self.off[found]).sum() <= total - read[end - 1]:
                return self.complete(found, terms, weights), found
            reach = int(read[end - 1]) * 2
        return nothing

    def complete(self, found: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The whole scores of some documents, from their own postings."""
        weight = np.zeros(len(self.groups) - 1, np.int64)
        weight[terms] = weights
        size = self.off[found + 1] - self.off[found]
        place = np.repeat(self.off[found] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out = np.zeros(len(found), np.int64)
        np.add.at(out, np.repeat(np.arange(len(found)), size), weight[self.term[place]] * self.impact[place])
        return out


_LAST = np.iinfo(np.int64).max  # stands for a null doc_id: behind all others


def best_of(batches, queries: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, terms: int, k: int, stretch: int = STRETCH):
    """(query, doc_id, score) of the k best of each query over Arrow batches of postings."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)

    def take(parts):
        doc_id, n, size, term, tf = (np.concatenate(x) for x in zip(*parts))
        s = Stretch(doc_id, n, np.r_[0, np.cumsum(size)], term, tf, n_docs, n_terms, terms)
        for q, (t, w) in enumerate(queries):
            score, ids = best[q]
            more, found = s.search(t, w, k, int(score[-1]) if len(score) >= k else 0)
            if len(found):
                score, ids = np.r_[score, more], np.r_[ids, doc_id[found]]
                order = np.lexsort((ids, -score))[:k]
                best[q] = score[order], ids[order]

    held, many = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        sizes = np.diff(b.column("terms").offsets.to_numpy())
        full = np.cumsum(sizes)
        ids = b.column("doc_id").fill_null(int(_LAST)).to_numpy()
        n, term, tf = b.column("n").to_numpy(), b.column("terms").flatten().to_numpy(), b.column("tfs").flatten().to_numpy()
        at = 0
        while at < b.num_rows:
            base = int(full[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(full, base + stretch - many, "right")))
            last = int(full[end - 1])
            held.append((ids[at:end], n[at:end], sizes[at:end], term[base:last], tf[base:last]))
            many += last - base
            at = end
            if many >= stretch or at < b.num_rows:
                take(held)
                held, many = [], 0
    if held:
        take(held)
    query = np.repeat(np.arange(len(best), dtype=np.int32), [len(s) for s, _ in best])
    score, ids = (np.concatenate([b[c] for b in best]) if best else np.zeros(0, np.int64) for c in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids, mask=ids == _LAST), pa.array(score)], names=["query", "doc_id", "score"])


def search(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = TOP, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: for each of ``items`` (item_id, text) the k best of ``docs`` (doc_id, text).

    Every row of ``docs`` is a document, repeated ones too; rows with a null doc_id come last among equals. Null texts
    have no terms: such documents are never found, such items find nothing. Of rows that repeat an item_id the least text
    counts. Empty tables give no rows; other columns, of any name, are not read.

    Items are searched for in blocks of at most about ``block`` (item, term) rows, which is what the driver holds and
    sends to tasks; there is one block unless they are more. Each block reads the documents once.
    """
    spark = docs.sparkSession
    one = items.groupBy("item_id").agg(F.min("text").alias("text"))
    every = scratch.write(one.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("q")), "queries")
    blocks = math.ceil(every.count() / block)
    out = None
    for number in range(blocks):
        asked: dict = {}
        for r in every.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect():
            asked.setdefault(r["item_id"], []).append((r["term"], r["q"]))
        if not asked:
            continue
        terms = sorted({t for own in asked.values() for t, _ in own})
        place = {t: i for i, t in enumerate(terms)}
        index = scratch.write(postings(docs, Vocabulary(terms)), "postings")
        n_docs, n_terms = index.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r[0]: r[1] for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(terms))], np.int64)
        queries = [(at := np.array([place[t] for t, _ in own]), weight[at] * np.array([q for _, q in own])) for own in asked.values()]
        many = len(terms)
        found = index.where("size(terms) > 0").mapInArrow(lambda it: best_of(it, queries, n_docs, n_terms, many, k), "query int, doc_id long, score long")  # noqa: B023
        by = [F.desc("score"), F.asc_nulls_last("doc_id")]
        part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
        found = found.withColumn("part", part).withColumn("r", F.row_number().over(W.partitionBy("query", "part").orderBy(*by))).where(F.col("r") <= k)
        ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(*by))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(asked)), "query int, item_id long")
        ranked = scratch.write(ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "ranked")
        out = ranked if out is None else out.union(ranked)
    if out is None:
        out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return scratch.finish(out.coalesce(max(1, blocks)))


def op12_ranking(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all ``documents`` for each ``benchmark`` item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "ranking"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWERED}, '{TERM}') AS w FROM documents),
p AS MATERIALIZED (SELECT k, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT k, doc_id, unnest(w) AS term, len(w) AS n FROM d) GROUP BY k, term),
s AS MATERIALIZED (SELECT count(*) AS docs, sum(len(w)) AS terms FROM d WHERE len(w) > 0),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{TERM}')) AS term FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)),
i AS (SELECT item_id, term, count(*) AS q FROM q GROUP BY ALL),
w AS (SELECT item_id, term, q * CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM i JOIN f USING (term), s),
r AS (SELECT item_id, k, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + CAST((25 * n * docs) // terms AS BIGINT))))) AS BIGINT) AS score FROM w JOIN p USING (term), s GROUP BY item_id, k)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0) WHERE rank <= 20
"""
