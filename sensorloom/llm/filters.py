"""How quality filters act together: what each removes, and removes alone, in every order of applying them.

Texts are scanned as Arrow buffers: byte classes and their prefix sums count words, capitals, symbols and code points of
whole batches, sorted hashes of words (verified byte for byte) count the distinct ones. What a document fails is a mask
of five bits; counts by mask are all that the orders need.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table
from .textops import Words, pieces, text_bytes

# The filters and what a document fails them by.
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 3, b"#$%&*|"

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_POINT = np.ones(256, bool)
_POINT[0x80:0xC0] = False  # the later bytes of a code point


def count_in(data: np.ndarray, off: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """How many bytes of each text ``marked`` marks."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(marked[data], out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def sorted_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text so that equal ones stand together: their text, their place, and which begin a new word.

    Equal hashes are compared byte for byte; a text in which they belong to different words is sorted by its bytes.
    """
    texts = len(w.first) - 1
    doc = np.repeat(np.arange(texts), np.diff(w.first))
    bits = max(texts - 1, 1).bit_length()
    key = doc.astype(np.uint64) << np.uint64(64 - bits) | w.hash >> np.uint64(bits)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    again = np.flatnonzero(~new)
    wrong = ~w.same(order[again], w, order[again - 1])
    for d in np.unique(doc[order[again[wrong]]]).tolist():
        a, b = w.first[d], w.first[d + 1]
        own = sorted(range(a, b), key=w.word)
        order[a:b] = own
        new[a:b] = [k == 0 or w.word(own[k]) != w.word(own[k - 1]) for k in range(len(own))]
    return doc[order], order, new


def distinct_words(w: Words) -> np.ndarray:
    """The number of different words of each text."""
    doc, _, new = sorted_words(w)
    return np.bincount(doc[new], minlength=len(w.first) - 1)


def masks(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bit k is set where a text fails filter k, of the four that a text decides by itself."""
    w = Words(data, off, lower=False)
    words = np.diff(w.first)
    fails = (
        words < LEAST_WORDS, 100 * distinct_words(w) < DISTINCT_PERCENT * words, 100 * count_in(data, off, _CAPITAL) > CAPITAL_PERCENT * count_in(data, off, _POINT),
        count_in(data, off, _SYMBOL) > 0,
    )
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask, digest (SHA-256) of each row's doc_id, part and text; no shuffle."""
    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                data, off = text_bytes(batch.column("text"))
                digest = [hashlib.sha256(data[a:b]).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(masks(data, off), pa.int32()), pa.array(digest, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    return docs.select("doc_id", "part", "text").mapInArrow(work, "doc_id long, part string, mask int, digest binary")


def _reduced() -> tuple[list[str], dict[str, np.ndarray]]:
    """All orders, and for every order and step (a row) which masks (a column) it counts."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    mask = np.arange(1 << len(FILTERS))
    bit = np.array([[1 << FILTERS.index(f) for f in o] for o in orders])
    before = (np.cumsum(bit, axis=1) - bit).reshape(-1, 1)
    bit = bit.reshape(-1, 1)
    early, now = mask & before != 0, mask & bit != 0
    return orders, {"kept": ~early & ~now, "removed": ~early & now, "redundant": early & now, "unique_fails": np.broadcast_to(mask == bit, early.shape)}


RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _orders_of(pdf: pd.DataFrame) -> pd.DataFrame:
    """One part's counts by mask (at most 32 rows) -> its rows of the result."""
    orders, counted = _reduced()
    many = np.zeros((3, 1 << len(FILTERS)), np.int64)
    for k, c in enumerate(("n", "good", "toxic")):
        many[k, pdf["mask"]] = pdf[c]
    by = {k: m.astype(np.int64) @ many[0] for k, m in counted.items()}
    gone = counted["removed"].astype(np.int64)
    letters = np.array(list("".join(orders)))
    share = {f: by["removed"][letters == f].sum() for f in FILTERS}
    steps = len(FILTERS)
    return pd.DataFrame({
        "part": pdf["part"].iat[0], "filter_order": np.repeat(orders, steps), "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders)), **by,
        "good_lost": gone @ many[1], "toxic_lost": gone @ many[2], "shapley": [share[f] for f in letters],
    })


def audit_filters(docs: DataFrame, labels: DataFrame, scratch: Scratch, part: str = "lang") -> DataFrame:
    """What five filters do to each part of ``docs`` (doc_id, text and the column ``part``), in all 120 orders: RESULT.

    A null text is empty, a null part is ''. Filter E is failed by a row whose text a row with a smaller doc_id has too;
    rows with a null doc_id neither fail it nor make others fail, and rows that share a doc_id don't make each other fail.
    Of a document that ``labels`` (doc_id, quality, toxic) has more than once, any 1 counts. An empty table has no parts.
    Other columns, of any name, are not read.

    Only thin rows are shuffled: the first owner of each digest comes from an aggregation that is partly done before the
    shuffle, and rows meet it by digest and doc_id together, so that a very frequent text gathers nowhere.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    thin = scratch.write(scan(rows), "scanned")
    first = thin.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    again = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    met = thin.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + again).alias("mask")).join(known, "doc_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias({"quality": "good"}.get(c, c))
    counts = met.groupBy("part", "mask").agg(F.count("*").alias("n"), total("quality"), total("toxic"))
    return scratch.finish(counts.groupBy("part").applyInPandas(_orders_of, RESULT))


def op11_filters(spark, sf_dir: str) -> DataFrame:
    """The five filters over all ``documents``, by language."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "filters"))


OP11_SQL = r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT) + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) AS INT)
 + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask FROM d),
n AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, b)),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM x a, x b, x c, x d, x e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, CAST(k AS INT) AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0) AS before FROM o, range(1, 6) r(k)),
r AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
 coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
 coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost FROM n, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""
