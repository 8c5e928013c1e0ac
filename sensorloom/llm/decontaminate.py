"""Benchmark decontamination by latent semantic retrieval, then longest common subsequences and answer checks.

Passages are TF-IDF vectors over hashed words; a randomised SVD, whose product with the corpus runs as Spark tasks over
all documents, gives the latent space, of fewer dimensions than there are items. Each window of each document that holds
enough words of any item for the checks is projected there, and compared with each item by their cosine in it. A
candidate counts if the item's words stand in the document in order; a loose match counts only if the item's answer, its
last words, does.
"""

from __future__ import annotations

import math
from copy import copy
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import Scratch, table
from .textops import Words, pieces, text_bytes

FEATURES = 1 << 18
#: Words in the shortest window at most (windows are a quarter apart); least cosine of a candidate in the latent space, and
#: least share of the item's image there that a window as heavy as the item must have.
WINDOW, LATENT, COSINE = 16, 0.5, 0.4
#: Share of an item's words that must stand in order; with the answer's share found, less will do.
STRICT, LOOSE, ANSWER, ANSWER_WORDS = 0.75, 0.55, 0.8, 6
#: Words of a corpus passage; the latent space's rank as a share of the items, and the weight of all corpus passages
#: together to that of all items; items in a block.
PASSAGE, RANK, CORPUS, BLOCK = 64, 0.75, 0.1, 1000
#: Least idf of a word, as a share of the greatest.
FLOOR = 0.25
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 32


def tokens(column) -> Words:
    """Lower-case words (of any script) without ASCII punctuation."""
    data, off = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    return Words(_PLAIN[data], off, lower=False)


def feature(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (FEATURES - 1)


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, one machine-word-parallel step for each element of ``b``."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _frequencies(batches):
    """How many documents hold each hashed word: one vector a task, in chunks."""
    df, n = np.zeros(FEATURES, np.int64), 0
    for whole in batches:
        for batch in pieces(whole, "text"):
            w = tokens(batch.column("text"))
            text = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
            pair = np.sort((text << 18) | feature(w.hash))
            pair = pair[np.diff(pair, prepend=-1) != 0]
            df += np.bincount(pair & (FEATURES - 1), minlength=FEATURES)
            n += batch.num_rows
    yield _chunks(df, 1 << 14, n)


def _chunks(x: np.ndarray, size: int, n: int = 0) -> pa.RecordBatch:
    parts = [x[i : i + size] for i in range(0, len(x), size)]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([n] * len(parts), pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["chunk", "n", "x"])


def _total(df: DataFrame, kind) -> tuple[np.ndarray, int]:
    """Sum the chunks of all tasks as Spark groups; the sum is as long as one task's vector."""
    import pandas as pd

    def add(pdf):
        x = sum(np.frombuffer(b, kind) for b in pdf.x)
        return pd.DataFrame({"chunk": [pdf.chunk.iat[0]], "n": [pdf.n.sum()], "x": [np.asarray(x).tobytes()]})

    rows = df.groupBy("chunk").applyInPandas(add, "chunk int, n long, x binary").orderBy("chunk").collect()
    return np.concatenate([np.frombuffer(r["x"], kind) for r in rows]) if rows else np.zeros(0, kind), rows[0]["n"] if rows else 0


CHUNK = "chunk int, n long, x binary"


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """idf of every hashed word over all documents: never below a share FLOOR of what a word of no document has.

    So an item that stands in many documents keeps all its words, and other words beside them can't outweigh them.
    """
    df, n = _total(docs.select("text").mapInArrow(_frequencies, CHUNK), np.int64)
    if not n:
        return np.ones(FEATURES, np.float32)
    return np.maximum(np.log((n + 1) / (df + 0.5)), FLOOR * np.log(2 * (n + 1))).astype(np.float32)


def _images(w: Words, column: np.ndarray, idf: np.ndarray, gain: np.ndarray, span: int) -> np.ndarray:
    """The images of unit TF-IDF passages of ``span`` words; ``gain`` is what a use of each of the items' words adds."""
    f = feature(w.hash)
    passages = -(-np.diff(w.first) // span)
    text = np.repeat(np.arange(len(passages)), np.diff(w.first))
    row = (np.cumsum(passages) - passages)[text] + (np.arange(len(f)) - w.first[text]) // span
    norm = np.sqrt(np.bincount(row, idf[f].astype(float) ** 2, minlength=int(passages.sum())))
    live = np.flatnonzero(column[f] >= 0)
    row, col = row[live], column[f[live]]
    out = np.zeros((len(norm), gain.shape[1]), np.float32)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
    for k in range(0, len(first), 64):  # few passages at a time: what their words add stays in the cache
        at = first[k : k + 64]
        end = first[k + 64] if k + 64 < len(first) else len(row)
        out[row[at]] = np.add.reduceat(gain[col[at[0] : end]], at - at[0])
    return out / np.where(norm > 0, norm, 1)[:, None].astype(np.float32)


def latent_space(texts: DataFrame, items: Words, column: np.ndarray, idf: np.ndarray, rank: int) -> np.ndarray:
    """Columns of items' words -> latent coordinates, by a randomised SVD of the items and all corpus passages.

    The sketch is the range of the items (a random product with them), as wide as they are many: what has no part in it
    is no part of an item. The passages of all documents are projected there by Spark tasks, each of which gives back a
    matrix as large as the sketch is wide, squared; their sum and the items' own give the singular vectors. All corpus
    passages together weigh CORPUS of what all items do.
    """
    width, count = int(column.max()) + 1, len(items.first) - 1
    f = feature(items.hash)
    of = np.repeat(np.arange(count), np.diff(items.first))
    norm = np.sqrt(np.bincount(of, idf[f].astype(float) ** 2, minlength=count))
    own = np.zeros((count, width))
    there = column[f] >= 0
    np.add.at(own, (of[there], column[f[there]]), idf[f[there]] / norm[of[there]])
    noise = np.random.default_rng(5).standard_normal((width, min(count, width)))
    q = np.linalg.qr(own.T @ (own @ noise))[0]
    gain = (q * idf[column >= 0][:, None]).astype(np.float32)

    def product(batches):
        c, n = np.zeros((q.shape[1], q.shape[1])), 0
        for batch in batches:
            for part in pieces(batch, "text", 1_000_000):
                y = _images(tokens(part.column("text")), column, idf, gain, PASSAGE)
                c, n = c + y.T @ y, n + len(y)
        yield _chunks(c.ravel(), 1 << 17, n)

    c, n = _total(texts.select("text").mapInArrow(product, CHUNK), np.float64)
    y = own @ q
    c = y.T @ y / max(count, 1) + (c.reshape(q.shape[1], -1) if len(c) else 0) * (CORPUS / max(n, 1))
    _, vectors = np.linalg.eigh(c)
    return (q @ vectors[:, ::-1][:, :rank]).astype(np.float32)


def window_lengths(shortest: int, longest: int) -> list[int]:
    """Powers of two, from one of which an item of the least length fills seven eighths, up to the longest item."""
    spans = [WINDOW]
    while spans[0] * 7 > shortest * 8 and spans[0] > 1:
        spans.insert(0, spans[0] // 2)
    while spans[-1] < longest:
        spans.append(spans[-1] * 2)
    return spans


class Index:
    """Items in the latent space, with their words for the checks."""

    def __init__(self, ids: list, texts: list, idf: np.ndarray):
        self.ids, self.idf = ids, idf
        self.words = tokens(pa.array(texts, pa.large_string()))
        self.lists = [self.words.hash[a:b].tolist() for a, b in zip(self.words.first[:-1].tolist(), self.words.first[1:].tolist())]
        self.sorted = [np.unique(self.words.hash[a:b], return_counts=True) for a, b in zip(self.words.first[:-1].tolist(), self.words.first[1:].tolist())]
        size = [n for n in np.diff(self.words.first).tolist() if n]
        self.spans = window_lengths(min(size), max(size)) if size else []
        f = np.unique(feature(self.words.hash))
        f = f[idf[f] > 0]
        self.column = np.full(FEATURES, -1, np.int32)
        self.column[f] = np.arange(len(f))

    def project(self, basis: np.ndarray) -> None:
        """Items and words in the latent space: unit items, how much of each item its image holds, a word's share."""
        self.gain = np.zeros((len(basis) + 1, basis.shape[1]), np.float32)  # the last row is no word of the items
        self.gain[:-1] = basis * self.idf[self.column >= 0][:, None]
        self.items = np.zeros((len(self.ids), basis.shape[1]), np.float32)
        size = np.diff(self.words.first)
        self.items[size > 0] = _images(self.words, self.column, self.idf, self.gain, int(size.max(initial=1)))
        self.kept = np.linalg.norm(self.items, axis=1)
        self.items /= np.where(self.kept > 0, self.kept, 1)[:, None]
        self._rare_words()

    def _rare_words(self) -> None:
        """Items of about one length together: half the stretch that the checks look at, and the items' rare words.

        Of an item's words, LOOSE must stand in a stretch of 1.5 times its length. So many of the frequent ones as make up
        half of that are taken as there; of the rest, which are rare, the other half must be.
        """
        self.known = np.unique(self.words.hash)
        self.rare = []
        size = np.diff(self.words.first)
        group = np.floor(np.log(np.maximum(size, 1)) / math.log(1.25)).astype(int)
        for g in np.unique(group[size > 0]).tolist():
            items, need, which, word, times = np.flatnonzero((group == g) & (size > 0)), [], [], [], []
            for i, j in enumerate(items.tolist()):
                known, n = self.sorted[j]
                least = next(k for k in range(1, int(size[j]) + 1) if k / int(size[j]) >= LOOSE)
                often = np.lexsort((known, self.idf[feature(known)]))
                common = int(np.searchsorted(np.cumsum(n[often]), least // 3, "right"))
                need.append(least - int(n[often[:common]].sum()))
                which += [i] * (len(often) - common)
                word += np.searchsorted(self.known, known[often[common:]]).tolist()
                times += n[often[common:]].tolist()
            order = np.argsort(word, kind="stable")
            first = np.r_[0, np.cumsum(np.bincount(word, minlength=len(self.known)))]
            longest = int(size[items].max())
            self.rare.append((-(-(longest + longest // 2 + 1) // 2), items, np.array(need), first, np.array(which)[order], np.array(times)[order]))

    def possible(self, w: Words) -> np.ndarray:
        """Which texts can hold which items: (text, item), True where enough of the item's words stand near each other.

        Where it is False, fewer than LOOSE of the item's words stand in any stretch that the checks look at: a stretch is
        no longer than two blocks, so it lies in three that follow each other.
        """
        texts = len(w.first) - 1
        out = np.zeros((texts, len(self.ids)), bool)
        if not len(self.known):
            return out
        word = np.minimum(np.searchsorted(self.known, w.hash), len(self.known) - 1)
        live = np.flatnonzero(self.known[word] == w.hash)
        word, text = word[live], np.searchsorted(w.first, live, "right") - 1
        order = np.argsort(text * len(self.known) + word, kind="stable")
        same = (text[order][1:] == text[order][:-1]) & (word[order][1:] == word[order][:-1])
        before = np.full(len(live), -1)  # the word's use before this one in the text
        before[order[1:][same]] = order[:-1][same]
        place = live - w.first[text]
        for block, items, need, first, which, times in self.rare:
            blocks = -(-np.diff(w.first) // block) + 2
            start = np.r_[0, np.cumsum(blocks)]
            # a use counts in the stretches of three blocks that hold it, but not the word's use before it
            use = np.flatnonzero((first[1:] > first[:-1])[word])
            base, of_before = start[text[use]], before[use]
            at = base + place[use] // block
            low = np.maximum(base + np.where(of_before < 0, 0, place[of_before] // block + 1), np.maximum(at - 2, base))
            new = low <= at
            at, low, begin, many = at[new], low[new], first[word[use[new]]], np.diff(first)[word[use[new]]]
            of = np.repeat(np.arange(texts), blocks)
            some = max(1, 200_000 // len(items))
            for a in range(0, start[-1], some):  # a bounded number of blocks at a time, and the two behind them
                lo, hi = np.searchsorted(at, (a, a + some + 2))
                n = many[lo:hi]
                each = np.repeat(begin[lo:hi] - np.cumsum(n) + n, n) + np.arange(n.sum())
                add = lambda block: np.bincount(np.repeat(block, n) * len(items) + which[each], times[each], minlength=(some + 3) * len(items)).reshape(-1, len(items))  # noqa: B023, E731
                held = np.cumsum(add(np.maximum(low[lo:hi] - a, 0)) - add(at[lo:hi] - a + 1), axis=0)
                p, j = np.divmod(np.flatnonzero(held[: min(some, start[-1] - a)] >= need), len(items))
                out[of[a + p], items[j]] = True
        return out

    def search(self, w: Words) -> list[tuple[int, int, float, float, float]]:
        """What ``confirm`` lets pass of the candidates of all texts; texts that can't hold an item are left out before."""
        texts = len(w.first) - 1
        pairs = [(t, j) for t, j in np.argwhere(self.possible(w)).tolist() if self._share(j, w.hash[w.first[t] : w.first[t + 1]], True) >= LOOSE]
        keep = np.unique([t for t, _ in pairs]).astype(int)
        if not len(keep):
            return []
        part = copy(w)
        part.hash = w.hash[np.repeat(np.isin(np.arange(texts), keep), np.diff(w.first))]
        part.first = np.r_[0, np.cumsum(np.diff(w.first)[keep])]
        found = self.candidates(part)
        if len(found[0]):
            alive = np.isin(keep[found[0]] * len(self.ids) + found[1], [t * len(self.ids) + j for t, j in pairs])
            found = [x[alive] for x in found]
        return [(int(keep[r[0]]), *r[1:]) for r in self.confirm(part, found)]

    def candidates(self, w: Words):
        """Arrays (text, item, first word, last word, latent cosine) of windows that come near an item.

        A window's image must have a cosine of LATENT with the item's, and hold COSINE of it as measured by the whole
        window's weight, so that a few words of the item among many others are none. Windows begin at every quarter of
        their length, so a window is four blocks, and two blocks of one length are a block of the next: images are
        summed once, for the shortest blocks, and added up from there.
        """
        f = feature(w.hash)
        cum = np.r_[0, np.cumsum(self.idf[f].astype(np.float64) ** 2)]
        none = len(self.gain) - 1
        col = np.where(self.column[f] < 0, none, self.column[f])
        share = np.where(self.kept > 0, COSINE * self.kept, np.inf).astype(np.float32)
        spans = self.spans
        first_step = max(1, spans[0] // 4)
        size = np.diff(w.first)
        rows = np.r_[0, np.cumsum(-(-size // first_step) + 4)]
        rank = self.gain.shape[1]
        most, some = max(256, 2_000_000 // rank), max(1, 1_000_000 // len(self.ids))
        out = []
        at, texts = 0, len(size)
        while at < texts:  # texts with a bounded number of blocks at a time, a very long one by itself
            end = max(at + 1, int(np.searchsorted(rows, rows[at] + most, "right")) - 1)
            step, sums = first_step, None
            for span in spans:
                while sums is None or step < span // 4:
                    if sums is None:
                        text, a, stop, start = self._blocks(w.first[at : end + 1], step)
                        sums = np.zeros((len(a), rank), np.float32)
                        for k in range(step):
                            here = a + k < stop
                            sums += self.gain[np.where(here, col[np.where(here, a + k, 0)], none)]
                    else:
                        step *= 2
                        text, a, stop, after = self._blocks(w.first[at : end + 1], step)
                        left = np.minimum(start[text] + 2 * (np.arange(len(a)) - after[text]), start[text + 1] - 2)
                        sums, start = sums[left] + sums[left + 1], after
                b = np.minimum(a + span, stop)
                near = sums.copy()
                for k in range(1, span // step):
                    near[:-k] += sums[k:]
                full = np.sqrt(np.maximum(cum[b] - cum[np.minimum(a, b)], 0)).astype(np.float32)
                image = np.sqrt(np.einsum("ij,ij->i", near, near))
                live = np.flatnonzero((b > a) & (full > 0) & (image >= full * share.min(initial=np.inf)))
                for j in range(0, len(live), some):
                    i = live[j : j + some]
                    score = near[i] @ self.items.T
                    x, q = np.nonzero(score >= np.maximum(full[i][:, None] * share, LATENT * image[i][:, None]))
                    out.append((text[i[x]] + at, q, a[i[x]], b[i[x]], score[x, q] / image[i[x]]))
            at = end
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]

    @staticmethod
    def _blocks(first: np.ndarray, step: int):
        """Each text cut into blocks of ``step`` words and four empty ones: text, first word, end of text; first block."""
        n = -(-np.diff(first) // step) + 4
        start = np.r_[0, np.cumsum(n)]
        text = np.repeat(np.arange(len(n)), n)
        return text, first[text] + (np.arange(len(text)) - start[text]) * step, first[text + 1], start

    def confirm(self, w: Words, found) -> list[tuple[int, int, float, float, float]]:
        """(text, item, cosine, share of the item's words in order, share of the answer's) of what passes the checks."""
        text, j, a, b, cosine = found
        if not len(text):
            return []
        order = np.lexsort((a, j, text))
        text, j, a, b, cosine = (x[order] for x in (text, j, a, b, cosine))
        length = np.diff(self.words.first)[j]
        lo, hi = np.maximum(w.first[text], a - length), np.minimum(w.first[text + 1], b + length)
        group = np.cumsum(np.r_[True, (text[1:] != text[:-1]) | (j[1:] != j[:-1])]) * (len(w.hash) + 1)
        end = np.maximum.accumulate(hi + group)
        first = np.flatnonzero(np.r_[True, (lo + group)[1:] > end[:-1]])  # windows that overlap make one stretch
        rows = zip(text[first].tolist(), j[first].tolist(), lo[first].tolist(), np.maximum.reduceat(hi, first).tolist(), np.maximum.reduceat(cosine, first).tolist())
        out = []
        for (text, j), stretches in groupby(rows, key=lambda x: x[:2]):
            item, best = self.lists[j], (0.0, 0.0, 0.0)
            for _, _, lo, hi, cosine in stretches:
                share = self._share(j, w.hash[lo:hi])
                if share > best[1]:
                    answer = item[-ANSWER_WORDS:]
                    best = min(cosine, 1.0), share, lcs(answer, w.hash[lo:hi].tolist()) / len(answer)
                if share == 1:
                    break
            if best[1] >= STRICT or (best[1] >= LOOSE and best[2] >= ANSWER):
                out.append((text, j, *best))
        return out

    def _share(self, j: int, near: np.ndarray, most: bool = False) -> float:
        """The most of the item's words that stand in order within any stretch of 1.5 times its length; 0 if too few.

        No more can stand in order than stand there at all, so stretches where fewer than LOOSE stand are left out. They
        begin a quarter of the item apart; with ``most`` they are longer by that, so that wherever a stretch begins, its
        share is not above the result (or below LOOSE).
        """
        item = self.lists[j]
        step = max(1, len(item) // 4)
        size = len(item) + len(item) // 2 + 1 + (step if most else 0)
        known, times = self.sorted[j]
        which = np.minimum(np.searchsorted(known, near), len(known) - 1)
        at = np.flatnonzero(known[which] == near)
        last = max(0, -(-(len(near) - size) // step))
        if len(at) / len(item) < LOOSE:
            return 0.0
        # a use counts in the stretches that hold it, but not as many uses of its word before it as the item has
        order = np.argsort(which[at], kind="stable")
        word, place = which[at][order], at[order]
        before = np.arange(len(at)) - times[word]
        before = np.where((before >= 0) & (word[np.maximum(before, 0)] == word), place[np.maximum(before, 0)], -1)
        low, high = np.maximum(place - size, before) // step + 1, place // step
        ok = low <= np.minimum(high, last)
        held = np.cumsum(np.bincount(np.maximum(low, 0)[ok], minlength=last + 2) - np.bincount(np.minimum(high, last)[ok] + 1, minlength=last + 2))
        most = 0
        for k in np.flatnonzero(held / len(item) >= LOOSE).tolist():
            if held[k] > most:
                lo, hi = np.searchsorted(at, (k * step, k * step + size))
                most = max(most, lcs(item, near[at[lo:hi]].tolist()))
        return most / len(item)


HIT = "doc_id long, item_id long, cosine double, in_order double, answer double"


def contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, rank: float = RANK) -> DataFrame:
    """(doc_id, text) x (item_id, text) -> one row per document and item found in it: HIT.

    Word statistics and the latent space come from all documents. Items are taken in blocks of BLOCK, each against all
    documents. Null and empty texts match nothing; repeated rows are
    found alike; items that repeat are found under each id; without items or documents the result is empty.
    """
    texts = docs.select("doc_id", "text")
    items = benchmark.where("text is not null and item_id is not null").select("item_id", "text").orderBy("item_id", "text")
    idf = inverse_frequencies(texts)
    out = texts.sparkSession.createDataFrame([], HIT)
    block: list = []

    def search(block):
        nonlocal out
        index = Index([r["item_id"] for r in block], [r["text"] for r in block], idf)
        live = [k for k, x in enumerate(index.lists) if x]
        if not live or index.column.max() < 0:
            return
        index.project(latent_space(texts, index.words, index.column, idf, max(8, math.ceil(rank * len(live)))))

        def work(batches):
            for whole in batches:
                for batch in pieces(whole, "text", 1_000_000):
                    rows = index.search(tokens(batch.column("text")))
                    t, j, c, s, a = zip(*rows) if rows else ([], [], [], [], [])
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(t, pa.int64())), pa.array([index.ids[k] for k in j], pa.int64()), *(pa.array(x, pa.float64()) for x in (c, s, a))], names=[x.split()[0] for x in HIT.split(", ")])

        out = out.union(texts.mapInArrow(work, HIT))

    for r in items.toLocalIterator():
        block.append(r)
        if len(block) == BLOCK:
            search(block)
            block = []
    if block:
        search(block)
    return out


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every ``documents`` row against every ``benchmark`` item: the pairs found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "leaks"))


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in which a benchmark item is found go; the rest keep all their columns, of any name.

    Null and empty texts and rows with a null id stay; rows that repeat an id go or stay together.
    """
    scratch = Scratch(spark, "stage-leaks")
    hits = contaminated(docs, table(spark, sf_dir, "benchmark"), scratch).select("doc_id").where("doc_id is not null").distinct()
    return docs.join(scratch.write(hits, "hits"), "doc_id", "left_anti").select(docs.columns)
