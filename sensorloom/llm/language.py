"""Language-model scores: a log-bilinear neural model trained with noise-contrastive estimation.

Word counts over all training texts come from a shuffle of per-piece counts; the frequent words, and the shapes of all
others, are the classes of the neural model. Its context is the two classes before; each task trains on its share of
the training texts from common weights, and the weights are averaged. Scoring takes the distinct contexts of a piece
at a time: one matrix product and a softmax give their normalised class log-probabilities. Within a class words share
by count. Unseen words have the mass that words seen once have, and share it evenly: there are as many of them as Chao's
estimate says (f1^2 / 2 f2, from the words seen once and twice). So the seen and the unseen words together have
probability one (less what classes without any training word hold), and no unseen word has more than its part.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table
from .packs import pack, unpacked
from .textops import Words

PIECE = 6_000_000
#: Frequent words that are classes of their own, dimensions, noise samples, examples in a step, learning rate.
FREQUENT, DIM, NOISE, STEP, RATE = 480, 24, 48, 2048, 0.1
#: Steps that a piece is trained for at least (small ones are gone through again), and how often it is gone through at most.
LEAST_STEPS, PASSES = 300, 40
#: Distinct words of all pieces that one task adds up.
WORDS_A_TASK = 2_000_000
END = np.uint64(0x9D5F3C71A2B4E687)
SHAPES = 40


def held_out(doc_id: int | None) -> bool:
    """crc32(doc_id as text) mod 7 = 2; a null id counts as empty text, so it is learned from."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


@dataclass
class Tokens:
    """A piece's tokens, each text closed by an end: hash, text number, shape; and which texts are held out."""

    hash: np.ndarray
    text: np.ndarray
    shape: np.ndarray
    first: np.ndarray
    held: np.ndarray


def read(got) -> Tokens:
    _, ids, known, off, data = got
    w = Words(data, off)
    n = np.diff(w.first)
    ends = w.first[1:] + np.arange(len(n))
    size = len(w.hash) + len(n)
    word = np.ones(size, bool)
    word[ends] = False
    h = np.full(size, END)
    h[word] = w.hash
    shape = np.zeros(size, np.int64)
    last = w.buf[w.start + w.length - 1] if len(w.start) else np.zeros(0, np.uint8)
    high = np.r_[0, np.cumsum(w.buf[: len(data)] > 127)]
    foreign = high[w.start + w.length] > high[w.start]
    tail = np.select([(last >= 97) & (last <= 122) | (last > 127), last == ord("."), last == ord(",")], [0, 1, 2], 3)
    shape[word] = np.minimum(w.length // 4, 4) * 8 + foreign * 4 + tail
    return Tokens(h, np.repeat(np.arange(len(n)), n + 1), shape, np.r_[0, ends + 1][:-1], np.array([held_out(int(i) if k else None) for i, k in zip(ids, known)], bool))


def _counts(batches, parts):
    """Each piece's distinct words, and how often training texts use them, by part."""
    for got in unpacked(batches):
        t = read(got)
        h, at = np.unique(t.hash, return_inverse=True)
        c = np.bincount(at, ~t.held[t.text], len(h)).astype(np.uint32)
        part = (h % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        h, c, part = h[order], c[order], part[order]
        cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
        yield pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]]), pa.array(np.full(len(cut) - 1, got[0]("piece"))), pa.array([h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()), pa.array([c[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["part", "piece", "words", "counts"])


TOTAL = "piece long, part int, x binary, a long, b long, c long, d long"


def _totals(pdf):
    """One part: each piece's counts over all pieces; and, under piece -1 to -3, sums, the most frequent words, and the ends."""
    import pandas as pd

    h = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf.words])
    c = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf.counts]).astype(np.int64)
    u, at = np.unique(h, return_inverse=True)
    total = np.bincount(at, c, len(u)).astype(np.int64)
    edge = np.r_[0, np.cumsum([len(b) // 8 for b in pdf.words])]
    part = int(pdf.part.iat[0])
    rows = [(p, part, total[at[a:b]].astype(np.int64).tobytes(), 0, 0, 0, 0) for p, a, b in zip(pdf.piece.tolist(), edge[:-1], edge[1:])]
    rows.append((-1, part, b"", int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum())))
    rows += [(-3, part, b"", int(total[i]), 0, 0, 0) for i in np.flatnonzero(u == END)]
    top = np.lexsort((u, -total))[:FREQUENT]
    rows += [(-2, part, b"", int(u[i].view(np.int64)), int(total[i]), 0, 0) for i in top if total[i] > 0 and u[i] != END]
    return pd.DataFrame(rows, columns=["piece", "part", "x", "a", "b", "c", "d"])


@dataclass
class Model:
    """Classes: shapes, the end, frequent words (by sorted hash), and one more that only begins a text."""

    frequent: np.ndarray
    weights: dict
    share: np.ndarray

    @classmethod
    def fresh(cls, frequent: np.ndarray, counts: np.ndarray, ends: int, other: int) -> Model:
        """Biases from word counts, so that the model starts as a unigram model."""
        order = np.argsort(frequent)
        n = len(frequent) + SHAPES + 1
        c = np.full(n, max(other, 1) / SHAPES)
        c[SHAPES], c[SHAPES + 1 :] = max(ends, 1), counts[order]
        p = c / c.sum()
        rng = np.random.default_rng(3)
        w = {"r": rng.normal(0, 0.1, (n + 1, DIM)), "q": rng.normal(0, 0.1, (n, DIM)), "c1": np.ones(DIM), "c2": np.full(DIM, 0.5), "b": np.log(p)}
        return cls(frequent[order], w, p)

    def classes(self, t: Tokens) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.frequent, t.hash), max(len(self.frequent) - 1, 0))
        known = self.frequent[at] == t.hash if len(self.frequent) else np.zeros(len(t.hash), bool)
        return np.where(known, SHAPES + 1 + at, np.where(t.hash == END, SHAPES, t.shape))

    def contexts(self, t: Tokens, cls: np.ndarray) -> np.ndarray:
        """The two classes before each token as one number; before a text's begin stands a class of its own."""
        n = len(self.share)
        one = np.r_[n, cls[:-1]] if len(cls) else cls
        one[t.first] = n
        two = np.r_[n, one[:-1]] if len(cls) else cls
        two[t.first] = n
        return one * (n + 1) + two

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        w, n = self.weights, len(self.share) + 1
        return w["r"][ctx // n] * w["c1"] + w["r"][ctx % n] * w["c2"]

    def log_probability(self, ctx: np.ndarray) -> np.ndarray:
        """(contexts, classes) normalised natural logarithms."""
        s = (self.hidden(ctx) @ self.weights["q"].T + self.weights["b"]).astype(np.float32)
        s -= s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))

    def train(self, ctx: np.ndarray, target: np.ndarray, times: np.ndarray, state: dict, rng) -> None:
        """Noise-contrastive steps over (context, target) pairs that stand ``times`` often; AdaGrad, shared noise.

        A pair weighs in every step what its times are to the mean, so that frequent pairs count as all their tokens do.
        """
        w, n = self.weights, len(self.share) + 1
        mean = times.mean() * STEP if len(times) else 1.0
        noise_bias = np.log(NOISE * self.share)
        order = rng.permutation(len(ctx))
        for at in range(0, len(order), STEP):
            i = order[at : at + STEP]
            one, two, y, m = ctx[i] // n, ctx[i] % n, target[i], times[i] / mean
            h1, h2 = w["r"][one], w["r"][two]
            h = h1 * w["c1"] + h2 * w["c2"]
            z = rng.choice(len(self.share), NOISE, p=self.share)
            real = (h * w["q"][y]).sum(1) + w["b"][y] - noise_bias[y]
            fake = h @ w["q"][z].T + w["b"][z] - noise_bias[z]
            g = -m / (1 + np.exp(np.clip(real, -30, 30)))
            f = m[:, None] / (1 + np.exp(-np.clip(fake, -30, 30)))
            gh = g[:, None] * w["q"][y] + f @ w["q"][z]
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            _add(grad["q"], y, g[:, None] * h)
            np.add.at(grad["q"], z, f.T @ h)
            grad["b"] += np.bincount(y, g, len(grad["b"]))
            np.add.at(grad["b"], z, f.sum(0))
            _add(grad["r"], one, gh * w["c1"])
            _add(grad["r"], two, gh * w["c2"])
            grad["c1"], grad["c2"] = (gh * h1).sum(0), (gh * h2).sum(0)
            for k, v in grad.items():
                state[k] += v * v
                w[k] -= RATE * v / np.sqrt(state[k] + 1e-8)


def _add(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add each row of values to the row of ``out`` it names."""
    order = np.argsort(rows, kind="stable")
    r = rows[order]
    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    out[r[first]] += np.add.reduceat(values[order], first)


WEIGHTS = ("r", "q", "c1", "c2", "b")


def _trained(batches, model: Model):
    """Train on one task's pieces; the weights times the tokens seen, and how often each class stands in training."""
    import copy

    m = copy.deepcopy(model)
    state = {k: np.full_like(v, 1e-4) for k, v in m.weights.items()}
    rng = np.random.default_rng(9)
    seen, totals = 0, np.zeros(len(m.share), np.int64)
    for got in unpacked(batches):
        t = read(got)
        cls = m.classes(t)
        keep = np.flatnonzero(~t.held[t.text])
        ctx = m.contexts(t, cls)[keep]
        totals += np.bincount(cls[keep], minlength=len(totals))
        seen += len(keep)
        if len(keep):
            pair, times = np.unique(ctx * len(m.share) + cls[keep], return_counts=True)
            for _ in range(min(PASSES, max(1, round(LEAST_STEPS * STEP / len(pair))))):
                m.train(pair // len(m.share), pair % len(m.share), times.astype(float), state, rng)
    flat = np.concatenate([m.weights[k].ravel() * seen for k in WEIGHTS] + [totals.astype(float), [float(seen)]])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat) // 4096 + 1, dtype=np.int32)), pa.array([flat[i : i + 4096].tobytes() for i in range(0, len(flat) + 1, 4096)][: len(flat) // 4096 + 1], pa.binary())], names=["chunk", "x"])


def _average(df: DataFrame) -> np.ndarray:
    """Sum of the tasks' vectors, chunk by chunk; as long as one task's vector."""
    import pandas as pd

    def add(pdf):
        return pd.DataFrame({"chunk": [pdf.chunk.iat[0]], "x": [np.sum([np.frombuffer(b) for b in pdf.x], axis=0).tobytes()]})

    rows = df.groupBy("chunk").applyInPandas(add, "chunk int, x binary").orderBy("chunk").collect()
    return np.concatenate([np.frombuffer(r["x"]) for r in rows]) if rows else np.zeros(0)


#: The contract's columns, and both scores over the known tokens alone.
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, base_known double, score_known double"


def unseen_words(once: int, twice: int) -> float:
    """Chao's estimate of how many words there are beside those seen; one at least."""
    return max(1.0, once * once / (2 * twice) if twice else once * (once - 1) / 2)


def _scored(batches, model: Model, parts: int, n: int, v: int, once: int, twice: int):
    """Each text's base and model log10 probability."""
    unseen = (once + 1) / (n + 2)
    each = np.log10(unseen / unseen_words(once, twice))
    for got in unpacked(batches):
        get, ids, known = got[:3]
        t = read(got)
        h, at = np.unique(t.hash, return_inverse=True)
        part = (h % np.uint64(parts)).astype(np.int64)
        count = np.zeros(len(h), np.int64)
        for reply in get("replies"):
            count[part == reply["part"]] = np.frombuffer(reply["x"], np.int64)
        c = count[at]
        cls = model.classes(t)
        ctx = model.contexts(t, cls)
        log = np.empty(len(cls))
        order = np.argsort(ctx, kind="stable")
        sorted_ = ctx[order]
        first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        edge = np.r_[first, len(order)]
        for s in range(0, len(first), 4096):
            e = min(s + 4096, len(first))
            lp = model.log_probability(sorted_[first[s:e]])
            who = order[edge[s] : edge[e]]
            log[who] = lp[np.repeat(np.arange(e - s), np.diff(edge[s : e + 1])), cls[who]]
        inside = np.where(c > 0, np.log(np.maximum(c, 1) / model.totals[cls]) + np.log1p(-unseen), 0)
        token = np.where(c > 0, (log + inside) / np.log(10), each)
        base = np.log10((c + 1) / (n + v + 1))
        k = len(ids)
        size = np.bincount(t.text, minlength=k)
        cols = [pa.array(ids, mask=~known), pa.array(t.held), pa.array(size), pa.array(np.bincount(t.text, c > 0, k).astype(np.int64)), pa.array(np.full(k, n)), *(pa.array(np.bincount(t.text, x, k)) for x in (base, token, np.where(c > 0, base, 0), np.where(c > 0, token, 0)))]
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in SCORE.split(", ")])


def score_texts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text) -> SCORE, one row per row.

    A null text is empty: one token, its end. A row with a null id is learned from and scored like others. Repeated rows
    are each learned from and scored alike. Very long texts are scored whole, in memory in proportion to their size.
    Where no row may be learned from, every word is unseen; an empty table gives an empty result. The weights are
    averages over tasks, so they, unlike the counts, differ a little with the number of tasks.
    """
    spark = scratch.spark
    packed, name = pack(docs, PIECE)
    try:
        size = packed.count()
        parts = max(12, size * 150_000 // WORDS_A_TASK + 1)
        told = packed.mapInArrow(lambda it: _counts(it, parts), "part int, piece long, words binary, counts binary")
        totals = scratch.write(told.groupBy("part").applyInPandas(_totals, TOTAL), "totals")
        n, v, once, twice = totals.where("piece = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in "abcd")).first()
        top = totals.where("piece = -2").orderBy(F.desc("b"), "a").limit(FREQUENT).collect()
        frequent, counts = np.array([r["a"] for r in top], np.int64).view(np.uint64), np.array([r["b"] for r in top], np.int64)
        ends = totals.where("piece = -3").agg(F.coalesce(F.sum("a"), F.lit(0))).first()[0]
        model = Model.fresh(frequent, counts, ends, n - int(counts.sum()) - ends)
        flat = _average(packed.mapInArrow(lambda it: _trained(it, model), "chunk int, x binary"))
        at, seen = 0, flat[-1] if len(flat) else 0
        for k in WEIGHTS if seen else ():
            shape = model.weights[k].shape
            model.weights[k] = flat[at : at + model.weights[k].size].reshape(shape) / seen
            at += model.weights[k].size
        model.totals = np.maximum(flat[at : at + len(model.share)], 1) if seen else np.ones(len(model.share))
        replies = totals.where("piece >= 0").groupBy("piece").agg(F.collect_list(F.struct("part", "x")).alias("replies"))
        out = packed.join(replies.hint("shuffle_hash"), "piece").mapInArrow(lambda it: _scored(it, model, parts, n, v, once, twice), SCORE)
        return scratch.finish(out)
    finally:
        spark.sql(f"DROP TABLE {name}")


def op3_language(spark, sf_dir: str) -> DataFrame:
    """Base and model scores of all ``documents``."""
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "language"))
