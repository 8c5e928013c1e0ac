"""Quality by a generalised additive model with pairwise interactions, whose terms are lookup tables.

Each feature of a text is cut into bins at quantiles. Boosting goes round the features in turn: a shallow tree over one
feature's bins takes a small step towards the labels, and its leaves are added to that feature's table. Then the pairs of
features whose product says most about what is left get tables of two dimensions in the same way, by trees with one cut
along either feature. A score is the sum of the entries that a text's bins point to, made a probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .filters import count_in, sorted_words
from .textops import K3, Words, mix, pieces, text_bytes
from .toxicity import held_out

#: Bound of the labelled sample: rows that the model is fitted on (the first ids by hash).
SAMPLE = 20_000
#: Bins of a feature and of a side of a pair's table, pairs, rounds at most, step, ridge, and the least weight of a leaf.
BINS, PAIR_BINS, PAIRS, ROUNDS, RATE, RIDGE, LEAF = 32, 8, 12, 300, 0.1, 1.0, 2.0
DEPTH = 2


def _bytes(*parts) -> np.ndarray:
    out = np.zeros(256, bool)
    for p in parts:
        out[list(p)] = True
    return out


_UPPER, _LOWER, _DIGIT = (_bytes(range(a, b + 1)) for a, b in ((65, 90), (97, 122), (48, 57)))
_HIGH, _SPACE, _POINT = _bytes(range(128, 256)), _bytes(b" \t\n\v\f\r"), ~_bytes(range(0x80, 0xC0))
_COMMA, _STOP, _LOUD, _QUOTE = _bytes(b",;:"), _bytes(b"."), _bytes(b"!?"), _bytes(b"\"'()-")
_MARK = ~(_UPPER | _LOWER | _DIGIT | _HIGH | _SPACE | _COMMA | _STOP | _LOUD | _QUOTE)
_LETTER = _UPPER | _LOWER | _HIGH

#: The features, all of the text alone.
FEATURES = (
    "words", "word_length", "longest_word", "capitals", "digits", "marks", "commas", "stops", "loud", "quotes", "spaces", "foreign", "distinct", "commonest", "repeated", "distinct_triples",
    "short_words", "shouted_words", "titled_words", "bare_marks", "marked_ends", "loud_ends", "lines", "line_length", "repeated_lines", "open_lines",
)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of FEATURES per text; shares of nothing are 0."""
    w = Words(data, off, lower=False)
    docs = len(off) - 1
    doc = np.repeat(np.arange(docs), np.diff(w.first))
    per = lambda x: np.bincount(doc, weights=x, minlength=docs)
    share = lambda a, b: np.divide(a, b, out=np.zeros(docs), where=np.asarray(b) > 0)
    n = np.diff(w.first).astype(float)
    points = count_in(data, off, _POINT).astype(float)
    of = lambda m: share(count_in(data, off, m), points)
    order_doc, order, new = sorted_words(w)
    starts = np.flatnonzero(new)
    runs = np.diff(np.r_[starts, len(order)])
    commonest = np.zeros(docs)
    np.maximum.at(commonest, order_doc[starts], runs)
    same_doc = doc[1:] == doc[:-1]
    repeated = np.zeros(len(doc))
    repeated[1:] = same_doc & (w.hash[1:] == w.hash[:-1])
    triple = np.zeros(len(doc), np.uint64)
    many = max(len(doc) - 2, 0)
    triple[:many] = mix(mix(w.hash[:many] * K3 + w.hash[1 : many + 1]) * K3 + w.hash[2 : many + 2])
    whole = np.zeros(len(doc), bool)
    whole[:many] = doc[:many] == doc[2 : many + 2]
    distinct_triples = _distinct(doc[whole], triple[whole], docs)
    end = w.start + w.length - 1
    within = lambda m: np.r_[0, np.cumsum(m[data])]
    letters, upper = within(_LETTER), within(_UPPER)
    in_word = lambda c: c[end + 1] - c[w.start]
    last = data[end] if len(end) else np.zeros(0, np.uint8)
    first = data[w.start] if len(end) else np.zeros(0, np.uint8)
    lines = Words(data, off, lower=False, classes=_IN_LINE)
    line_doc = np.repeat(np.arange(docs), np.diff(lines.first))
    n_lines = np.diff(lines.first).astype(float)
    line_end = data[lines.start + lines.length - 1] if len(lines.start) else np.zeros(0, np.uint8)
    out = (
        np.log1p(n), share(per(w.length), n), np.log1p(_most(doc, w.length, docs)), of(_UPPER), of(_DIGIT), of(_MARK), of(_COMMA), of(_STOP), of(_LOUD), of(_QUOTE), of(_SPACE), of(_HIGH & _POINT),
        share(np.bincount(order_doc[starts], minlength=docs), n), share(commonest, n), share(per(repeated), n), share(distinct_triples, np.maximum(n - 2, 0)),
        share(per(w.length <= 3), n), share(per((in_word(upper) >= 2) & (in_word(upper) == in_word(letters))), n), share(per(_UPPER[first]), n), share(per(in_word(letters) == 0), n),
        share(per(_MARK[last]), n), share(per(_LOUD[last]), n), np.log1p(n_lines), np.log1p(share(points, n_lines)), 1 - share(_distinct(line_doc, lines.hash, docs), n_lines) * (n_lines > 0) - (n_lines == 0),
        share(np.bincount(line_doc, weights=~(_STOP | _LOUD | _COMMA)[line_end], minlength=docs), n_lines),
    )
    return np.stack(out, axis=1)


_IN_LINE = ~_bytes(b"\n\r")


def _distinct(doc: np.ndarray, key: np.ndarray, docs: int) -> np.ndarray:
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    return np.bincount(d[new], minlength=docs).astype(float)


def _most(doc: np.ndarray, x: np.ndarray, docs: int) -> np.ndarray:
    out = np.zeros(docs)
    np.maximum.at(out, doc, x)
    return out


@dataclass
class Model:
    """Cuts between each feature's bins, its table, and tables of pairs over coarser cuts."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * len(FEATURES))
    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1)] * len(FEATURES))
    coarse: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * len(FEATURES))
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for rows of FEATURES."""
        z = np.full(len(x), self.base)
        for f, (cut, table_) in enumerate(zip(self.cuts, self.tables)):
            z += table_[np.searchsorted(cut, x[:, f], "right")]
        for f, g, table_ in self.pairs:
            z += table_[np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Where one feature is cut into at most ``bins`` bins that hold equally many of its values."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _gain(g, h):
    return g * g / (h + RIDGE)


def tree(g: np.ndarray, h: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """A shallow tree over the bins of one feature: each bin's step, from sums of gradients and curvatures by bin."""
    out = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    if depth == 0 or len(g) < 2:
        return out
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    c, d = g.sum() - a, h.sum() - b
    gain = np.where((b >= LEAF) & (d >= LEAF), _gain(a, b) + _gain(c, d), -np.inf)
    k = int(gain.argmax())
    if gain[k] <= _gain(g.sum(), h.sum()) + 1e-9:
        return out
    return np.r_[tree(g[: k + 1], h[: k + 1], depth - 1), tree(g[k + 1 :], h[k + 1 :], depth - 1)]


def cross(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut along either side of a pair's bins: the steps of the four quarters, and what they gain over none."""
    if min(g.shape) < 2:
        return np.zeros(g.shape), 0.0
    a, b = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    quarters = lambda s: (s[:-1, :-1], s[:-1, -1:] - s[:-1, :-1], s[-1:, :-1] - s[:-1, :-1], s[-1, -1] - s[:-1, -1:] - s[-1:, :-1] + s[:-1, :-1])
    qa, qb = quarters(a), quarters(b)
    gain = sum(_gain(x, y) for x, y in zip(qa, qb))
    gain = np.where(np.minimum.reduce(qb) >= 0.5, gain, -np.inf)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    if not np.isfinite(gain[i, j]):
        return np.zeros(g.shape), 0.0
    step = [x[i, j] / (y[i, j] + RIDGE) for x, y in zip(qa, qb)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = step
    return out, float(gain[i, j] - _gain(a[-1, -1], b[-1, -1]))


def boost(x: np.ndarray, y: np.ndarray, rounds: tuple[int, int], check: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[Model, tuple[int, int]]:
    """A model after ``rounds`` of boosting (of features, then of pairs), and after how many rounds it was best on ``check``."""
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Model(float(np.log(rate / (1 - rate))), [cuts(c, BINS) for c in x.T], [], [cuts(c, PAIR_BINS) for c in x.T], [])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, v, "right") for c, v in zip(model.cuts, x.T)]
    coarse = [np.searchsorted(c, v, "right") for c, v in zip(model.coarse, x.T)]
    z = np.full(len(y), model.base)
    best = [0, 0]

    def loss() -> float:
        p = np.clip(model.score(check[0]), 1e-9, 1 - 1e-9)
        return float(-(check[1] * np.log(p) + (1 - check[1]) * np.log(1 - p)).mean())

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    least = loss() if check else 0.0
    for number in range(rounds[0]):
        for f, at in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[f])
            step = RATE * tree(np.bincount(at, g, size), np.bincount(at, h, size))
            model.tables[f] = model.tables[f] + step
            z += step[at]
        if check and number % 10 == 9 and (now := loss()) < least - 1e-6:
            least, best[0] = now, number + 1
    g, h = slopes()
    shape = [len(c) + 1 for c in model.coarse]
    gains = []
    for a, b in combinations(range(x.shape[1]), 2):
        at, size = coarse[a] * shape[b] + coarse[b], shape[a] * shape[b]
        gains.append((cross(np.bincount(at, g, size).reshape(shape[a], shape[b]), np.bincount(at, h, size).reshape(shape[a], shape[b]))[1], a, b))
    chosen = [(a, b) for gain, a, b in sorted(gains, key=lambda t: (-t[0], t[1:]))[:PAIRS] if gain > 0]
    model.pairs = [(a, b, np.zeros((shape[a], shape[b]))) for a, b in chosen]
    for number in range(rounds[1]):
        for k, (a, b, known) in enumerate(model.pairs):
            g, h = slopes()
            at, size = coarse[a] * shape[b] + coarse[b], shape[a] * shape[b]
            step = RATE * cross(np.bincount(at, g, size).reshape(known.shape), np.bincount(at, h, size).reshape(known.shape))[0]
            model.pairs[k] = a, b, known + step
            z += step.ravel()[at]
        if check and number % 10 == 9 and (now := loss()) < least - 1e-6:
            least, best[1] = now, number + 1
    return model, (best[0], best[1])


def fit_rows(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> Model:
    """A model of rows of FEATURES with labels; ``part`` (0 to 4) says which rows choose the number of rounds (part 0)."""
    if not len(y) or y.min() == y.max():
        return Model()
    rounds = ROUNDS, ROUNDS // 2
    train = part != 0
    if len(np.unique(y[train])) == 2 and len(np.unique(y[~train])) == 2:
        _, rounds = boost(x[train], y[train], (ROUNDS, 0), (x[~train], y[~train]))
        _, rounds = boost(x[train], y[train], (rounds[0], ROUNDS // 2), (x[~train], y[~train])) if rounds[0] else (None, rounds)
        rounds = (max(rounds[0], 1), rounds[1])
    return boost(x, y, rounds)[0]


def featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the features of ``text`` in an array ``x``; no shuffle."""
    schema = docs.select(*keep).schema

    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                x = features(*text_bytes(batch.column("text")))
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), rows], names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(work, schema.add("x", T.ArrayType(T.DoubleType())))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled ids (the first by hash), of an id that repeats one text.

    A label that repeats counts as its greatest. Without both labels every text has the same score.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    one = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = featured(one, ["doc_id", "quality"]).groupBy("doc_id", "quality").agg(F.min("x").alias("x")).withColumn("part", F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(5))).toPandas().sort_values("doc_id")
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit_rows(x, rows["quality"].to_numpy(float), rows["part"].to_numpy())


def score_quality(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in ``name`` (replaced if it is there). Only the text is read.

    Rows are scored one by one, so repeated rows have equal scores; a null text is an empty one, whose features are 0.
    """
    schema = docs.drop(name).schema.add(name, "double")
    names = schema.fieldNames()[:-1]

    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                p = model.score(features(*text_bytes(batch.column("text"))))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(p, pa.float64())], names=[*names, name])

    return docs.mapInArrow(work, schema)


def op13_quality(spark, sf_dir: str) -> DataFrame:
    """A quality score for every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = score_quality(docs, fit(docs, labels), "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
