"""Toxicity by a weighted finite-state grammar over clauses, with a lexicon and clause weights learned from labels.

A text is read as symbols. Transducers, each a table of arcs with weights, turn them into matched words: insults and
threats match (a threat only behind a modal verb), a negation weakens what follows it closely, a reporting word or a
quotation weakens the rest, a target near by strengthens. The machines that look back are composed into one, which reads
the text from its begin; the one that looks ahead for a target reads what that writes from its end. The weight of a
clause is the sum over its matched words of their lexicon weight times the weights of the arcs taken; a logistic model
turns the clauses of a text into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table
from .textops import pieces

# Closed word classes of the grammar.
TARGETS = frozenset("you your yours he she him her they them their these those du dich dir ihr euch sie er tu te toi vous il elle ils ellos ellas usted ustedes vosotros el ella".split())
NEGATIONS = frozenset("not no never none neither nor isn't aren't don't doesn't wasn't won't nicht kein keine nie pas jamais aucun ni nunca jamas sin".split())
REPORTED = frozenset("said says say wrote writes claimed claims quoted reported called sagte sagt schrieb dit disait ecrit dijo dice escribio".split())
MODALS = frozenset("will would shall gonna going must should werde wird vais va voy vamos".split())
THREATS = frozenset("kill hurt destroy burn beat stab shoot die murder smash toten umbringen tuer frapper matar golpear".split())

SYMBOL = re.compile(r"\w+(?:'\w+)?|[.!?;\n\"]")
WORD = re.compile(r"\w+")
ENDS = frozenset(".!?;\n")
#: Lengths of the word beginnings that the lexicon may hold beside whole words; shorter words are never learned.
STEMS, SHORTEST = (4, 5, 6), 4
#: Bounds of the labelled sample (rows of either label), of the lexicon, and the evidence an entry needs.
SAMPLE_TOXIC, SAMPLE_CLEAN, ENTRIES, SUPPORT, PURITY = 2000, 4000, 100_000, 6, 0.7
#: How weights change inside a clause.
NEGATED, QUOTED, AIMED, THREAT, SCOPE = 0.4, 0.5, 1.25, 2.0, 3


# The symbols. O other, I insult, T threat, H matched, A matched and aimed at someone, G target, N negation,
# R reporting word, M modal verb, Q quotation mark, E end of a clause.
SYMBOLS = "OITHAGNRMQE"
CLOSED = {**{w: "G" for w in TARGETS}, **{w: "M" for w in MODALS}, **{w: "R" for w in REPORTED}, **{w: "N" for w in NEGATIONS}, **{c: "E" for c in ENDS}, '"': "Q"}

#: A transducer: its start, and (state, symbol read) -> (next state, symbol written, weight). Where an arc is missing the
#: state stays and the symbol is written as it is, with weight 1.
Machine = tuple[object, dict[tuple[object, str], tuple[object, str, float]]]


def insults() -> Machine:
    return 0, {(0, "I"): (0, "H", 1.0)}


def threats(weight: float = THREAT) -> Machine:
    """A threat matches only where a modal verb stands before it in its clause."""
    arcs = {(0, "M"): (1, "M", 1.0), (1, "E"): (0, "E", 1.0), (1, "T"): (1, "H", weight), (0, "T"): (0, "O", 1.0)}
    return 0, arcs


def follows(sign: str, reads: str, writes: str, weight: float, scope: int = SCOPE) -> Machine:
    """Words ``reads`` become ``writes`` with a weight within ``scope`` symbols behind a ``sign`` of their clause."""
    arcs = {}
    for left in range(scope + 1):
        for x in SYMBOLS:
            after = scope if x == sign else 0 if x == "E" else max(left - 1, 0)
            arcs[left, x] = (after, writes, weight) if left and x == reads else (after, x, 1.0)
    return 0, arcs


def reported(weight: float = QUOTED) -> Machine:
    """Matched words weigh less behind a reporting word of their clause, and between quotation marks."""
    arcs = {}
    for said in (False, True):
        for quoted in (False, True):
            arcs[(said, quoted), "R"] = ((True, quoted), "R", 1.0)
            arcs[(said, quoted), "Q"] = ((said, not quoted), "Q", 1.0)
            arcs[(said, quoted), "E"] = ((False, quoted), "E", 1.0)
            arcs[(said, quoted), "H"] = ((said, quoted), "H", weight if said or quoted else 1.0)
    return (False, False), arcs


class Composed:
    """Machines one behind the other, each reading what the one before writes: one machine with numbered states."""

    def __init__(self, *machines: Machine):
        first = tuple(start for start, _ in machines)
        number, self.arcs = {first: 0}, []
        todo = [first]
        while todo:
            state = todo.pop(0)
            row = {}
            for x in SYMBOLS:
                out, weight, after = x, 1.0, []
                for own, (_, arcs) in zip(state, machines):
                    to, out, w = arcs.get((own, out), (own, out, 1.0))
                    weight *= w
                    after.append(to)
                after = tuple(after)
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                row[x] = number[after], out, weight
            self.arcs.append(row)
        # how far a state moves over 0, 1, 2... other symbols, until it stands still
        self.others = []
        for k in range(len(self.arcs)):
            path = [k]
            while self.arcs[path[-1]]["O"][0] != path[-1]:
                path.append(self.arcs[path[-1]]["O"][0])
            self.others.append(path)

    def read(self, signs: Iterable[tuple[int, str]]) -> list[tuple[str, float]]:
        """(place, symbol) in the order of places, all others O -> what is written for each, and its weight."""
        state, last, out = 0, -1, []
        arcs, others = self.arcs, self.others
        for at, x in signs:
            path = others[state]
            state, y, w = arcs[path[min(at - last - 1, len(path) - 1)]][x]
            out.append((y, w))
            last = at
        return out


LOOK_BACK = Composed(insults(), threats(), follows("N", "H", "H", NEGATED), reported(), follows("G", "H", "A", AIMED))
LOOK_AHEAD = Composed(follows("G", "H", "A", AIMED))  # reads from the end; what is aimed already is A


@dataclass
class Model:
    """A lexicon (entry -> weight; an entry that ends in * is the beginning of a word), logistic coefficients, machines."""

    lexicon: dict[str, float] = field(default_factory=dict)
    coef: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 0.0, 0.0]))
    machines: tuple[Composed, Composed] = (LOOK_BACK, LOOK_AHEAD)

    def __post_init__(self):
        self.gate = {k[:SHORTEST] for k in self.lexicon} | {k[:SHORTEST] for k in THREATS}

    def weight(self, word: str) -> float:
        """The largest weight of the entries that ``word`` matches, or 0."""
        if word[:SHORTEST] not in self.gate:
            return 0.0
        return max([self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:k] + "*", 0.0) for k in STEMS)])

    def sign(self, word: str) -> tuple[str, float] | None:
        """A word's symbol and lexicon weight; None for O."""
        closed = CLOSED.get(word)
        if closed:
            return closed, 0.0
        if word[:SHORTEST] not in self.gate:
            return None
        w = self.weight(word)
        return ("I", w) if w else ("T", 1.0) if word in THREATS else None


def clauses(symbols: list[str], model: Model) -> list[float]:
    """The weight of each clause that has a matched word."""
    signs = [(i, *s) for i, s in ((i, model.sign(x)) for i, x in enumerate(symbols)) if s]
    if not any(x in "IT" for _, x, _ in signs):
        return []
    back, ahead = model.machines
    written = back.read((i, x) for i, x, _ in signs)
    end = len(symbols) - 1
    again = ahead.read((end - i, y) for (i, _, _), (y, _) in zip(reversed(signs), reversed(written)))[::-1]
    out, total, hit = [], 0.0, False
    for (_, x, w), (y, f), (_, g) in zip(signs, written, again):
        if y in "HA":
            total, hit = total + w * f * g, True
        elif x == "E":
            if hit:
                out.append(total)
            total, hit = 0.0, False
    return [*out, total] if hit else out


def features(text: str | None, model: Model) -> tuple[float, float, float]:
    """The strongest clause, the sum of all clauses (damped), and how dense they are; zeros where nothing matches."""
    lower = (text or "").lower()
    gate = model.gate
    words = WORD.findall(lower)
    if not any(w[:SHORTEST] in gate for w in words):
        return 0.0, 0.0, 0.0
    found = clauses(SYMBOL.findall(lower), model)
    if not found:
        return 0.0, 0.0, 0.0
    return max(found), math.log1p(sum(found)), math.log1p(100 * sum(found) / len(words))


def probability(x: np.ndarray, coef: np.ndarray) -> np.ndarray:
    z = coef[0] + x @ coef[1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.1, rounds: int = 100) -> np.ndarray:
    """Weighted ridge logistic regression; the first coefficient is the intercept.

    Newton steps over standardised features, each halved until it lowers the loss: a full step may overshoot without end.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 0, scale, 1.0)
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    c = np.zeros(a.shape[1])

    def loss(c):
        z = a @ c
        return (w * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * c @ c

    now = loss(c)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
        g = a.T @ (w * (y - p)) - ridge * c
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(c)), g)
        while np.abs(step).max() > 1e-9 and loss(c + step) > now:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        c = c + step
        now = loss(c)
    return np.r_[c[0] - (c[1:] * mean / scale).sum(), c[1:] / scale]


def _uses(batches):
    """(label, fold, entry, context): which words and word beginnings stand between which neighbours."""
    for whole in batches:
        for batch in pieces(whole, "text", 250_000):
            label, part, entry, context = [], [], [], []
            for text, toxic, fold in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), batch.column("fold").to_pylist()):
                words = WORD.findall((text or "").lower())
                for a, w, b in zip(["", *words], words, [*words[1:], ""]):
                    if len(w) >= SHORTEST:
                        forms = [w, *(w[:k] + "*" for k in STEMS if len(w) > k)]
                        entry += forms
                        context += [f"{a} {b}"] * len(forms)
                        label += [toxic] * len(forms)
                        part += [fold] * len(forms)
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(part, pa.int32()), pa.array(entry, pa.string()), pa.array(context, pa.string())], names=["toxic", "fold", "entry", "context"])


def _lexicon(seen: DataFrame, toxic: Column, clean: Column, even: float, support: int) -> dict[str, float]:
    """Entries whose contexts are nearly all toxic; the purest ENTRIES of them."""
    pure = seen.select("entry", toxic.alias("t"), clean.alias("n")).where(F.col("t") >= support).withColumn("purity", F.col("t") / (F.col("t") + F.col("n") * even))
    best = pure.where(F.col("purity") >= PURITY + (1 - PURITY) / 2).orderBy(F.desc("purity"), F.desc("t"), "entry").limit(ENTRIES).collect()
    return {r["entry"]: math.log((r["t"] + 0.5) / (r["n"] * even + 0.5)) for r in best}


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN) -> Model:
    """Learn from a bounded sample of labelled rows (the first ids of either label by hash; of an id that repeats one text).

    An entry's evidence is the number of different contexts it stands in, so copies of one text count once. The sample is
    halved by id: the logistic weights are learned from texts read with the other half's lexicon, so they don't trust a
    lexicon that has seen the text; the final lexicon is that of all. Without labels of both kinds the model has an empty
    lexicon and gives every text the same low score.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts.get(1) or not counts.get(0):
        return Model()
    first = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, sample_toxic), (0, sample_clean))]
    ids = first[0].union(first[1])
    one = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = scratch.write(one.withColumn("fold", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)).cast("int")), "sample")
    uses = sample.mapInArrow(_uses, "toxic int, fold int, entry string, context string").groupBy("toxic", "entry", F.xxhash64("context").alias("c")).agg(F.max(F.col("fold") == 0).alias("in0"), F.max(F.col("fold") == 1).alias("in1"))
    is_ = lambda k, c: F.sum(F.when((F.col("toxic") == k) & c, 1).otherwise(0))
    seen = scratch.write(uses.groupBy("entry").agg(*(is_(k, c).alias(f"{name}{part}") for k, name in ((1, "t"), (0, "n")) for part, c in (("", F.lit(True)), ("0", F.col("in0")), ("1", F.col("in1"))))).where(F.col("t") > 0), "entries")
    share = {r["toxic"]: r["k"] for r in sample.groupBy("toxic").agg(F.sum(F.length("text")).alias("k")).collect()}
    if not share.get(1) or not share.get(0):
        return Model()
    even = share[1] / share[0]  # clean uses count as if both labels had as much text
    rows = []
    for fold in (0, 1):
        other = 1 - fold
        half = Model(_lexicon(seen, F.col(f"t{other}"), F.col(f"n{other}"), even, SUPPORT // 2))
        rows += featured(sample.where(F.col("fold") == fold), half, keep=["doc_id", "toxic"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    model = Model(_lexicon(seen, F.col("t"), F.col("n"), even, SUPPORT))
    x = np.array([[r["x1"], r["x2"], r["x3"]] for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    w = np.where(y == 1, counts[1] / max(y.sum(), 1), counts[0] / max((1 - y).sum(), 1))
    model.coef = logistic(x, y, w / w.mean())
    return model


def featured(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the clause features x1, x2, x3 of ``text``."""
    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 1_000_000):
                x = [features(t, model) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *(pa.array(c, pa.float64()) for c in zip(*x))], names=[*keep, "x1", "x2", "x3"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in keep)
    keep = [f.name for f in docs.schema.fields if f.name in keep]
    return docs.select(*keep, "text").mapInArrow(work, f"{kept}, x1 double, x2 double, x3 double")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32(doc_id as text) mod 5 = 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def score_toxicity(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with a score from 0 to 1 in ``name`` (replaced if it is there). Only the text is read.

    Rows are scored one by one, so repeated rows have equal scores; null and empty texts get the score of no match.
    """
    schema = docs.drop(name).schema.add(name, "double")
    names = schema.fieldNames()[:-1]

    def work(batches):
        for whole in batches:
            for batch in pieces(whole, "text", 1_000_000):
                p = probability(np.array([features(t, model) for t in batch.column("text").to_pylist()]).reshape(-1, 3), model.coef)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(p, pa.float64())], names=[*names, name])

    return docs.mapInArrow(work, schema)


def train(spark, sf_dir: str, docs: DataFrame | None = None) -> Model:
    """A model from the ``labels`` of a data folder, without those of held-out rows."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scratch = Scratch(spark, "toxicity")
    model = fit(docs, labels, scratch)
    scratch.delete(scratch.root)
    return model


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """A toxicity score for every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose score is 0.5 or more go; the rest keep all their columns, of any name.

    Null and empty texts have the score of no match; repeated rows have equal scores and go or stay together; an empty
    table stays empty.
    """
    name = "_" + "_".join(docs.columns)  # no column of the caller's is called so
    return score_toxicity(docs, train(spark, sf_dir, docs), name).where(F.col(name) < 0.5).drop(name)
