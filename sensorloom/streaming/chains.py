"""Whole chains of rules on a stream.

Records of a rule's series meet in one stateful step, which runs all stages of the rule's chain in the order of event
time: what the watermark has passed is put in order (ms, then seq) and goes through window, sequence, window... as the
chain has them, each with its own state. So the number of shuffles and of state stores does not grow with the rules or
with the length of their chains, and results are those of a batch, as far as the watermark came, however the records
were dealt to micro-batches. Where a chain begins with a window, Spark has summed its records into panes before.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.sequences import STATEFUL
from ..operators.windows import EXACT, SQUARE
from ..plans.spec import WINDOW_OPS, Stage, parse_spec

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

#: Records as arrays: ms, seq, value (NaN where it is null).
Rows = tuple[np.ndarray, np.ndarray, np.ndarray]
NONE: Rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _half_up(x: float, places: int) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("1e-10"), ROUND_HALF_UP).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def rounded(x: np.ndarray, places: int = 4) -> np.ndarray:
    """Rounded half up through a decimal with ten places, as ``times.round_half_up`` does it."""
    with np.errstate(invalid="ignore", over="ignore"):
        y = np.abs(x) * 10.0**places
        out = np.where(np.isfinite(y), np.sign(x) * np.floor(y + 0.5) / 10.0**places, x)
        unsure = np.isfinite(y) & ((np.abs(y - np.floor(y) - 0.5) < 1e-4) | (y > 2**45) | (places > 6))
    out[unsure] = [_half_up(v, places) for v in x[unsure].tolist()]
    return out


def total(x: np.ndarray, places: int) -> int:
    """The sum of values that are rounded half up to some places, exact: as a number of units of the last place."""
    y = np.abs(x) * 10.0**places
    if len(x) and y.max() > 2**51:
        return sum(int(Decimal(repr(v)).scaleb(places).to_integral_value(ROUND_HALF_UP)) for v in x.tolist())
    return sum((np.sign(x) * np.floor(y + 0.5)).astype(np.int64).tolist())


class Pane:
    """What a stretch of a series adds to the windows over it."""

    __slots__ = ("rows", "n", "s", "q", "lo", "hi", "late", "every")

    def __init__(self, rows=0, n=0, s=0, q=0, lo=None, hi=None, late=None, every=NONE):
        self.rows, self.n, self.s, self.q, self.lo, self.hi, self.late, self.every = rows, n, s, q, lo, hi, late, every

    @staticmethod
    def of(rows: Rows, whole: bool) -> Pane:
        """The pane of some records; ``whole`` keeps the values themselves."""
        ms, seq, x = rows
        live = ~np.isnan(x)
        v = x[live]
        if not len(v):
            return Pane(len(x), every=rows if whole else NONE)
        last = np.lexsort((seq[live], ms[live]))[-1]
        late = int(ms[live][last]), int(seq[live][last]), float(v[last])
        return Pane(len(x), len(v), total(v, 9), total(v * v, 8), float(v.min()), float(v.max()), late, rows if whole else NONE)

    def merged(self, other: Pane) -> Pane:
        pick = lambda f, a, b: b if a is None else a if b is None else f(a, b)
        every = tuple(np.concatenate(p) for p in zip(self.every, other.every))
        return Pane(self.rows + other.rows, self.n + other.n, self.s + other.s, self.q + other.q, pick(min, self.lo, other.lo), pick(max, self.hi, other.hi), pick(max, self.late, other.late), every)

    def __getstate__(self):
        return [getattr(self, k) for k in self.__slots__]

    def __setstate__(self, held):
        for k, v in zip(self.__slots__, held):
            setattr(self, k, v)

    def result(self, op: str) -> float:
        """An operator's result over the pane, rounded as the operator is; NaN for null."""
        one = lambda v: float(rounded(np.array([v]))[0])
        n, s = self.n, self.s / 10**9
        if op == "SLOPE":
            k = self.rows
            if n < k or k < 2:
                return math.nan
            ms, seq, x = self.every
            order = np.lexsort((seq, ms))
            xy = sum((i + 1) * total(v, 9) for i, v in enumerate(x[order][:, None])) / 10**9
            ranks = k * (k + 1) / 2
            return one((k * xy - ranks * s) / (k * (k * (k + 1) * (2 * k + 1) / 6) - ranks * ranks))
        if not n:
            return math.nan
        if op in ("SUM", "MAX", "MIN", "PSEQ", "INTERP"):
            return {"SUM": s, "MAX": self.hi, "MIN": self.lo, "PSEQ": float(self.lo >= 0), "INTERP": self.late[2]}[op]
        if op == "MEDIAN":
            x = self.every[2]
            return one(float(np.median(x[~np.isnan(x)])))
        if op == "RANGE":
            return one(self.hi - self.lo)
        mean = one(s / n)
        if op == "AVG":
            return mean
        variance = one(max((self.q / 10**8 - 2 * mean * s + n * mean * mean) / n, 0.0))
        return variance if op == "VARIANCE" else one(math.sqrt(variance)) if op == "STD" else one(math.sqrt(variance) / mean) if mean else math.nan


class WindowStep:
    """A window stage; its state is the panes of the windows that are open, and the time up to which windows are closed."""

    def __init__(self, op: str, size: int, slide: int):
        self.op, self.size, self.slide, self.pane = op, size, slide, math.gcd(size, slide)
        self.whole = op in ("MEDIAN", "SLOPE")

    def _ends(self, pane: int) -> range:
        """The ends of the windows over a pane, the last first."""
        last = pane - pane % self.slide
        return range(last + self.size, pane, -self.slide)

    def run(self, state, rows: Rows, until: int, panes: list[tuple[int, Pane]] = ()) -> tuple[Rows, object]:
        """Take records and ready panes in; give the windows that end by ``until``."""
        held, closed = state or ({}, None)
        ms, seq, x = rows
        at = ms - ms % self.pane
        more = [(int(p), Pane.of((ms[at == p], seq[at == p], x[at == p]), self.whole)) for p in np.unique(at)]
        for p, pane in [*more, *panes]:
            p -= p % self.pane
            held[p] = held[p].merged(pane) if p in held else pane
        due = sorted({e for p in held for e in self._ends(p) if e <= until and (closed is None or e > closed)})
        out = []
        for end in due:
            inside = [held[p] for p in range(end - self.size, end, self.pane) if p in held]
            pane = inside[0]
            for other in inside[1:]:
                pane = pane.merged(other)
            out.append((end, end - self.size, pane.result(self.op)))
        held = {p: v for p, v in held.items() if max(self._ends(p), default=p) > until}
        columns = zip(*out) if out else NONE
        return tuple(np.array(c, t) for c, t in zip(columns, (np.int64, np.int64, float))), (held, until)

    def next(self, state, until: int) -> int | None:
        """When the next open window ends."""
        return min((e for p in (state or ({},))[0] for e in self._ends(p) if e > until), default=None)


class SequenceStep:
    """A stage that gives a result per record, from a few numbers of the records before."""

    def __init__(self, op: str, args: tuple):
        (self.f, self.places), self.args = STATEFUL[op], args

    def run(self, state, rows: Rows, until: int) -> tuple[Rows, object]:
        ms, seq, x = rows
        live = ~np.isnan(x)
        out = np.full(len(x), np.inf)
        if live.any():
            out[live], state = self.f(state, x[live], np.zeros(int(live.sum()), int), *self.args)
        there = ~np.isnan(out)
        value = np.where(np.isfinite(out[there]), out[there], np.nan)
        return (ms[there], seq[there], value if self.places is None else rounded(value, self.places)), state

    def next(self, state, until: int) -> None:
        return None


@cache
def steps(stages: tuple[Stage, ...]) -> list:
    return [WindowStep(s.op, *s.args) if s.op in WINDOW_OPS else SequenceStep(s.op, s.args) for s in stages if s.op != "RAW"]


def _ordered(rows: Rows) -> Rows:
    order = np.lexsort((rows[1], rows[0]))
    return tuple(c[order] for c in rows)


def _together(parts: list[Rows]) -> Rows:
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else NONE


class ChainProcessor(StatefulProcessor):
    """Runs each key's chain. Records: ms, seq, value, grain, and m, the moments of a whole pane that begins at ms.

    A record is ready when the watermark has passed the stretch of ``grain`` ms that it lies in, within which records
    may come in any order; one that comes after that is late and goes. Ready records leave what waits, of which a key
    holds no more than came within the lateness allowed (and one micro-batch).
    """

    def __init__(self, keys: list[str], stages: Callable[[tuple], tuple[Stage, ...]]):
        self.keys, self.stages = keys, stages

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "chunk binary")
        self.held = handle.getValueState("held", "state binary")

    def _load(self, grain: int) -> dict:
        return pickle.loads(self.held.get()[0]) if self.held.exists() else {"grain": grain, "done": None, "first": None, "timer": None, "steps": {}}

    def handleInputRows(self, key, rows, timerValues):
        held, parts, panes = None, [], []
        for pdf in rows:
            if not len(pdf):
                continue
            held = held or self._load(int(pdf["grain"].iat[0]))
            summed = pdf["m"].notna().to_numpy()
            alone = pdf[~summed]
            parts.append((alone["ms"].to_numpy(np.int64), alone["seq"].to_numpy(np.int64), pd.to_numeric(alone["value"]).to_numpy(float)))
            panes += [(int(ms), _pane(m)) for ms, m in zip(pdf["ms"][summed], pdf["m"][summed])]
        if held is not None:
            yield from self._advance(key, held, _together(parts), panes, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.held.exists():
            held = self._load(1)
            if held["timer"] is not None and held["timer"] <= expiredTimerInfo.getExpiryTimeInMs():
                held["timer"] = None
            yield from self._advance(key, held, NONE, [], timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, held: dict, new: Rows, panes: list, watermark: int):
        until = watermark // held["grain"] * held["grain"]
        if held["done"] is not None:
            on_time = new[0] >= held["done"]
            new = tuple(c[on_time] for c in new)
        ready = NONE
        if held["first"] is not None and held["first"] < until:
            every = _together([*(pickle.loads(c[0]) for c in self.waiting.get()), new])
            self.waiting.clear()
            held["first"], new = None, every
        now = new[0] < until
        ready, rest = (tuple(c[k] for c in new) for k in (now, ~now))
        if len(rest[0]):
            self.waiting.appendValue((pickle.dumps(rest),))
            held["first"] = min([int(rest[0].min()), *([held["first"]] if held["first"] is not None else [])])
        out, soon = _ordered(ready), []
        for k, step in enumerate(steps(self.stages(key))):
            more = {"panes": panes} if k == 0 and panes else {}
            out, held["steps"][k] = step.run(held["steps"].get(k), out, until, **more)
            soon.append(step.next(held["steps"][k], until))
        held["done"] = until if held["done"] is None else max(until, held["done"])
        if held["first"] is not None:
            soon.append((held["first"] // held["grain"] + 1) * held["grain"])
        wake = min((t for t in soon if t is not None), default=None)
        if wake is not None:
            wake = max(wake, watermark + 1)
            if held["timer"] is None or wake < held["timer"]:
                self.handle.registerTimer(wake)
                held["timer"] = wake
        self.held.update((pickle.dumps(held),))
        if len(out[0]):
            value = pd.Series(out[2]).astype(object).where(~np.isnan(out[2]), None)
            yield pd.DataFrame({**{n: [v] * len(out[0]) for n, v in zip(self.keys, key)}, "ms": out[0], "seq": out[1], "value": value})

    def close(self) -> None:
        pass


#: The moments of a pane as Spark sums them up; the values themselves only for operators that need them.
MOMENTS = "struct<rows:bigint,n:bigint,s:decimal(38,0),q:decimal(38,0),lo:double,hi:double,late:struct<ms:bigint,seq:bigint,v:double>,every:array<struct<ms:bigint,seq:bigint,v:double>>>"


def _pane(m) -> Pane:
    get = m.get if isinstance(m, dict) else lambda k: getattr(m, k)
    field = lambda r, k: r[k]
    late, every = get("late"), get("every")
    every = [] if every is None else list(every)
    rows = tuple(np.array([math.nan if field(r, k) is None else field(r, k) for r in every], t) for k, t in (("ms", np.int64), ("seq", np.int64), ("v", float)))
    return Pane(int(get("rows")), int(get("n")), int(get("s") or 0), int(get("q") or 0), get("lo"), get("hi"), None if late is None else (int(field(late, "ms")), int(field(late, "seq")), float(field(late, "v"))), rows)


def panes(df: DataFrame, keys: list[str], width: int, whole) -> DataFrame:
    """keys, grain, ms (the pane's begin), seq, value (null), m: records with ts under a watermark, summed into panes.

    ``whole`` is a condition for records whose values a pane keeps. Records are summed before they are shuffled.
    """
    v = F.col("value").cast("double")
    units = lambda x, t, k: F.sum((x.cast(t) * F.lit(10**k)).cast("decimal(38,0)"))
    row = F.struct("ms", "seq", v.alias("v"))
    m = F.struct(
        F.count(F.lit(1)).alias("rows"), F.count(v).alias("n"), units(v, EXACT, 9).alias("s"), units(v * v, SQUARE, 8).alias("q"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.max_by(row, F.when(v.isNotNull(), F.struct("ms", "seq"))).alias("late"), F.collect_list(F.when(whole, row)).alias("every"),
    )
    summed = df.groupBy(*keys, F.window("ts", f"{width} milliseconds").alias("w")).agg(m.alias("m"))
    return summed.select(*keys, F.lit(width).cast("long").alias("grain"), F.unix_millis("w.start").alias("ms"), F.lit(0).cast("long").alias("seq"), F.lit(None).cast("double").alias("value"), F.col("m").cast(MOMENTS).alias("m"))


def singles(df: DataFrame, keys: list[str], grain: int | Column = 1) -> DataFrame:
    """The same columns from records as they are; ``grain`` is one for all records of a key."""
    grain = grain if isinstance(grain, Column) else F.lit(grain)
    return df.select(*keys, grain.cast("long").alias("grain"), "ms", "seq", F.col("value").cast("double").alias("value"), F.lit(None).cast(MOMENTS).alias("m"))


def with_state_store(spark) -> None:
    """State of this kind lives in RocksDB."""
    if spark.conf.get(STORE[0], None) != STORE[1]:
        spark.conf.set(*STORE)


def run_chains(records: DataFrame, keys: list[str], stages: Callable[[tuple], tuple[Stage, ...]]) -> DataFrame:
    """keys, ms, seq, value: the results of the chain that ``stages`` gives each key, over records of singles and panes."""
    with_state_store(records.sparkSession)
    schema = ", ".join(f"`{k}` {records.schema[k].dataType.simpleString()}" for k in keys)
    return records.groupBy(*keys).transformWithStateInPandas(ChainProcessor(keys, stages), f"{schema}, ms long, seq long, value double", "append", "EventTime")


def spec_of(keys: list[str], last_wins: bool = False) -> Callable[[tuple], tuple[Stage, ...]]:
    """A key's stages from its calculate_type and param."""
    kind, param = keys.index("calculate_type"), keys.index("param")
    return lambda key: parse_spec(key[kind], key[param], last_wins)
