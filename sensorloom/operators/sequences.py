"""Operators over a series in order (ms, then seq): lags, relative strength, and recursive filters."""

from __future__ import annotations

import pickle
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import parse_duration, round_half_up


def _order(keys: list[str]):
    return W.partitionBy(*keys).orderBy("ms", "seq")


def epochs(df: DataFrame, keys: list[str], lag: Column, chunk=None) -> DataFrame:
    """``df`` with _epoch, which grows where a record's ``lag`` differs from the one before: a changed lag starts anew.

    With ``chunk`` changes are counted inside chunks of time, and what the chunks before add comes from their few counts.
    """
    cols = df.columns
    cut, by = with_before(df.withColumn("_n", lag), keys, 1, chunk)
    before = F.lag("_n").over(_order(by))
    marked = cut.withColumn("_changed", F.coalesce((before != F.col("_n")).cast("long"), F.lit(0))).where("not _halo")
    inside = F.sum("_changed").over(_order(by).rowsBetween(W.unboundedPreceding, 0))
    if chunk is None:
        return marked.withColumn("_epoch", inside).select(*cols, "_epoch")
    at = F.struct(*by).alias("_at")
    counts = marked.groupBy(*by).agg(F.sum("_changed").alias("_many"))
    earlier = F.coalesce(F.sum("_many").over(W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = counts.select(at, earlier.alias("_earlier"))
    return marked.withColumn("_inside", inside).withColumn("_at", at).join(placed, "_at").withColumn("_epoch", F.col("_inside") + F.col("_earlier")).select(*cols, "_epoch")


#: Bytes of records up to which series are not worth cutting: one task sorts them all.
LONG = 1 << 28


def cut_if_long(df: DataFrame, chunk: str, most: int = LONG) -> str | None:
    """``chunk`` if the records may be more than ``most`` bytes, by the optimiser's estimate, which costs no job; else None."""
    return chunk if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > most else None


def with_before(df: DataFrame, keys: list[str], n: int, chunk) -> tuple[DataFrame, list[str]]:
    """``df`` cut by time into chunks, each with the n records before it; and the keys of a chunk.

    So a long series is many tasks' work instead of one's. Each chunk's last n records are found first (a limit inside
    every task leaves few to shuffle); from those of all earlier chunks, however sparse, each chunk gets its n. Rows
    that only stand before a chunk have _halo true. Without ``chunk`` a series is one chunk.
    """
    if chunk is None:
        return df.withColumn("_halo", F.lit(False)), keys
    ms = parse_duration(chunk) if isinstance(chunk, str) else int(chunk)
    cols = df.columns
    d = df.withColumn("_chunk", F.floor(F.col("ms") / ms))
    back = W.partitionBy(*keys, "_chunk").orderBy(F.desc("ms"), F.desc("seq"))
    tails = d.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= n)
    w = _order(keys)
    before = F.collect_list(F.struct(*cols)).over(w.rowsBetween(-n, -1))
    lead = tails.withColumn("_before", before).withColumn("_new", F.coalesce(F.lag("_chunk").over(w) != F.col("_chunk"), F.lit(False)))
    halo = lead.where("_new").select("_chunk", F.explode("_before").alias("_b")).select("_b.*", "_chunk", F.lit(True).alias("_halo"))
    return d.withColumn("_halo", F.lit(False)).unionByName(halo), [*keys, "_chunk"]


def lagged(df: DataFrame, ops: dict[str, tuple[str, int]], keys: list[str], chunk=None) -> DataFrame:
    """``df`` with LAST, VAR or TREND columns (name -> (operator, n)); equal orders share one sort.

    LAST is the value n records earlier, VAR the change since, TREND the ratio to it (null over 0), both null until
    there are n records before. ``chunk``: see with_before.
    """
    cols = df.columns
    df, by = with_before(df, keys, max(n for _, n in ops.values()), chunk)
    w = _order(by)
    v = F.col("value").cast("double")
    for name, (op, n) in ops.items():
        old = F.lag("value", n).over(w).cast("double")
        df = df.withColumn(name, {"LAST": old, "VAR": round_half_up(v - old), "TREND": round_half_up(F.try_divide(v, old))}[op])
    return df.where("not _halo").select(*cols, *ops)


def lag_stage(df: DataFrame, op: str, n: int, keys: list[str], changing: Column | None = None, chunk=None) -> DataFrame:
    """``df`` with value replaced by the operator's; records without n predecessors go. ``changing``: see epochs."""
    by, cols = keys, df.columns
    if changing is not None:
        df, by = epochs(df, keys, changing, chunk), [*keys, "_epoch"]
    df, by = with_before(df, by, n, chunk)
    old = F.lag("value", n).over(_order(by)).cast("double")
    there = F.lag(F.lit(1), n).over(_order(by))
    v = F.col("value").cast("double")
    out = {"LAST": old, "VAR": round_half_up(v - old), "TREND": round_half_up(F.try_divide(v, old))}[op]
    return df.withColumn("_out", out).withColumn("_there", there).where("_there is not null and not _halo").withColumn("value", F.col("_out")).select(*cols)


def rsi(df: DataFrame, n: int, keys: list[str], chunk=None) -> DataFrame:
    """Relative strength over the last n changes (the first record's is 0), from the nth record on.

    No losses gives 100; neither gains nor losses gives null. ``chunk``: see with_before.
    """
    cols = df.columns
    df, by = with_before(df, keys, n, chunk)
    w = _order(by)
    exact = F.col("value").cast("decimal(28,9)")
    change = F.coalesce(exact - F.lag(exact).over(w), F.lit(0).cast("decimal(28,9)"))
    d = df.withColumn("_d", change).withColumn("_there", F.lag(F.lit(1), n - 1).over(w) if n > 1 else F.lit(1))
    frame = w.rowsBetween(-(n - 1), 0)
    gain = F.sum(F.greatest(F.col("_d"), F.lit(0))).over(frame).cast("double")
    loss = F.sum(F.greatest(-F.col("_d"), F.lit(0))).over(frame).cast("double")
    strength = F.when(loss == 0, F.when(gain > 0, F.lit(100.0))).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))
    return d.withColumn("_out", round_half_up(strength)).where("_there is not null and not _halo").withColumn("value", F.col("_out")).select(*cols)


# ---- operators that carry a state: (state, values, series numbers) -> (values, state) ------------------------------
# Values stand in the order of their series; ``series`` says to which each belongs, and the state given is that of the
# first one, the state returned that of the last. A NaN says that there is no result yet (no row), an infinity that the
# result is null.


def _parts(series: np.ndarray):
    cut = np.flatnonzero(np.r_[True, series[1:] != series[:-1], True]) if len(series) else np.zeros(1, int)
    return zip(cut[:-1].tolist(), cut[1:].tolist())


def _smooth(state, x: np.ndarray, series: np.ndarray, share: float):
    """y = share*x + (1-share)*y over all series at once."""
    if not len(x):
        return x, state
    if state is not None:
        x, series = np.r_[state, x], np.r_[series[0], series]
    y = pd.Series(x).groupby(series).ewm(alpha=share, adjust=False).mean().to_numpy()
    return (y[1:] if state is not None else y), float(y[-1])


def fof(state, x, series, a: float):
    """First-order low-pass: y = a*x + (1-a)*y."""
    if a <= 0 or a > 1:  # outside the range of a mean: step by step
        out = np.empty(len(x))
        for i, (v, k) in enumerate(zip(x, series)):
            state = v if state is None or (i and k != series[i - 1]) else a * v + (1 - a) * state
            out[i] = state
        return out, state
    return _smooth(state, x, series, a)


def ema(state, x, series, n: int):
    """Exponential mean: e = (2*x + (n-1)*e) / (n+1)."""
    return _smooth(state, x, series, 2 / (n + 1))


def dif(state, x, series, fast: int, slow: int):
    """Fast exponential mean less the slow one."""
    a, b = state or (None, None)
    y, a = ema(a, x, series, fast)
    z, b = ema(b, x, series, slow)
    return y - z, (None if a is None else (a, b))


def dejump(state, x, series, low: float, high: float):
    """A value that leaves [low, high] from the last accepted one is replaced by that one."""
    out = x.tolist()
    for s, e in _parts(series):
        state = state if s == 0 else None
        for i in range(s, e):
            v = out[i]
            if state is None or low <= v - state <= high:
                state = v
            else:
                out[i] = state
    return np.array(out, float), state


@cache
def _gains(dt: float, r: float) -> list[tuple[float, float]]:
    """The gains of each step, which no value changes, up to where they stand still."""
    out, a, b, c = [], 1.0, 0.0, 1.0
    while len(out) < 2 or (out[-1] != out[-2] and len(out) < 100_000):
        a, b, c = a + 2 * dt * b + dt * dt * c + 0.05, b + dt * c + 0.05, c + 0.05
        s = a + r
        g, h = a / s, b / s
        out.append((g, h))
        a, b, c = a - g * a, b - g * b, c - h * b
    return out


def kalman(state, x, series, dt: float, r: float):
    """Constant-velocity Kalman filter; what it foresees for each record before it has seen it."""
    gains, out = _gains(dt, r), x.tolist()
    last = len(gains) - 1
    for s, e in _parts(series):
        p, v, k = state if s == 0 and state is not None else (out[s], 0.0, 0)
        for i in range(s, e):
            g, h = gains[k]
            p += dt * v
            z, out[i] = out[i], p
            z -= p
            p, v, k = p + g * z, v + h * z, min(k + 1, last)
        state = p, v, k
    return np.array(out, float), state


def _earlier(state, x, series, n: int):
    """Each record's value n records earlier (NaN where there is none), and the last n values."""
    held = [] if state is None else list(state)
    out = np.full(len(x), np.nan)
    for s, e in _parts(series):
        every = np.r_[held, x[s:e]] if s == 0 else x[s:e]
        k = len(every) - (e - s)  # values before this stretch
        have = np.arange(e - s) + k - n
        out[s:e][have >= 0] = every[have[have >= 0]]
        held = every[-n:].tolist()
    return out, held or None


def last(state, x, series, n: int):
    """The value n records earlier."""
    return _earlier(state, x, series, n)


def var(state, x, series, n: int):
    """The change since n records earlier."""
    old, state = _earlier(state, x, series, n)
    return x - old, state


def trend(state, x, series, n: int):
    """The ratio to the value n records earlier; none over 0."""
    old, state = _earlier(state, x, series, n)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(old == 0, np.inf, x / old), state


def strength(state, x, series, n: int):
    """Relative strength over the last n changes, the first of a series being 0; see rsi."""
    held = state
    out = np.full(len(x), np.nan)
    for s, e in _parts(series):
        before, changes = held if s == 0 and held else (x[s], [])
        d = np.round(np.diff(np.r_[before, x[s:e]]), 9)
        every = np.r_[changes, d]
        up, down = (np.r_[0, np.cumsum(np.round(np.maximum(y, 0) * 1e9))] for y in (every, -every))
        at = np.arange(len(changes), len(every)) + 1
        ok = at >= n
        gain, loss = (np.where(ok, y[at] - y[np.maximum(at - n, 0)], 0) for y in (up, down))
        with np.errstate(divide="ignore", invalid="ignore"):
            out[s:e] = np.where(ok, np.where(loss == 0, np.where(gain > 0, 100.0, np.inf), 100 - 100 / (1 + gain / loss)), np.nan)
        held = float(x[e - 1]), every[-n:].tolist()
    return out, held


#: operator -> (function, decimal places of its result)
FILTERS = {"FOF": (fof, 4), "EMA": (ema, 8), "DIF": (dif, 9), "DEJUMP": (dejump, None), "KF": (kalman, 4)}
#: The operators that Spark's windows have too; here for streams and for rules with arguments of their own.
LAGS = {"LAST": (last, None), "VAR": (var, 4), "TREND": (trend, 4), "RSI": (strength, 4)}
STATEFUL = FILTERS | LAGS


def _pieces(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """The number of the series that each row of a sorted batch belongs to; null keys are one series."""
    new = np.zeros(len(pdf), bool)
    for k in keys:
        x = pdf[k]
        same = (x == x.shift()) | (x.isna() & x.shift().isna())
        new |= ~same.fillna(False).to_numpy(bool)
    new[:1] = False
    return np.cumsum(new)


# ---- what a chunk of a series does to a filter's state, whatever that state is --------------------------------------


class Smoothed:
    """y = share*x + (1-share)*y over a chunk is an affine map of the y before it."""

    def __init__(self, share: float):
        self.share, self.n, self.first, self.end = share, 0, 0.0, None

    def add(self, x: np.ndarray) -> None:
        weights = self.share * (1 - self.share) ** np.arange(len(x) - 1, -1, -1)
        if not self.n:
            self.first = self.end = float(x[0])
        self.end = (1 - self.share) ** len(x) * self.end + float(weights @ x)
        self.n += len(x)

    def after(self, state):
        """The state behind the chunk, from the one before it (None: the series begins with the chunk)."""
        if state is None or not self.n:
            return self.end if self.n else state
        kept = (1 - self.share) ** self.n
        return kept * state + (self.end - kept * self.first)


class Difference:
    """Two smoothed series."""

    def __init__(self, fast: int, slow: int):
        self.parts = Smoothed(2 / (fast + 1)), Smoothed(2 / (slow + 1))

    def add(self, x: np.ndarray) -> None:
        for p in self.parts:
            p.add(x)

    def after(self, state):
        out = tuple(p.after(s) for p, s in zip(self.parts, state or (None, None)))
        return None if out[0] is None else out


class Predicted:
    """The Kalman filter's gains stand still after some records: from there on a chunk is one 2x2 map and a shift.

    So many records of a chunk are kept as they are; they are replayed with the gains that their place in the series has.
    """

    def __init__(self, dt: float, r: float):
        self.dt, self.r, self.head, self.m, self.shift = dt, r, [], 0, (0.0, 0.0)

    def add(self, x: np.ndarray) -> None:
        room = max(len(_gains(self.dt, self.r)) - len(self.head), 0)
        self.head += x[:room].tolist()
        if len(x) > room:
            self.shift = self._steps((*self.shift, len(_gains(self.dt, self.r)) - 1), x[room:])[:2]
            self.m += len(x) - room

    def _steps(self, state, x):
        return kalman(state, np.asarray(x, float), np.zeros(len(x), int), self.dt, self.r)[1]

    def after(self, state):
        if not self.head:
            return state
        p, v, k = self._steps(state, self.head)
        if self.m:
            g, h = _gains(self.dt, self.r)[-1]
            step = np.array([[1 - g, (1 - g) * self.dt], [-h, 1 - h * self.dt]])
            p, v = (np.linalg.matrix_power(step, self.m) @ np.array([p, v]) + np.array(self.shift)).tolist()
        return p, v, min(k + self.m, len(_gains(self.dt, self.r)) - 1)


class Unjumped:
    """The last accepted value stays until a value within bounds comes; from there on all is as if the series began there.

    Kept are the values that are the first within bounds for some state. All reach equally far, so only as many are kept
    as such reaches lie side by side between the least and the greatest value.
    """

    def __init__(self, low: float, high: float):
        self.low, self.high, self.values, self.ends, self.covered, self.seen = low, high, [], [], [], set()

    def add(self, x: np.ndarray) -> None:
        for v in x.tolist():
            self.ends = [v if self.low <= v - e <= self.high else e for e in self.ends]
            a, b = v - self.high, v - self.low
            slack = 1e-9 * max(abs(a), abs(b), 1.0)
            if v not in self.seen and not any(c <= a and b <= d for c, d in self.covered):
                self.seen.add(v)
                self.values.append(v)
                self.ends.append(v)
                inner = (a + slack, b - slack) if b - a > 2 * slack else (a, b)
                near = [c for c in self.covered if c[0] <= inner[1] + 4 * slack and inner[0] <= c[1] + 4 * slack]
                self.covered = [c for c in self.covered if c not in near] + [(min([inner[0], *(c[0] for c in near)]), max([inner[1], *(c[1] for c in near)]))]

    def after(self, state):
        if not self.values:
            return state
        if state is None:
            return self.ends[0]
        return next((e for v, e in zip(self.values, self.ends) if self.low <= v - state <= self.high), state)


class Kept:
    """The last n values."""

    def __init__(self, n: int):
        self.n, self.values = n, []

    def add(self, x: np.ndarray) -> None:
        self.values = [*self.values, *x.tolist()][-self.n :]

    def after(self, state):
        return [*(state or []), *self.values][-self.n :] or None


class Changes:
    """The last value and the n changes before it; what is needed of a chunk are its last n + 1 values."""

    def __init__(self, n: int):
        self.n, self.count, self.values = n, 0, []

    def add(self, x: np.ndarray) -> None:
        self.values = [*self.values, *x.tolist()][-self.n - 1 :]
        self.count += len(x)

    def after(self, state):
        if not self.count:
            return state
        if self.count > self.n:
            held = np.round(np.diff(self.values), 9).tolist() if self.count > self.n + 1 or state is not None else [0.0, *np.round(np.diff(self.values), 9).tolist()]
        else:
            before, held = state if state is not None else (self.values[0], [])
            held = [*held, *np.round(np.diff([before, *self.values]), 9).tolist()]
        return self.values[-1], held[-self.n :]


#: operator -> what a chunk does to its state
CHUNKS = {
    "FOF": Smoothed, "EMA": lambda n: Smoothed(2 / (n + 1)), "DIF": Difference, "KF": Predicted, "DEJUMP": Unjumped, "LAST": Kept, "VAR": Kept, "TREND": Kept, "RSI": Changes,
}
#: The numbers that an operator's state is, NaN where there is none yet; lag operators have as many as they hold.
WIDTHS = {"FOF": 1, "EMA": 1, "DIF": 2, "KF": 3, "DEJUMP": 1}


def _numbers(op: str, state) -> list[float]:
    if op in LAGS:
        return [] if state is None else [state[0], *state[1]] if op == "RSI" else list(state)
    if state is None:
        return [np.nan] * WIDTHS[op]
    return [float(v) for v in state] if WIDTHS[op] > 1 else [float(state)]


def _state(op: str, numbers):
    if numbers is None:
        return None
    if op in LAGS:
        return None if not len(numbers) else (float(numbers[0]), [float(v) for v in numbers[1:]]) if op == "RSI" else [float(v) for v in numbers]
    if np.isnan(numbers[0]):
        return None
    return float(numbers[0]) if WIDTHS[op] == 1 else (*map(float, numbers[:2]), int(numbers[2])) if op == "KF" else tuple(map(float, numbers))


def _keys_at(columns: list[np.ndarray], i: int) -> tuple:
    return tuple(None if v is None or v != v else v for v in (c[i] for c in columns))


def _typed(op: str, args) -> tuple:
    """An operator's arguments as it takes them, from numbers."""
    return tuple(float(a) if op in ("FOF", "DEJUMP", "KF") else int(a) for a in args)


def chunk_maps(chunked: DataFrame, keys: list[str], ops: dict[str, tuple] | None = None) -> DataFrame:
    """(_at, _map): what each chunk does to the states of all operators, from ``chunked`` (sorted by _at).

    Without ``ops`` each series has an operator of its own, _op with the numbers _args.
    """
    at, by = chunked.schema["_at"], [*keys, "_chunk"]

    def summed(batches):
        now, held, key, out = None, None, None, []
        for pdf in batches:
            columns = [pdf[k].to_numpy(object) for k in by]
            x = pd.to_numeric(pdf["value"], errors="coerce").to_numpy(float)
            for a, b in _parts(_pieces(pdf, by)):
                own = _keys_at(columns, a)
                if own != now:
                    if held is not None:
                        out.append((key, pickle.dumps(held)))
                    mine = ops or {"_": (op := pdf["_op"].iat[a], *_typed(op, pdf["_args"].iat[a]))}
                    now, key, held = own, dict(zip(by, own)), {k: (o[0], CHUNKS[o[0]](*o[1:])) for k, o in mine.items()}
                part = x[a:b][~np.isnan(x[a:b])]
                if len(part):
                    for _, m in held.values():
                        m.add(part)
            if out:
                yield pd.DataFrame({"_at": [k for k, _ in out], "_map": [m for _, m in out]})
            out = []
        if held is not None:
            yield pd.DataFrame({"_at": [key], "_map": [pickle.dumps(held)]})

    own = ["_op", "_args"] if ops is None else []
    return chunked.select("_at", *by, "value", *own).mapInPandas(summed, T.StructType([at, T.StructField("_map", T.BinaryType())]))


def chunk_starts(chunked: DataFrame, keys: list[str], ops: dict[str, tuple] | None = None) -> DataFrame:
    """(_at, _start): each chunk's states before its first record, operator by operator; see chunk_maps.

    Every chunk is summed up by itself; the few numbers of all chunks of a series are then put together in their order.
    """
    at = chunked.schema["_at"]

    def placed(batches):
        now, states = None, {}
        for pdf in batches:
            starts = []
            for at_, m in zip(pdf["_at"], pdf["_map"]):
                own, maps = tuple(at_[k] for k in keys), pickle.loads(m)
                if own != now:
                    now, states = own, dict.fromkeys(maps)
                starts.append([v for k, (op, _) in maps.items() for v in _numbers(op, states[k])])
                states = {k: c.after(states[k]) for k, (_, c) in maps.items()}
            yield pd.DataFrame({"_at": pdf["_at"], "_start": starts})

    series = [F.col(f"_at.{k}") for k in keys]
    return chunk_maps(chunked, keys, ops).repartition(*series).sortWithinPartitions("_at").mapInPandas(placed, T.StructType([at, T.StructField("_start", T.ArrayType(T.DoubleType()))]))


#: Records of a chunk at least, on the average of its series; a series of no more is not cut.
FEW = 10_000


def _cut(df: DataFrame, keys: list[str], chunk, few: int | None = None) -> DataFrame:
    """``df`` with _chunk: the time of the record in units of ``chunk``, or of so many of them as hold ``few`` records.

    A chunk costs some Python calls for each operator, so chunks of a few records would cost more than the records. A
    series of up to ``few`` records is one chunk, null, for which no state has to be found.
    """
    few = FEW if few is None else few
    ms = parse_duration(chunk) if isinstance(chunk, str) else int(chunk)
    unit, series = F.floor(F.col("ms") / ms), F.struct(*keys)
    d = df.withColumn("_series", series)
    long = d.select("_series", unit.alias("_unit")).groupBy("_series").agg(F.count("*").alias("_n"), (F.max("_unit") - F.min("_unit") + 1).alias("_units")).where(F.col("_n") > few)
    wide = long.select("_series", F.greatest(F.lit(1), F.ceil(F.lit(few) * F.col("_units") / F.col("_n"))).alias("_wide"))
    return d.join(wide, "_series", "left").withColumn("_chunk", F.floor(unit / F.col("_wide"))).drop("_series", "_wide")


def _with_starts(df: DataFrame, keys: list[str], chunk, ops: dict[str, tuple] | None = None) -> DataFrame:
    """``df`` dealt by chunk and sorted, with _chunk and each chunk's _start (null: there is no state before)."""
    dealt = _cut(df, keys, chunk).withColumn("_at", F.struct(*keys, "_chunk")).repartition("_at")
    starts = chunk_starts(dealt.where("_chunk is not null").sortWithinPartitions("_at", "ms", "seq"), keys, ops)
    return dealt.join(starts, "_at", "left").sortWithinPartitions("_at", "ms", "seq").select(*df.columns, "_chunk", "_start")


def _smooth_from(start: np.ndarray, x: np.ndarray, series: np.ndarray, share: float) -> np.ndarray:
    """y = share*x + (1-share)*y over several series, each from its start (NaN: it begins with its first value)."""
    first = np.flatnonzero(np.r_[True, series[1:] != series[:-1]]) if len(series) else np.zeros(0, int)
    first = first[~np.isnan(start[series[first]])]
    put = first + np.arange(len(first))
    if 0 < share <= 1:
        whole, of = np.insert(x, first, start[series[first]]), np.insert(series, first, series[first])
        y = pd.Series(whole).groupby(of).ewm(alpha=share, adjust=False).mean().to_numpy() if len(whole) else whole
        return np.delete(y, put)
    return np.concatenate([np.zeros(0), *(fof(None if np.isnan(start[series[a]]) else float(start[series[a]]), x[a:b], series[a:b], share)[0] for a, b in _parts(series))])


def _each_from(op: str, start: np.ndarray, x: np.ndarray, series: np.ndarray, args: tuple) -> tuple[np.ndarray, list[float]]:
    """An operator over several series, each from its own numbers, and the numbers behind the last one."""
    last = len(start) - 1
    goes_on = len(series) > 0 and series[-1] == last
    if op in ("FOF", "EMA", "DIF"):
        shares = [args[0]] if op == "FOF" else [2 / (n + 1) for n in args]
        y = [_smooth_from(start[:, k], x, series, a) for k, a in enumerate(shares)]
        return (y[0] - y[1] if op == "DIF" else y[0]), [float(v[-1]) for v in y] if goes_on else start[last].tolist()
    out, end = np.empty(len(x)), start[last].tolist()
    for a, b in _parts(series):
        out[a:b], state = STATEFUL[op][0](_state(op, start[series[a]]), x[a:b], series[a:b], *args)
        if series[a] == last:
            end = _numbers(op, state)
    return out, end


def filtered(df: DataFrame, ops: dict[str, tuple], keys: list[str], chunk=None) -> DataFrame:
    """``df`` with a double column per entry of ``ops`` (name -> (operator, *args)), unrounded.

    Records are dealt by key and sorted once for all operators; tasks then read batch after batch and carry each
    operator's state from one to the next, so a series of any length needs the memory of one batch. A null value gives
    null and leaves the state as it is.

    With ``chunk`` (a duration) a series is cut by time and its chunks are dealt to tasks: what a chunk does to a state
    is found without knowing that state, the states before all chunks follow from those few numbers, and each chunk is
    then read from its own. Results differ from those without ``chunk`` by the rounding of doubles only.
    """
    if chunk is not None:
        return _carried(_with_starts(df, keys, chunk, ops), ops, [*keys, "_chunk"], df.schema)
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, "ms", "seq")
    return _carried(dealt, ops, keys, df.schema)


def _carried(dealt: DataFrame, ops: dict[str, tuple], keys: list[str], given_schema: T.StructType) -> DataFrame:
    """The operators over sorted series, each from the states in its column _start if there is one."""
    names = given_schema.fieldNames()
    chunks = "_start" in dealt.columns
    schema = T.StructType([*given_schema.fields, *(T.StructField(k, T.DoubleType()) for k in ops)])
    plan = [(k, o[0] if chunks else STATEFUL[o[0]][0], o[1:]) for k, o in ops.items()]
    unknown = [np.nan] * sum(WIDTHS.get(o[0], 0) for o in ops.values())

    def alone(batches):
        """Chunks one by one, each from its own states; one that goes on in the next batch takes its states along."""
        now, last = None, []
        for pdf in batches:
            if not len(pdf):
                continue
            columns = [pdf[k].to_numpy(object) for k in keys]
            series = _pieces(pdf, keys)
            x = pd.to_numeric(pdf["value"], errors="coerce").to_numpy(float)
            begin = np.flatnonzero(np.r_[True, series[1:] != series[:-1]])
            start = np.array([unknown if v is None else v for v in pdf["_start"].iloc[begin]], float)
            if _keys_at(columns, 0) == now:
                start[0] = last
            live = np.flatnonzero(~np.isnan(x))
            at, ends, cols = 0, [], {}
            for name, op, args in plan:
                given = start[:, at : at + WIDTHS[op]]
                cols[name] = np.full(len(pdf), np.nan)
                cols[name][live], end = _each_from(op, given, x[live], series[live], args)
                ends += end
                at += WIDTHS[op]
            now, last = _keys_at(columns, len(pdf) - 1), ends
            yield pdf[names].assign(**{k: pd.Series(c).where(np.isfinite(c), None).astype(object).to_numpy() for k, c in cols.items()})

    def work(batches):
        now, states = None, {}
        for pdf in batches:
            if not len(pdf):
                yield pdf.assign(**{k: pd.Series(dtype=float) for k in ops})
                continue
            series = _pieces(pdf, keys)
            ends = [tuple(None if pd.isna(v) else v for v in pdf[keys].iloc[i]) for i in (0, -1)]
            if ends[0] != now:
                states = {}
            now = ends[1]
            x = pd.to_numeric(pdf["value"], errors="coerce").to_numpy(float)
            live = np.flatnonzero(~np.isnan(x))
            cols, part = {}, series[live]
            for name, f, args in plan:
                given = states.get(name)
                col = np.full(len(pdf), np.nan)
                out, state = f(given if len(part) and part[0] == 0 else None, x[live], part, *args)
                col[live] = out
                cols[name] = pd.Series(col).where(np.isfinite(col), None).astype(object).to_numpy()
                states[name] = state if len(part) and part[-1] == series[-1] else given if series[-1] == 0 else None
            yield pdf.assign(**cols)

    return dealt.mapInPandas(alone if chunks else work, schema)


def goes_on(df: DataFrame, held: DataFrame | None, keys: list[str], chunk, save) -> tuple[DataFrame, DataFrame]:
    """``sequenced`` for records that come after others: the result, and the states of all series behind them.

    ``held`` (_series, _n, _held) is what the records before have left: a struct of the series' keys, the n of a lag
    operator and the numbers of the state. Where _epoch changes, a series has other _args; a lag operator with another n
    starts anew, a filter goes on. ``save`` writes a DataFrame that is read more than once and reads it back.
    """
    by = [*keys, "_epoch"]
    cut = _cut(df, keys, chunk).withColumn("_chunk", F.coalesce("_chunk", F.lit(0).cast("long")))
    dealt = cut.withColumn("_at", F.struct(*by, "_chunk")).repartition("_at").sortWithinPartitions("_at", "ms", "seq")
    maps = chunk_maps(dealt, by).withColumn("_series", F.struct(*(F.col(f"_at.{k}").alias(k) for k in keys)))
    if held is None:
        met = maps.withColumn("_n", F.lit(None).cast("long")).withColumn("_held", F.lit(None).cast("array<double>"))
    else:
        met = maps.join(held, "_series", "left")
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType([met.schema["_at"], met.schema["_series"], T.StructField("_n", T.LongType()), T.StructField("_start", numbers), T.StructField("_held", numbers)])

    def placed(batches):
        now, n, state = None, None, None
        for pdf in batches:
            starts, ends, ns = [], [], []
            for at, m, old, kept in zip(pdf["_at"], pdf["_map"], pdf["_n"], pdf["_held"]):
                own, (op, change) = tuple(at[k] for k in keys), pickle.loads(m)["_"]
                if own != now:
                    now, n, state = own, None if pd.isna(old) else int(old), _state(op, kept)
                if op in LAGS and n != change.n:
                    n, state = change.n, None
                starts.append(_numbers(op, state))
                state = change.after(state)
                ends.append(_numbers(op, state))
                ns.append(n)
            yield pd.DataFrame({"_at": pdf["_at"], "_series": pdf["_series"], "_n": pd.array(ns, "Int64"), "_start": starts, "_held": ends})

    starts = save(met.repartition("_series").sortWithinPartitions("_series", "_at").mapInPandas(placed, schema), "starts")
    last = F.max_by(F.struct("_n", "_held"), F.struct("_at._epoch", "_at._chunk"))
    states = starts.groupBy("_series").agg(last.alias("_s")).select("_series", "_s._n", "_s._held")
    if held is not None:
        states = held.join(states, "_series", "left_anti").unionByName(states)
    out = dealt.join(starts.select("_at", "_start"), "_at").sortWithinPartitions("_at", "ms", "seq")
    return _each_sequenced(out.select(*df.columns, "_chunk", "_start"), df, by), states


def _told(pdf: pd.DataFrame, result: np.ndarray) -> pd.DataFrame:
    return pdf.assign(value=pd.Series(result, pdf.index).where(np.isfinite(result), None).astype(object), _there=~np.isnan(result))


def _each_sequenced(started: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """The results of sorted chunks, each by its own _op and _args from its _start; see sequenced."""
    cols = df.columns

    def alone(batches):
        now, state = None, None
        for pdf in batches:
            columns = [pdf[k].to_numpy(object) for k in (*keys, "_chunk")]
            x = pd.to_numeric(pdf["value"], errors="coerce").to_numpy(float)
            result = np.where(np.isnan(x), np.inf, np.nan)
            for a, b in _parts(_pieces(pdf, [*keys, "_chunk"])):
                op = pdf["_op"].iat[a]
                own = _keys_at(columns, a)
                if own != now:
                    now, state = own, _state(op, pdf["_start"].iat[a])
                live = a + np.flatnonzero(~np.isnan(x[a:b]))
                if len(live):
                    result[live], state = STATEFUL[op][0](state, x[live], np.zeros(len(live), int), *_typed(op, pdf["_args"].iat[a]))
            yield _told(pdf[cols], result)

    return _rounded(started.mapInPandas(alone, _sequence_schema(df)), cols)


def _sequence_schema(df: DataFrame) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, T.DoubleType()) if f.name == "value" else f for f in df.schema.fields), T.StructField("_there", T.BooleanType())])


def _rounded(out: DataFrame, cols: list[str]) -> DataFrame:
    places = F.expr("case _op " + " ".join(f"when '{o}' then cast(round(cast(value as decimal(28,10)), {p}) as double)" for o, (_, p) in STATEFUL.items() if p is not None) + " else value end")
    return out.where("_there").withColumn("value", places).select(*cols)


def sequenced(df: DataFrame, keys: list[str], chunk=None) -> DataFrame:
    """``df`` with value replaced by the result of each series' own operator _op with the numbers _args.

    As ``filtered``: one sort, and in each batch one pass per operator and arguments over all their series. Records that
    have no result yet go; a null value gives a null and leaves the state as it is. ``chunk``: see ``filtered``; lag
    operators are cut too.
    """
    cols = df.columns
    def work(batches):
        now, state = None, None
        for pdf in batches:
            if not len(pdf):
                yield pdf.assign(_there=pd.Series(dtype=bool))
                continue
            series = _pieces(pdf, keys)
            ends = [tuple(None if pd.isna(v) else v for v in pdf[keys].iloc[i]) for i in (0, -1)]
            state = state if ends[0] == now else None
            now = ends[1]
            x = pd.to_numeric(pdf["value"], errors="coerce").to_numpy(float)
            spec = pd.factorize(pd.Series([(o, *a) for o, a in zip(pdf["_op"], pdf["_args"])]))
            result, after = np.where(np.isnan(x), np.inf, np.nan), None
            for k, (op, *args) in enumerate(spec[1]):
                live = np.flatnonzero(~np.isnan(x) & (spec[0] == k))
                part = series[live]
                given = state if spec[0][0] == k else None
                out, end = STATEFUL[op][0](given if len(part) and part[0] == 0 else None, x[live], part, *_typed(op, args))
                result[live] = out
                if spec[0][-1] == k:
                    after = end if len(part) and part[-1] == series[-1] else given if series[-1] == 0 else None
            state = after
            yield _told(pdf, result)

    if chunk is not None:
        return _each_sequenced(_with_starts(df, keys, chunk), df, keys)
    return _rounded(df.repartition(*keys).sortWithinPartitions(*keys, "ms", "seq").mapInPandas(work, _sequence_schema(df)), cols)


def filter_stage(df: DataFrame, op: str, args: tuple, keys: list[str], chunk=None) -> DataFrame:
    """``df`` with value replaced by the filter's, rounded as the operator is. ``chunk``: see filtered."""
    places = FILTERS[op][1]
    out = F.col("_out") if places is None else round_half_up(F.col("_out"), places)
    return filtered(df, {"_out": (op, *args)}, keys, chunk).withColumn("value", out).drop("_out")
