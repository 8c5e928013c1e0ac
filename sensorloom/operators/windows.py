"""Event-time windows: sliding, tumbling, and with a size and slide of each record's own.

Windows are aligned to the epoch (plus an offset): they start at multiples of the slide, and a record belongs to every
window whose start is at most its time and whose end lies after it. A slide above the size leaves gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import parse_duration, round_half_up

#: Sums are exact: in any order of the records they are the same. Values keep nine places, as filters give them.
EXACT, SQUARE = "decimal(38,9)", "decimal(38,8)"


def _ms(x) -> Column:
    return x if isinstance(x, Column) else F.lit(parse_duration(x) if isinstance(x, str) else int(x)).cast("long")


def _check(size: int, slide: int, offset: int) -> None:
    if size <= 0 or slide <= 0 or abs(offset) >= slide:
        raise ValueError("size and slide must be above 0, the offset less than the slide")


def assign_windows(df: DataFrame, size, slide, offset=0, default=("5s", "5s"), time: str = "event") -> DataFrame:
    """``df`` with win_start and win_end (ms), a row for each window that a record belongs to.

    ``size`` and ``slide`` are durations, milliseconds or columns; a null or 0 of a record means the default. Time is
    the event time ``ms``, or the clock of the run for 'processing'.
    """
    if not isinstance(size, Column) and not isinstance(slide, Column):
        _check(*(parse_duration(x) if isinstance(x, str) else int(x) for x in (size, slide, offset)))
    zero = lambda x, d: F.when(F.coalesce(x, F.lit(0)) > 0, x).otherwise(F.lit(parse_duration(d))).cast("long")
    n, s, o = zero(_ms(size), default[0]), zero(_ms(slide), default[1]), _ms(offset)
    at = F.col("ms") if time == "event" else F.unix_millis(F.current_timestamp()).cast("long")
    last = at - F.pmod(at - o, s)
    more = F.floor((n - 1 - (at - last)) / s)
    if not isinstance(size, Column) and not isinstance(slide, Column) and str(size) == str(slide):
        return df.withColumn("win_start", last).withColumn("win_end", F.col("win_start") + n)
    starts = F.when(more >= 0, F.sequence(last, last - s * more, -s))
    return df.withColumn("win_start", F.explode(starts)).withColumn("win_end", F.col("win_start") + n)


#: Operator -> the moments it is made of; those that are structs would turn a hash aggregation into a sorted one.
NEEDS = {"SUM": "s", "AVG": "s", "VARIANCE": "sq", "STD": "sq", "CV": "sq", "MAX": "x", "MIN": "x", "RANGE": "x", "PSEQ": "x", "INTERP": "l", "SLOPE": "s", "MEDIAN": "m"}
#: Operator -> the record whose columns its result carries; all others carry the earliest.
CARRIERS = {"MAX": "top", "MEDIAN": "top", "MIN": "low", "INTERP": "last"}
#: Which of two records is carried on, by value and time; of equal values the later.
_PREFERRED = {"top": lambda v, ms, seq: F.struct(v, ms, seq), "low": lambda v, ms, seq: F.struct(-v, ms, seq), "last": lambda v, ms, seq: F.struct(ms, seq), "earliest": lambda v, ms, seq: F.struct(-ms, -seq)}


def _carriers(ops) -> list[str]:
    return sorted({CARRIERS.get(o, "earliest") for o in ops})


def moments(v: Column, ops, carry: list[str], each: list[str] = ()) -> list[Column]:
    """Partial results that combine: counts, exact sum and sum of squares, extremes, latest and first record, sorted values.

    ``each``: columns that every operator's result carries from the record of its own (CARRIERS).
    """
    need = {c for o in ops for c in NEEDS[o]}
    d, x, at = v.cast(EXACT), v.cast("double"), F.struct("ms", "seq")
    out = [F.count(F.lit(1)).alias("rows"), F.count(v).alias("n")]
    out += [F.sum(d).alias("s")] if "s" in need else []
    out += [F.sum((x * x).cast(SQUARE)).alias("q")] if "q" in need else []
    out += [F.min(v).alias("lo"), F.max(v).alias("hi")] if "x" in need else []
    out += [F.max_by(F.struct("ms", "seq", v.alias("v")), F.when(v.isNotNull(), at)).alias("late")] if "l" in need else []
    out += [F.sort_array(F.collect_list(x)).alias("every")] if "m" in need else []
    if each:
        record = F.struct("ms", "seq", v.alias("_v"), F.struct(*each).alias("c"))
        out += [F.max_by(record, F.when(v.isNotNull() | F.lit(c == "earliest"), _PREFERRED[c](x, F.col("ms"), F.col("seq")))).alias(c) for c in _carriers(ops)]
    return out + ([F.min_by(F.struct("ms", "seq", F.struct(*carry).alias("c")), at).alias("first")] if carry else [])


def _combined(ops, carry: list[str], each: list[str] = ()) -> list[Column]:
    need = {c for o in ops for c in NEEDS[o]}
    at = lambda c: F.struct(f"{c}.ms", f"{c}.seq")
    out = [F.sum(c).alias(c) for c in ("rows", "n", *("sq" if "q" in need else "s" if "s" in need else ""))]
    out += [F.min("lo").alias("lo"), F.max("hi").alias("hi")] if "x" in need else []
    out += [F.max_by("late", F.when(F.col("late.v").isNotNull(), at("late"))).alias("late")] if "l" in need else []
    out += [_middle(F.sort_array(F.flatten(F.collect_list("every")))).alias("mid")] if "m" in need else []
    if each:
        key = lambda c: _PREFERRED[c](F.col(f"{c}._v").cast("double"), F.col(f"{c}.ms"), F.col(f"{c}.seq"))
        out += [F.max_by(c, F.when(F.col(f"{c}.ms").isNotNull(), key(c))).alias(c) for c in _carriers(ops)]
    return out + ([F.min_by("first", at("first")).alias("first")] if carry else [])


def _middle(values: Column) -> Column:
    """The median of a sorted array."""
    n = F.size(values)
    at = lambda k: F.get(values, F.floor(k / 2).cast("int"))
    return (at(n - 1) + at(n)) / 2


def _rounded(x: str) -> str:
    return f"cast(round(cast(cast({x} as double) as decimal(28,10)), 4) as double)"


_N, _S, _Q, _R = (f"cast({c} as double)" for c in ("n", "s", "q", "rows"))
_MEAN = _rounded(f"try_divide({_S}, {_N})")
_VARIANCE = _rounded(f"case when n > 0 then greatest(try_divide({_Q} - 2 * {_MEAN} * {_S} + {_N} * {_MEAN} * {_MEAN}, {_N}), 0d) end")
_RANKS = f"({_R} * ({_R} + 1) / 2)"
#: A window's result from its moments, rounded as the operator is; as SQL, since a plan may hold many of them.
FINISH = {
    "SUM": _S, "AVG": _MEAN, "MAX": "cast(hi as double)", "MIN": "cast(lo as double)", "RANGE": _rounded("hi - lo"),
    "VARIANCE": _VARIANCE, "STD": _rounded(f"sqrt({_VARIANCE})"), "CV": _rounded(f"try_divide(sqrt({_VARIANCE}), {_MEAN})"),
    "PSEQ": "case when lo >= 0 then 1d when lo < 0 then 0d end", "INTERP": "cast(late.v as double)", "MEDIAN": _rounded("mid"),
    "SLOPE": "case when n = rows then " + _rounded(f"try_divide({_R} * cast(xy as double) - {_RANKS} * {_S}, {_R} * ({_R} * ({_R} + 1) * (2 * {_R} + 1) / 6) - {_RANKS} * {_RANKS})") + " end",
}


def finish(op: str) -> Column:
    return F.expr(FINISH[op])


def _rank(by: list[str]) -> Column:
    return F.row_number().over(W.partitionBy(*by).orderBy("ms", "seq"))


def _summed(dealt: DataFrame, by: list[str], ops, carry: list[str] = (), each: list[str] = ()) -> DataFrame:
    """One aggregation of dealt records: their moments, with ``xy`` for SLOPE."""
    more = []
    if "SLOPE" in ops:
        dealt = dealt.withColumn("rn", _rank(by))
        more.append(F.sum(F.col("rn") * F.col("value").cast(EXACT)).alias("xy"))
    return dealt.groupBy(*by).agg(*moments(F.col("value"), ops, list(carry), list(each)), *more)


def gathered(dealt: DataFrame, by: list[str], ops, carry: list[str] = (), each: list[str] = ()) -> DataFrame:
    """The windows of dealt records, with ``mid`` for MEDIAN and ``xy`` for SLOPE."""
    out = _summed(dealt, by, ops, carry, each)
    return out.withColumn("mid", _middle(F.col("every"))) if "MEDIAN" in ops else out


def _from_panes(panes: DataFrame, by: list[str], size, slide, offset, ops, carry: list[str] = (), each: list[str] = ()) -> DataFrame:
    """Windows from panes, which stand at ms: panes, not records, are dealt to the overlapping windows.

    A pane holds the sum of rank times value for SLOPE, the rank counted inside it: in a window the ranks of a pane go on
    from the records of the panes before it. For MEDIAN it holds its values in order, which are merged.
    """
    dealt, more = assign_windows(panes, size, slide, offset), []
    if "SLOPE" in ops:
        before = F.coalesce(F.sum("rows").over(W.partitionBy(*by).orderBy("ms").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        dealt = dealt.withColumn("xy", F.col("xy") + before * F.col("s"))
        more = [F.sum("xy").alias("xy")]
    return dealt.groupBy(*by).agg(*_combined(ops, carry, each), *more)


def _paned(df: DataFrame, keys: list[str], size: int, slide: int, offset: int, ops, carry: list[str], each: list[str]) -> DataFrame:
    """Sliding windows by way of panes as long as the common divisor of size and slide."""
    pane = math.gcd(size, slide)
    cut = df.withColumn("pane", F.col("ms") - F.pmod(F.col("ms") - offset, F.lit(pane)))
    panes = _summed(cut, [*keys, "pane"], ops, carry, each).withColumnRenamed("pane", "ms")
    return _from_panes(panes, [*keys, "win_start", "win_end"], size, slide, offset, ops, carry, each)


def window_each(df: DataFrame, keys: list[str], ops) -> DataFrame:
    """keys, win_start, win_end, value, where each record brings its operator _op, size _size and slide _slide.

    Operator and window sizes are among the keys' properties, so one plan serves any number of rules. Records are summed
    into panes of one slide first where the size is a multiple of it; else each time is a pane of its own.
    """
    by = [*keys, "_op", "_size", "_slide"]
    even = F.col("_size") % F.col("_slide") == 0
    panes = _summed(df.withColumn("_pane", F.when(even, F.col("ms") - F.pmod("ms", F.col("_slide"))).otherwise(F.col("ms"))), [*by, "_pane"], ops)
    found = _from_panes(panes.withColumnRenamed("_pane", "ms"), [*by, "win_start", "win_end"], F.col("_size"), F.col("_slide"), 0, ops)
    value = "case _op " + " ".join(f"when '{o}' then {FINISH[o]}" for o in ops) + " end"
    return found.select(*keys, "win_start", "win_end", F.expr(value).alias("value"))


def window_aggregate(df: DataFrame, ops: dict[str, str], keys: list[str], size, slide, offset=0, default=("5s", "5s"), time: str = "event", carry: list[str] = (), carry_each: list[str] = ()) -> DataFrame:
    """keys, win_start, win_end, one column per entry of ``ops`` (name -> operator), and the columns ``carry``.

    All operators of one window share one aggregation, whose keys may be null. Overlapping windows of constant size and
    slide are made of panes, unless time is 'processing' (see assign_windows). Null values are skipped, but make a SLOPE
    null. ``carry`` is taken from a window's earliest record. ``carry_each`` gives every operator the columns
    name_column of the record that it is about: MAX and MIN of the extreme one (of equal ones the last), MEDIAN of the
    last in order of value, INTERP of the latest, all others of the earliest.
    """
    by, whole, carry, each = [*keys, "win_start", "win_end"], set(ops.values()), list(carry), list(carry_each)
    fixed = not isinstance(size, Column) and not isinstance(slide, Column)
    n, s, o = (x if isinstance(x, Column) else parse_duration(x) if isinstance(x, str) else int(x) for x in (size, slide, offset))
    if fixed and n != s and time == "event":
        _check(n, s, o)
        found = _paned(df, keys, n, s, o, whole, carry, each)
    else:
        found = gathered(assign_windows(df, n, s, o, default, time), by, whole, carry, each)
    of = [F.col(f"{CARRIERS.get(o, 'earliest')}.c.{c}").alias(f"{k}_{c}") for k, o in ops.items() for c in each]
    return found.select(*by, *(finish(o).alias(k) for k, o in ops.items()), *(F.col(f"first.c.{c}").alias(c) for c in carry), *of)


def integer_order(df: DataFrame, keys: list[str], size, slide) -> DataFrame:
    """MAX, MIN and RANGE as an order by integer part gives them, later records winning ties (compatible results)."""
    by = [*keys, "win_start", "win_end"]
    whole = F.col("value").cast("double").cast("long")
    dealt = assign_windows(df, size, slide)
    top, low = F.struct(whole, F.col("seq")), F.struct(-whole, F.col("seq"))
    first = F.struct(whole, F.col("seq"))
    found = dealt.groupBy(*by).agg(F.max_by("value", top).alias("max_int"), F.max_by("value", low).alias("min_int"), F.min_by("value", first).alias("_first"))
    return found.select(*by, "max_int", "min_int", round_half_up(F.col("max_int") - F.col("_first")).alias("range_int"))
