"""Windows, sequences and chains against vectors worked out by hand, and against plain loops."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sensorloom.operators import pattern, sequences, windows
from sensorloom.plans.compiler import check_cycles, operator, run_chain
from sensorloom.plans.spec import WINDOW_OPS, Stage, parse_spec, validate_specs

READINGS = [20.5, 21.25, 19.9, 20.75, 22.4, 23.1, 22.85, 21.6, 20.95, 21.3, 24.05, 23.55, 22.7, 25.2, 24.9, 23.8]
SERIES = "k string, ms long, seq long, value double"


def series(spark, values, step=1000, key="a"):
    return spark.createDataFrame([(key, i * step, i, v) for i, v in enumerate(values)], SERIES)


def values(df):
    return [r["value"] for r in df.orderBy("ms", "seq").collect()]


def places(x, n=4):
    """Half up, on exact numbers."""
    return float(Decimal(x).quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))


def by_hand(xs):
    """The window operators over one window, in decimals."""
    d = [Decimal(repr(x)) for x in xs]
    n, mean = len(d), Decimal(repr(places(sum(d) / len(d))))
    variance = Decimal(repr(places(sum((x - mean) ** 2 for x in d) / n)))
    ranks, order = range(1, n + 1), sorted(d)
    middle = Decimal(n + 1) / 2
    slope = sum((i - middle) * x for i, x in zip(ranks, d)) / sum((i - middle) ** 2 for i in ranks)
    return {
        "sum": float(sum(d)), "avg": float(mean), "max": float(order[-1]), "min": float(order[0]), "range": float(order[-1] - order[0]), "median": places((order[(n - 1) // 2] + order[n // 2]) / 2),
        "variance": float(variance), "std": places(variance.sqrt()), "cv": places(variance.sqrt() / mean), "slope": places(slope), "interp": xs[-1], "pseq": float(order[0] >= 0),
    }


def test_windows(spark):
    for xs in (READINGS, [-x for x in READINGS[:7]], [3.0, 3.0]):
        r = windows.window_aggregate(series(spark, xs), {o.lower(): o for o in WINDOW_OPS}, ["k"], "1m", "1m").first().asDict()
        assert {k: v for k, v in r.items() if k not in ("k", "win_start", "win_end")} == by_hand(xs)
        assert (r["win_start"], r["win_end"]) == (0, 60000)
    i = windows.integer_order(series(spark, READINGS), ["k"], "1m", "1m").first()
    assert (i["max_int"], i["min_int"], i["range_int"]) == (25.2, 19.9, 5.3)
    i = windows.integer_order(series(spark, [7.9, 7.1, 6.5, 6.2]), ["k"], "1m", "1m").first()
    assert (i["max_int"], i["min_int"], i["range_int"]) == (7.1, 6.2, 0.6)  # of equal whole parts the later; the range from the first of the least


def test_window_edges(spark):
    one = windows.window_aggregate(series(spark, [5.0]), {"s": "SLOPE", "v": "VARIANCE"}, ["k"], "5s", "5s").first()
    assert one["s"] is None and one["v"] == 0
    zero = windows.window_aggregate(series(spark, [-1.0, 1.0]), {"c": "CV", "p": "PSEQ"}, ["k"], "5s", "5s").first()
    assert zero["c"] is None and zero["p"] == 0
    gap = windows.window_aggregate(series(spark, [1.0, None, 3.0]), {"s": "SLOPE", "a": "AVG"}, ["k"], "5s", "5s").first()
    assert gap["s"] is None and gap["a"] == 2
    with pytest.raises(ValueError):
        windows.assign_windows(series(spark, [1.0]), "5s", "5s", offset="5s")


def loop(ms, size, slide, offset=0):
    start, out = ms - (ms - offset) % slide, []
    while start > ms - size:
        out.append(start)
        start -= slide
    return out


CASES = [(5000, 5000, 0), (7000, 2000, 0), (3000, 5000, 0), (10000, 2500, 500), (1, 1, 0)]


@pytest.mark.parametrize("size,slide,offset", CASES)
def test_assigner(spark, size, slide, offset):
    from pyspark.sql import functions as F

    times = [0, 1, 499, 500, 2499, 2500, 4999, 5000, 12345, 99999]
    df = spark.createDataFrame([("a", t, i, 1.0) for i, t in enumerate(times)], SERIES)
    for n, s in ((size, slide), (F.lit(size).cast("long"), F.lit(slide).cast("long"))):
        got = windows.assign_windows(df, n, s, offset).select("ms", "win_start", "win_end").collect()
        assert sorted((r[0], r[1]) for r in got) == sorted((t, w) for t in times for w in loop(t, size, slide, offset))
        assert all(r[2] - r[1] == size for r in got)


def strengths(xs, n):
    d = [Decimal(repr(x)) for x in xs]
    change = [Decimal(0), *(b - a for a, b in zip(d, d[1:]))]
    out = []
    for i in range(n - 1, len(d)):
        up, down = (sum(max(s * c, Decimal(0)) for c in change[i - n + 1 : i + 1]) for s in (1, -1))
        out.append(places(100 - 100 / (1 + up / down)) if down else 100.0 if up else None)
    return out


def test_lags(spark):
    s = series(spark, READINGS)
    d = [Decimal(repr(x)) for x in READINGS]
    assert values(sequences.lag_stage(s, "LAST", 2, ["k"])) == READINGS[:-2]
    assert values(sequences.lag_stage(s, "VAR", 2, ["k"])) == [places(b - a) for a, b in zip(d, d[2:])]
    assert values(sequences.lag_stage(s, "TREND", 2, ["k"])) == [places(b / a) for a, b in zip(d, d[2:])]
    assert values(sequences.lag_stage(series(spark, [0.0, 1.0]), "TREND", 1, ["k"])) == [None]
    for n in (14, 5, 1):
        assert values(sequences.rsi(s, n, ["k"])) == strengths(READINGS, n)
    assert values(sequences.rsi(series(spark, [1.0, 1.0]), 2, ["k"])) == [None]
    assert values(sequences.rsi(series(spark, [1.0, 2.0]), 2, ["k"])) == [100.0]


def test_filters(spark):
    s = series(spark, READINGS)
    for op, args, n in (("EMA", (5,), 8), ("DIF", (3, 6), 9), ("FOF", (0.3,), 4), ("KF", (1.0, 1.0), 4)):
        assert values(sequences.filter_stage(s, op, args, ["k"])) == pytest.approx(plain(op, READINGS, *args), abs=0.6 * 10**-n)
    assert values(sequences.filter_stage(s, "DEJUMP", (-0.8, 0.8), ["k"])) == [20.5, 21.25, 21.25, 20.75, 20.75, 20.75, 20.75, 20.75, 20.95, 21.3, *[21.3] * 6]
    assert values(sequences.filter_stage(series(spark, [1.0, None, 2.0]), "FOF", (0.5,), ["k"])) == [1.0, None, 1.5]
    assert values(sequences.filter_stage(series(spark, [1.0, 1.5, 2.5]), "DEJUMP", (0.0, 0.5), ["k"])) == [1.0, 1.5, 1.5]


def one(f, state, xs, *args):
    import numpy as np

    out, state = f(state, np.array(xs, float), np.zeros(len(xs), int), *args)
    return np.asarray(out, float).tolist(), state


def plain(op, xs, *args):
    """Each recursive operator as a loop over one series."""
    out, y, z = [], None, None
    p = v = a = b = c = 0.0
    for i, x in enumerate(xs):
        if op == "FOF":
            y = x if i == 0 else args[0] * x + (1 - args[0]) * y
        elif op == "EMA":
            y = x if i == 0 else (2 * x + (args[0] - 1) * y) / (args[0] + 1)
        elif op == "DEJUMP":
            y = x if i == 0 or args[0] <= x - y <= args[1] else y
        elif op == "KF":
            dt, r = args
            p, v, a, b, c = (x, 0.0, 1.0, 0.0, 1.0) if i == 0 else (p, v, a, b, c)
            p, a, b, c = p + dt * v, a + 2 * dt * b + dt * dt * c + 0.05, b + dt * c + 0.05, c + 0.05
            y, g, h, e = p, a / (a + r), b / (a + r), x - p
            p, v, a, b, c = p + g * e, v + h * e, a - g * a, b - g * b, c - h * b
        out.append(y)
    if op == "DIF":
        return [m - n for m, n in zip(plain("EMA", xs, args[0]), plain("EMA", xs, args[1]))]
    return out


SOME = [("FOF", (0.3,)), ("EMA", (5,)), ("DIF", (3, 6)), ("DEJUMP", (-1.0, 2.0)), ("KF", (1.0, 0.5))]


def test_filter_state_crosses_batches(spark):
    """Several series with nulls, in batches of 7 rows, against loops."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        data = {"a": [float(i * i % 17) for i in range(100)], "b": [5.0, None, None, 1.0], "c": [None], "d": [float(i % 5) for i in range(30)], "e": [None] * 9 + [2.0, 3.0], None: [1.0, 4.0, 9.0]}
        df = series(spark, [], key="a")
        for key, xs in data.items():
            df = df.union(spark.createDataFrame([(key, i * 1000, i, v) for i, v in enumerate(xs)], SERIES))
        got = sequences.filtered(df, {op: (op, *args) for op, args in SOME}, ["k"]).collect()
        for key, xs in data.items():
            mine = sorted((r for r in got if r["k"] == key), key=lambda r: r["ms"])
            assert len(mine) == len(xs)
            for op, args in SOME:
                want = iter(plain(op, [x for x in xs if x is not None], *args))
                assert [r[op] for r in mine] == pytest.approx([None if x is None else next(want) for x in xs], abs=1e-9), (key, op)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.integers(0, 39))
def test_states_compose(xs, cut):
    """A series in two pieces gives what it gives in one, and for the filters what a loop gives."""
    for op, args in [*SOME, ("LAST", (3,)), ("VAR", (2,)), ("TREND", (1,)), ("RSI", (4,))]:
        f = sequences.STATEFUL[op][0]
        whole, _ = one(f, None, xs, *args)
        a, state = one(f, None, xs[:cut], *args)
        b, _ = one(f, state, xs[cut:], *args)
        assert a + b == pytest.approx(whole, rel=1e-9, abs=1e-6, nan_ok=True), op
        if op in sequences.FILTERS:
            assert whole == pytest.approx(plain(op, xs, *args), rel=1e-9, abs=1e-6)


def test_chunks_change_nothing(spark):
    """Sparse and dense series cut by time, with chunks that hold fewer records than the lag."""
    import random

    rng = random.Random(6)
    rows = [(k, rng.choice([0, 1, 2, 50]) * 1000 + rng.randint(0, 900), i, float(rng.randint(0, 9))) for k in ("a", "b", None) for i in range(60)]
    df = spark.createDataFrame(rows, SERIES)
    for run in (lambda c: sequences.lag_stage(df, "LAST", 4, ["k"], chunk=c), lambda c: sequences.rsi(df, 5, ["k"], c), lambda c: sequences.rsi(df, 1, ["k"], c), lambda c: sequences.lagged(df, {"value2": ("VAR", 1), "t": ("TREND", 6)}, ["k"], c)):
        whole = sorted(map(str, run(None).collect()))
        for chunk in ("250ms", "1s", "3s"):
            assert sorted(map(str, run(chunk).collect())) == whole


def test_null_keys_and_places(spark):
    """A series whose key is null keeps its windows; a filter's places reach the windows behind it."""
    null = spark.createDataFrame([(None, i * 1000, i, float(i)) for i in range(10)], SERIES)
    got = windows.window_aggregate(null, {"s": "SUM", "m": "MEDIAN", "t": "SLOPE"}, ["k"], "4s", "2s")
    want = {0: (6.0, 1.5, 1.0), 2000: (14.0, 3.5, 1.0), 4000: (22.0, 5.5, 1.0), 6000: (30.0, 7.5, 1.0), 8000: (17.0, 8.5, 1.0), -2000: (1.0, 0.5, 1.0)}
    assert {r["win_start"]: (r["s"], r["m"], r["t"]) for r in got.collect()} == want
    tiny = run_chain(series(spark, [0.00004] * 5), parse_spec("EMA_SUM", "5|5s,5s"), ["k"])
    assert values(tiny) == [0.0002]
    big = windows.window_aggregate(series(spark, [4e15, 2e15]), {"s": "SUM", "a": "AVG"}, ["k"], "5s", "5s").first()
    assert (big["s"], big["a"]) == (6e15, 3e15)


def test_processing_time_windows(spark):
    import time

    now = time.time() * 1000
    r = windows.window_aggregate(series(spark, [1.0, 2.0]), {"s": "SUM"}, ["k"], "1h", "1h", time="processing").first()
    assert r["s"] == 3 and r["win_start"] <= now < r["win_end"] + 60_000


def test_carried_columns_and_panes(spark):
    """Sliding windows by panes equal those by records, SLOPE and the earliest record's columns included."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = [("ab"[i % 2], rng.randint(0, 40_000), i, None if i % 11 == 0 else round(rng.uniform(-50, 50), 3)) for i in range(300)]
    df = spark.createDataFrame(rows, SERIES).withColumn("tag", F.col("seq") * 2)
    ops = {o.lower(): o for o in WINDOW_OPS if o != "MEDIAN"}
    for size, slide in ((7000, 3000), (6000, 2000), (9000, 6000)):
        paned = windows.window_aggregate(df, ops, ["k"], size, slide, offset=500, carry=["tag"])
        dealt = windows.window_aggregate(df, ops, ["k"], F.lit(size).cast("long"), F.lit(slide).cast("long"), offset=500, carry=["tag"])
        assert sorted(map(str, paned.collect())) == sorted(map(str, dealt.collect()))


def test_specs():
    assert parse_spec("AVG_KF_MAX", "5s,5s|1,0.5|1m,1m") == (Stage("AVG", (5000, 5000)), Stage("KF", (1.0, 0.5)), Stage("MAX", (60000, 60000)))
    good = ["PSEQ#100s,50s", "KF#0.001,10000", "AVG#1m,7s", "AVG_KF_MAX#5s,5s|0.001,10000|3s,2s", "LAST#2", "MAX#2h,1d"]
    bad = ["MAX#5s,", "KF#5s,5s", "MIN#", "AVG_KF_MAX#5s,5s|1m,1m|3s,2s", "AVG", "AVG#5s,6s", "FOO#1", "LAST#0", "AVG_MAX#5s,5s", "MAX#2h,0s"]
    ok, wrong = validate_specs(good[:-1] + bad)
    assert ok == good[:-1] and list(wrong) == bad
    assert validate_specs(good[-1:])[0] == []


def test_last_arguments_win():
    got = parse_spec("AVG_LAST_MAX_KF_FOF_VAR", "5s,5s|2|1m,1m|1,0.5|0.3|7", last_wins=True)
    assert [s.args for s in got] == [(60000, 60000), (7,), (60000, 60000), (1.0, 0.5), (0.3,), (7,)]


def test_chain_plugin_and_cycles(spark):
    @operator("TWICE")
    def twice(df, args, keys):
        return df.withColumn("value", df["value"] * 2)

    got = run_chain(series(spark, READINGS), (Stage("AVG", (4000, 4000)), Stage("VAR", (1,)), Stage("TWICE")), ["k"])
    assert len(values(got)) == 3
    order = check_cycles([{"out_name": "c", "tag_name": "[b] + [a]"}, {"out_name": "b", "tag_name": "a"}])
    assert order.index("b") < order.index("c")
    with pytest.raises(ValueError):
        check_cycles([{"out_name": "b", "tag_name": "c"}, {"out_name": "c", "tag_name": "[b] + 1"}])


def test_pattern_swap(spark):
    from pyspark.sql import functions as F

    times = [1000, 2000, 3000, 3000, 3001, 4000, 5000, 6000]
    rows = [("k", t, i, n) for i, (t, n) in enumerate(zip(times, ["a", "b", "c", "d", "change", "e", "f", "g"]))]
    df = spark.createDataFrame(rows, "k string, ms long, seq long, name string")
    is_ = lambda x: F.col("name") == x
    got = pattern.match_switching(df, [is_("a"), is_("b")], [is_("e"), is_("f"), is_("g")], is_("change"), ["k"], within=300_000)
    assert sorted((r["first_seq"], r["last_seq"]) for r in got.collect()) == [(0, 1), (5, 7)]
