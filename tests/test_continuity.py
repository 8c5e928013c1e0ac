"""What must hold across micro-batches, chunks, restarts and failures: chains, change logs, sinks and sources."""

import datetime as dt
import json
import random
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.functions.times import round_half_up
from sensorloom.operators import changes, enrich, sequences, windows
from sensorloom.plans.compiler import calculate, run_chain
from sensorloom.plans.spec import WINDOW_OPS, parse_spec
from sensorloom.sources import connectors
from sensorloom.streaming import chains
from sensorloom.streaming import operators as streams

SERIES = "k string, ms long, seq long, value double"
CONF = "tag_name string, tag_topic string, out_name string, calculate_type string, param string, task_name string, line_id int, status int"
RAW = "name string, topic string, message long, ms long, seq long, value double"


def series(n=400, keys=3, seed=1, nulls=True):
    rng = random.Random(seed)
    out, now = [], 1_704_067_200_000
    for i in range(n):
        now += rng.choice([1, 700, 1000, 5000, 20_000])
        value = round(rng.gauss(20, 15), rng.choice([0, 2, 4]))
        out.append((rng.choice([*"abc"[:keys], None]) if nulls else rng.choice("abc"[:keys]), now, i, None if nulls and rng.random() < 0.05 else value))
    return out


# ---- chunks of a series ---------------------------------------------------------------------------------------------

FILTERS = {"fof": ("FOF", 0.3), "fof1": ("FOF", 1.4), "ema": ("EMA", 5), "dif": ("DIF", 3, 6), "dejump": ("DEJUMP", -8.0, 8.0), "kf": ("KF", 1.0, 0.5), "kf2": ("KF", 0.1, 40.0)}


def test_filters_in_chunks_are_those_of_the_whole_series(spark):
    """Null keys and values, chunks without values, several chunks a series, small Arrow batches."""
    df = spark.createDataFrame(series(1500), SERIES)
    whole = {r["seq"]: r for r in sequences.filtered(df, FILTERS, ["k"]).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for chunk in ("40s", "10m", "1d"):
            got = sequences.filtered(df, FILTERS, ["k"], chunk)
            rows = got.collect()
            assert got.columns == [*df.columns, *FILTERS] and len(rows) == 1500
            for r in rows:
                for name in FILTERS:
                    want = whole[r["seq"]][name]
                    assert (r[name] is None) == (want is None) and (want is None or r[name] == pytest.approx(want, rel=1e-9, abs=1e-9)), (name, chunk, r)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sequences.filtered(df.limit(0), FILTERS, ["k"], "1h").count() == 0


@pytest.mark.parametrize("few", [0, 20, 250])
def test_chunks_hold_more_than_a_few_records(spark, monkeypatch, few):
    """Short series stay whole, sparse ones are cut more widely; whatever is cut, results are those of whole series."""
    monkeypatch.setattr(sequences, "FEW", few)
    rows = series(900) + [(f"short{i % 40}", 10**7 * i, 900 + i, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, SERIES)
    chunks = sequences._cut(df, ["k"], "40s").groupBy("k", "_chunk").count().groupBy("k").agg(F.count("*").alias("chunks"), F.sum("count").alias("n"), F.max("_chunk").alias("last")).collect()
    assert all((r["last"] is None) == (r["n"] <= few) for r in chunks)
    if few:
        assert all(r["chunks"] <= r["n"] / few + 2 for r in chunks) and (few > 100 or any(r["chunks"] > 3 for r in chunks))
    whole = {r["seq"]: r for r in sequences.filtered(df, FILTERS, ["k"]).collect()}
    got = sequences.filtered(df, FILTERS, ["k"], "40s").collect()
    assert len(got) == len(rows)
    for r in got:
        for name in FILTERS:
            want = whole[r["seq"]][name]
            assert (r[name] is None) == (want is None) and (want is None or r[name] == pytest.approx(want, rel=1e-9, abs=1e-9)), (name, r)


def test_chunks_of_one_series_are_many_tasks_work(spark):
    df = spark.createDataFrame(series(50, 1), SERIES)
    plan = sequences.filtered(df, {"y": ("KF", 1.0, 0.5)}, ["k"], "1m")._jdf.queryExecution().toString()
    assert "_at" in plan and "hashpartitioning(k#" not in plan.split("_start")[0]  # records are dealt by chunk


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-50, 50).map(lambda x: round(x, 3)), min_size=1, max_size=60), st.lists(st.integers(0, 60), max_size=5), st.sampled_from([*FILTERS.values(), ("LAST", 3), ("RSI", 4), ("RSI", 1)]))
def test_what_chunks_do_to_a_state(values, cuts, spec):
    op, *args = spec
    f, x = sequences.STATEFUL[op][0], np.array(values)
    state = None
    for part in np.split(x, sorted(min(c, len(x)) for c in cuts)):
        m = sequences.CHUNKS[op](*args)
        for piece in np.array_split(part, 2):
            if len(piece):
                m.add(piece)
        state = m.after(state)
    _, want = f(None, x, np.zeros(len(x), int), *args)
    flat = lambda x: [x[0], *x[1]] if op == "RSI" else np.atleast_1d(x)
    assert flat(state) == pytest.approx(flat(want), rel=1e-7, abs=1e-7)


SEQUENCES = ["FOF#0.3", "EMA#5", "DIF#3,6", "DEJUMP#-8,8", "KF#1,0.5", "LAST#3", "VAR#1", "TREND#2", "RSI#4"]


def test_rules_in_chunks_are_those_of_whole_series(spark):
    rows = [(k, "t", 0, ms, seq, v) for k, ms, seq, v in series(600, 2, 3)]
    rules = spark.createDataFrame([(tag, "t", f"{tag}{i}", *s.split("#"), "j", 1, 1) for i, s in enumerate([*SEQUENCES, "RSI_AVG#3|1m,1m"]) for tag in ("a", "b")], CONF)
    raw = spark.createDataFrame([r for r in rows if r[0]], RAW)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "53")
    try:
        results = [sorted(((r["out_name"], r["ms"], r["seq"], r["value"]) for r in calculate(raw, rules, ["message"], ["out_name"], chunk=c).collect()), key=lambda x: x[:3]) for c in (None, "30s", "20m")]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(results[0]) > 3000
    for other in results[1:]:
        assert [x[:3] for x in other] == [x[:3] for x in results[0]]
        assert all(x[3] == y[3] or x[3] == pytest.approx(y[3], abs=1.1e-4) for x, y in zip(other, results[0]))


def test_few_values_say_what_a_chunk_does_to_jumps():
    m = sequences.Unjumped(-5.0, 5.0)
    rng = np.random.default_rng(2)
    m.add(np.repeat(rng.normal(0, 10, 2000).round(2), 3))
    m.add(np.full(5000, 3.25))
    assert len(m.values) < 60


# ---- windows --------------------------------------------------------------------------------------------------------


def test_operators_carry_their_own_records(spark):
    rows = [("a", 10, 1, 5.0), ("a", 20, 2, 9.0), ("a", 30, 3, 9.0), ("a", 40, 4, None), ("a", 50, 5, 5.0), ("a", 60, 6, 7.0), ("b", 10, 7, None), ("b", 15, 8, None)]
    df = spark.createDataFrame(rows, SERIES)
    ops = {"hi": "MAX", "lo": "MIN", "mid": "MEDIAN", "now": "INTERP", "avg": "AVG"}
    for size, slide in ((100, 100), (100, 50)):
        got = {(r["k"], r["win_start"]): r for r in windows.window_aggregate(df, ops, ["k"], size, slide, carry_each=["seq", "ms"]).collect()}
        r = got["a", 0]
        assert (r["hi_seq"], r["lo_seq"], r["mid_seq"], r["now_seq"], r["avg_seq"], r["mid"], r["hi_ms"]) == (3, 5, 3, 6, 1, 7.0, 30)
        assert (got["b", 0]["avg_seq"], got["b", 0]["hi_seq"], got["b", 0]["mid"]) == (7, None, None)


def test_medians_of_overlapping_windows(spark):
    rows = series(500)
    got = windows.window_aggregate(spark.createDataFrame(rows, SERIES), {"m": "MEDIAN"}, ["k"], "7m", "2m")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Aggregate") > plan.index("Generate")  # records are summed up before they are dealt to windows
    want = {}
    for k, ms, _, v in rows:
        last = ms - ms % 120_000
        for start in range(last, ms - 420_000, -120_000):
            want.setdefault((k, start), []).append(v)
    assert {(r["k"], r["win_start"]): r["m"] for r in got.collect()} == {k: round_exact(statistics.median(live)) if (live := [x for x in v if x is not None]) else None for k, v in want.items()}


def round_exact(x, places=4):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(float(x))).quantize(Decimal("1e-10"), ROUND_HALF_UP).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.floats(-1e6, 1e6), st.integers(-10**7, 10**7).map(lambda i: i / 20_000), st.floats(-1e12, 1e12)), st.sampled_from([4, 8, 9]))
def test_rounding_of_arrays(x, places):
    assert chains.rounded(np.array([x]), places)[0] == round_exact(x, places) or abs(x) > 1e11


def test_rounding_is_that_of_columns(spark):
    rng = random.Random(4)
    x = [rng.uniform(-100, 100) for _ in range(500)] + [i / 20_000 for i in range(-500, 500)] + [2.00005, -2.00005, 0.00005, 1.00015, 1e-12]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(round_half_up(F.col("x"))).collect()]
    assert chains.rounded(np.array(x)).tolist() == got


# ---- chains in a stream ---------------------------------------------------------------------------------------------

def fed(spark, tmp_path, parts, rules, name="run", late="1 second", **more):
    """The results of ``rules`` over a stream that comes in ``parts``, started anew for each."""
    source = tmp_path / f"{name}-in"
    out = None
    for part in parts:
        spark.createDataFrame(part, RAW).coalesce(1).write.mode("append").parquet(str(source))
        raw = spark.readStream.schema(RAW).parquet(str(source))
        out = streams.replay(calculate(raw, spark.createDataFrame(rules, CONF), ["message"], ["out_name"], late=late, **more), str(tmp_path / name))
    return sorted((r["out_name"], r["ms"], r["seq"], r["value"]) for r in out.collect())


SPECS = ["AVG_KF_MAX#5s,5s|1,0.5|1m,20s", "FOF_MEDIAN_VAR#0.3|30s,30s|2", "SLOPE#20s,10s", "DEJUMP_EMA_RSI_STD#-20,20|3|4|1m,1m", "MIN_LAST#10s,5s|1", "CV#30s,10s", "INTERP_TREND#10s,10s|1", "PSEQ#10s,10s", "RAW#1"]


def test_chains_in_a_stream_are_those_of_a_batch(spark, tmp_path):
    """Window, sequence, window..., with nulls, over three starts: the results of a batch, as far as the watermark came."""
    rows = [(k, "t", 0, ms, seq, v) for k, ms, seq, v in series(300, 2, 5, nulls=False)]
    rows = [(*r[:5], None if r[4] % 17 == 3 else r[5]) for r in rows]
    rules = [(tag, "t", f"{tag}{i}", *s.split("#"), "j", 1, 1) for i, s in enumerate(SPECS) for tag in ("a", "b")]
    parts = [[r for r in rows[k * 100 : k * 100 + 100]] for k in range(3)]
    for p in parts:
        random.Random(1).shuffle(p)
    got = fed(spark, tmp_path, parts, rules)
    mark = max(r[3] for r in rows) - 1000
    batch = calculate(spark.createDataFrame(rows, RAW), spark.createDataFrame(rules, CONF), ["message"], ["out_name"]).collect()
    ends_with_window = {f"{tag}{i}": parse_spec(*s.split("#"))[-1].op in WINDOW_OPS for i, s in enumerate(SPECS) for tag in ("a", "b")}
    first_window = {f"{tag}{i}": parse_spec(*s.split("#"))[0].op in WINDOW_OPS for i, s in enumerate(SPECS) for tag in ("a", "b")}
    ok = lambda r: r["out_name"][1:] == "8" or (r["ms"] <= mark if ends_with_window[r["out_name"]] or first_window[r["out_name"]] else r["ms"] < mark)
    want = sorted(((r["out_name"], r["ms"], r["seq"], r["value"]) for r in batch if ok(r)), key=str)
    assert {x[0] for x in got} == set(ends_with_window) and len(got) == len(want)
    off = [(a, b) for a, b in zip(sorted(got, key=lambda x: str(x[:3])), sorted(want, key=lambda x: str(x[:3]))) if a[:3] != b[:3] or not (a[3] == b[3] or a[3] == pytest.approx(b[3], abs=1.1e-4))]
    assert off == []


@pytest.mark.parametrize("op,args,varies", [("LAST", (3,), False), ("RSI", (4,), False), ("KF", (1.0, 0.5), False), ("LAST", (1,), True)])
def test_long_series_of_a_stream_are_cut(spark, tmp_path, monkeypatch, op, args, varies):
    """A micro-batch's series is many chunks, each from its own state; the states outlast a restart."""
    monkeypatch.setattr(sequences, "FEW", 0)
    rows = series(500)
    lag = lambda ms: ms // 100_000 % 2 + 1 if varies else args[0]
    want = {}
    for k in {r[0] for r in rows}:
        state, n = None, None
        for _, ms, seq, v in (r for r in rows if r[0] == k):
            state, n = (None if n not in (None, lag(ms)) else state), lag(ms)
            out = [np.inf]
            if v is not None:
                out, state = sequences.STATEFUL[op][0](state, np.array([v]), np.zeros(1, int), n, *args[1:])
            if not np.isnan(out[0]):
                want[seq] = None if np.isinf(out[0]) else float(out[0])
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(SERIES).parquet(str(tmp_path / "in"))
    changing = (F.floor(F.col("ms") / 100_000) % 2 + 1) if varies else None
    for k, part in enumerate((rows[:300], rows[300:310], rows[310:])):
        spark.createDataFrame(part, SERIES).write.mode("append").parquet(str(tmp_path / "in"))
        got = streams.replay(streams.stream_sequence(source, op, args, "k", changing, chunk="60s"), str(tmp_path / "run"))
        held = spark.read.parquet(str(tmp_path / "run" / "state" / str(k)))
        assert held.count() == held.select("_series").distinct().count() == 4
    got = {r["seq"]: r["value"] for r in got.collect()}
    assert got.keys() == want.keys() and len(got) > 300
    assert all((want[s] is None) == (v is None) and (v is None or v == pytest.approx(want[s], abs=1.1e-4)) for s, v in got.items())


def test_late_records_and_formulas_in_a_stream(spark, tmp_path):
    """What comes within the lateness counts in its order; what comes after that goes. A message closes with its span."""
    t = 1_704_067_200_000
    rules = [("a", "t", "last", "LAST", "1", "j", 1, 1), ("a", "t", "sum", "SUM", "10s,10s", "j", 1, 1), ("[a] - [b]", "t", "diff", "RAW", "", "j", 1, 1), ("[a] - [b]", "t", "mean", "AVG", "1m,1m", "j", 1, 1)]
    one = [("a", "t", 1, t + 1000, 1, 1.0), ("b", "t", 1, t + 1500, 2, 10.0), ("a", "t", 1, t + 5000, 3, 3.0)]
    two = [("a", "t", 1, t + 4500, 4, 2.0), ("a", "t", 2, t + 31_000, 6, 4.0), ("a", "t", 3, t + 65_000, 7, 5.0)]
    got = fed(spark, tmp_path, [one, two, [("b", "t", 9, t + 200_000, 8, 0.0), ("a", "t", 1, t + 9000, 5, 99.0)]], rules, span="30 seconds")
    assert [x[1:] for x in got if x[0] == "last"] == [(t + 4500, 4, 1.0), (t + 5000, 3, 2.0), (t + 31_000, 6, 3.0), (t + 65_000, 7, 4.0)]
    assert [(x[1], x[3]) for x in got if x[0] == "sum"] == [(t + 10_000, 6.0), (t + 40_000, 4.0), (t + 70_000, 5.0)]
    assert [(x[1], x[3]) for x in got if x[0] == "diff"] == [(t + 4500, -8.0), (t + 31_000, 4.0), (t + 65_000, 5.0)]
    assert [(x[1], x[3]) for x in got if x[0] == "mean"] == [(t + 60_000, -2.0), (t + 120_000, 5.0)]


def test_windows_close_once(spark):
    step = chains.WindowStep("SUM", 4, 2)
    rows = lambda *r: tuple(np.array(c, t) for c, t in zip(zip(*r), (np.int64, np.int64, float)))
    out, state = step.run(None, rows((1, 1, 1.0), (3, 2, 2.0)), 3)
    assert out[0].tolist() == [2] and out[2].tolist() == [1.0] and step.next(state, 3) == 4
    out, state = step.run(state, rows((5, 3, 4.0)), 6)
    assert out[0].tolist() == [4, 6] and out[2].tolist() == [3.0, 6.0]
    out, state = step.run(state, chains.NONE, 100)
    assert out[0].tolist() == [8] and out[2].tolist() == [4.0] and state[0] == {} and step.next(state, 100) is None


# ---- changes --------------------------------------------------------------------------------------------------------

TABLE = "id int, x string"


def envelope(op, ts, key, value=None, pos=None):
    row = {"id": str(key), "x": value}
    return json.dumps({"before": row if op in "ud" else None, "after": None if op == "d" else row, "op": op, "ts_ms": ts, "source": {"table": "t", **({} if pos is None else {"pos": pos})}})


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from("ud"), st.sampled_from("xyz")), min_size=1, max_size=12), st.randoms())
def test_changes_in_any_order(spark, log, rng):
    """Changes one after the other, shuffled, in several steps: always the state of the ordered log."""
    rows = [(k, v, op, i) for i, (k, op, v) in enumerate(log)]
    want = {}
    for k, v, op, _ in rows:
        want.pop(k, None)
        if op == "u":
            want[k] = v
    rng.shuffle(rows)
    frame = lambda r: spark.createDataFrame(r, f"{TABLE}, op string, ts_ms long")
    cut = len(rows) // 2
    state = changes.merge_changes(changes.merge_changes(spark.createDataFrame([], TABLE), frame(rows[:cut]), ["id"]), frame(rows[cut:]), ["id"])
    assert {r["id"]: r["x"] for r in changes.live(state).collect()} == want


def test_change_log_over_batches(spark, tmp_path):
    source, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    schema, key = TABLE, ["id"]

    def add(*texts, **how):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(str(source))
        changes.follow(spark.readStream.text(str(source)), key, schema, table, check, fold=2, **how).awaitTermination()
        return sorted(map(tuple, changes.current(spark, table, schema, key).collect()))

    assert changes.current(spark, table, schema, key).count() == 0
    assert add(envelope("c", 20, 1, "new"), envelope("c", 5, 2, "b"), envelope("c", 7, 3, "c", 1), "broken") == [(1, "new"), (2, "b"), (3, "c")]
    assert add(envelope("u", 10, 1, "old"), envelope("d", 30, 2), envelope("u", 7, 3, "later", 2)) == [(1, "new"), (3, "later")]
    assert add(envelope("u", 25, 2, "back?"), envelope("u", 7, 3, "earlier", 1)) == [(1, "new"), (3, "later")]
    assert add(envelope("c", 40, 2, "again")) == [(1, "new"), (2, "again"), (3, "later")]
    for k in range(3):
        assert add(envelope("d", 50 + k, 4)) == [(1, "new"), (2, "again"), (3, "later")]
    left = sorted(p.name for p in (tmp_path / "table").iterdir())
    assert [n for n in left if n.startswith("base")] == ["base=3", "base=5"] and "delta=0" not in left and "delta=6" in left
    assert changes.state_of(spark, table, schema, key).where("_gone").count() == 1
    assert add(envelope("c", 100, 5, "e"), forget_ms=40) and changes.state_of(spark, table, schema, key).where("_gone").count() == 0


def test_rules_as_of_the_time_of_a_record(spark):
    cols = "tag_name string, tag_topic string, out_name string, calculate_type string, param string, task_name string, line_id int, status int, op string, ts_ms long, pos long"
    rule = lambda out, param, op, ts, pos=0, tag="a", status=1: (tag, "t", out, "LAST", param, "j", 1, status, op, ts, pos)
    log = [rule("r", "1", "c", 100), rule("r", "2", "u", 200), rule("r", "3", "u", 300, 1), rule("r", "4", "u", 300, 2), rule("r", "", "d", 400), rule("r", "5", "c", 500), rule("s", "9", "c", 150, tag="b"), rule("s", "10", "u", 250, tag="a"), rule("o", "0", "c", 0, status=0)]
    versions = changes.intervals(spark.createDataFrame(log, cols), ["out_name"])
    raw = spark.createDataFrame([(n, "t", ms, ms, 1.0) for n in ("a", "b") for ms in (50, 100, 199, 200, 299, 300, 399, 400, 499, 500, 10**9)], "name string, topic string, ms long, seq long, value double")
    want = sorted([("a", 100, "1"), ("a", 199, "1"), ("a", 200, "2"), ("a", 299, "2"), ("a", 300, "4"), ("a", 399, "4"), ("a", 500, "5"), ("a", 10**9, "5")] + [("a", m, "10") for m in (299, 300, 399, 400, 499, 500, 10**9)] + [("b", 199, "9"), ("b", 200, "9")])
    for most in (enrich.SMALL, 0):
        for bucket in ("100ms", "1d"):
            got = changes.enrich_as_of(raw, versions, bucket, most)
            assert sorted((r["name"], r["ms"], r["param"]) for r in got.collect()) == want
    assert got.columns == [c for c in enrich.enrich(raw, versions.drop("valid_from", "valid_to")).columns if c != "tag_topic"] + ["tag_topic"] or "tag_topic" in got.columns


# ---- sinks and sources ----------------------------------------------------------------------------------------------


def test_database_has_each_batch_once(spark, tmp_path):
    url, driver = f"jdbc:derby:memory:{tmp_path.name};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    read = lambda t: spark.read.format("jdbc").options(url=url, dbtable=t, driver=driver).load()
    write = connectors.jdbc_batches(url, "results", query="q", driver=driver)
    batch = lambda *r: spark.createDataFrame(r, "out_name string, value double, line_id int").repartition(3)
    write(batch(("a", 1.0, 1), ("b", None, 2)), 0)
    write(batch(("a", 1.0, 1), ("b", None, 2)), 0)
    write(batch(("c", 3.0, 1)), 1)
    connectors.jdbc_batches(url, "results", query="other", driver=driver)(batch(("d", 4.0, 1)), 0)
    rows = lambda: sorted(tuple(r) for r in read('"results"').collect())
    assert rows() == [("a", 1.0, 1), ("b", None, 2), ("c", 3.0, 1), ("d", 4.0, 1)]
    with pytest.raises(Exception):  # noqa: B017
        write(spark.createDataFrame([("e", "x")], "out_name string, other string"), 2)  # no such column: nothing may stay
    assert len(rows()) == 4 and sorted((r[0], r[1]) for r in read(f'"{connectors.LEDGER}"').collect()) == [("other", 0), ("q", 0), ("q", 1)]
    write(batch(("e", 5.0, 1)), 2)
    assert ("e", 5.0, 1) in rows() and len(rows()) == 5
    stream = tmp_path / "in"
    batch(("f", 6.0, 1)).write.parquet(str(stream))
    source = spark.readStream.schema("out_name string, value double, line_id int").parquet(str(stream))
    connectors.micro_batches(source, connectors.jdbc_batches(url, "results", query="s", driver=driver), str(tmp_path / "check"), every=None).awaitTermination()
    assert ("f", 6.0, 1) in rows()
    with pytest.raises(ValueError):
        connectors.jdbc_batches(url, "x; drop table y")
    conf = spark.createDataFrame([("a", "job1"), ("b", "job2")], "tag_name string, task_name string")
    conf.write.format("jdbc").options(url=url, dbtable="tag_conf", driver=driver, createTableColumnTypes="tag_name VARCHAR(50), task_name VARCHAR(50)").save()
    assert [r["tag_name"] for r in connectors.jdbc_rules(spark, url, ["job2"], driver=driver).collect()] == ["b"]
    assert connectors.jdbc_rules(spark, url, driver=driver).count() == 2


def test_posts_leave_dead_letters(spark, tmp_path):
    log, path = tmp_path / "sent", str(tmp_path / "posts")
    (tmp_path / "down").touch()

    def send(url, body):
        with log.open("a") as f:
            f.write(body + "\n")
        if body == "bad":
            return 400
        if body == "lost" and (tmp_path / "down").exists():
            raise OSError
        return 200

    write = connectors.post_batches(path, send, tries=2)
    assert connectors.dead_letters(spark, path).count() == 0
    batch = lambda *b: spark.createDataFrame([("http://x", x) for x in b], "url string, body string")
    write(batch("a", "bad", "lost"), 0)
    write(batch("a", "bad", "lost"), 0)
    assert sorted(log.read_text().split()) == ["a", "bad", "lost", "lost"]
    dead = lambda: sorted((r["body"], r["status"]) for r in connectors.dead_letters(spark, path).collect())
    assert dead() == [("bad", 400), ("lost", -1)]
    (tmp_path / "down").unlink()
    assert sorted(r["body"] for r in connectors.repost(spark, path, send).collect()) == ["bad"]
    write(batch("bad", "b"), 1)
    assert dead() == [("bad", 400), ("bad", 400)]
    connectors.repost(spark, path, lambda u, b: 200)
    assert dead() == []


def test_polls_survive_a_restart(tmp_path):
    answers = iter(['[{"a": 1}, {"a": 2}]', "[]", '[{"a": 3}]'])
    new = lambda f=None: connectors._Polls("u", str(tmp_path / "polls"), f)
    reader = new(lambda u: next(answers))
    rows, end = reader.read(reader.initialOffset())
    assert [json.loads(r[0])["a"] for r in rows] == [1, 2] and end == {"poll": 1}
    again = new()
    assert [json.loads(r[0])["a"] for r in again.readBetweenOffsets({"poll": 0}, {"poll": 1})] == [1, 2]
    rows, end = new(lambda u: pytest.fail("polled again")).read({"poll": 0})  # its offset was never told
    assert len(list(rows)) == 2 and end == {"poll": 1}
    assert reader.read(end)[1] == end  # an empty answer is no poll
    rows, end = reader.read(end)
    assert [json.loads(r[0])["a"] for r in rows] == [3] and end == {"poll": 2}
    new().commit({"poll": 1})
    assert [json.loads(r[0])["a"] for r in new().readBetweenOffsets({"poll": 1}, {"poll": 2})] == [3]
    with pytest.raises(OSError):
        new().readBetweenOffsets({"poll": 0}, {"poll": 2})

    def broken(u):
        raise OSError

    assert new(broken).read({"poll": 5})[1] == {"poll": 5}


# ---- clocks, assembly, patterns, changing lags ----------------------------------------------------------------------


def test_windows_by_the_clock(spark, tmp_path):
    """Records count when they come, however old their own time is; windows are told without new records."""
    import time

    source = tmp_path / "in"
    add = lambda *r: spark.createDataFrame(r, "k string, seq long, value double").coalesce(1).write.mode("append").parquet(str(source))
    add(("a", 1, 1.0), ("a", 2, None), ("b", 3, 5.0))
    s = spark.readStream.schema("k string, seq long, value double").parquet(str(source))
    out = streams.stream_arrival_windows(s, "SUM", ["k"], "4s", "4s")
    q = out.writeStream.format("memory").queryName("by_clock").outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="500 milliseconds").start()
    try:
        until = time.time() + 90
        while time.time() < until and spark.table("by_clock").count() < 2:
            time.sleep(0.5)
        first = {(r["k"], r["value"], r["win_start"]) for r in spark.table("by_clock").collect()}
        add(("a", 0, 7.0))  # "late" by its number; it comes now
        while time.time() < until and spark.table("by_clock").count() < 3:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.table("by_clock").collect()
    assert {(k, v) for k, v, _ in first} == {("a", 1.0), ("b", 5.0)} and all(r["win_end"] - r["win_start"] == 4000 and r["win_start"] % 4000 == 0 for r in rows)
    assert sorted((r["k"], r["value"]) for r in rows) == [("a", 1.0), ("a", 7.0), ("b", 5.0)] and max(r["win_start"] for r in rows) > max(w for *_, w in first)


def test_assembly_counts_what_is_lost(spark, tmp_path):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    schema, source = "post_name string, ts timestamp, out_name string, value double", tmp_path / "in"
    parts = [
        [("p", t(0), "a", 1.0), ("p", t(1), "a", 1.5), ("q", t(0), "x", None)],
        [("p", t(0), "b", None), ("p", t(0), "b", 9.0), ("p", t(1), "a", 2.5)],
        [("p", t(60), "a", 3.0)],
        [("p", t(61), "a", 0.0), ("p", t(60), "b", 4.0), ("p", t(60), "a", 5.0), ("p", t(1), "b", 7.0)],
        [("p", t(300), "a", 3.0)],
    ]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source))
        s = spark.readStream.schema(schema).parquet(str(source))
        out = streams.replay(streams.stream_assemble(s, {"p": 2, "q": 1}, 5000, "2 seconds", {"p": "http://p"}, incomplete=True), str(tmp_path / "run"))
    base = 1_704_067_200_000
    got = sorted((r["post_name"], r["ms"] - base, json.loads(r["body"]), r["complete"], r["missing"]) for r in out.collect())
    assert got == [("p", 0, {"a": 1.0, "b": 9.0}, True, 0), ("p", 1000, {"a": 2.5}, False, 1), ("p", 60_000, {"a": 5.0, "b": 4.0}, True, 0), ("p", 61_000, {"a": 0.0}, False, 1), ("q", 0, {"x": None}, True, 0)]


def test_patterns_of_times(spark):
    from sensorloom.operators import pattern

    rng = random.Random(6)
    names = [rng.choice("aab") for _ in range(300)]
    rows = [("k" if i < 150 else None, i * 10, i, n) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "k string, ms long, seq long, name string")
    is_ = lambda x: F.col("name") == x
    got = lambda steps, **w: sorted((r["first_seq"], r["last_seq"]) for r in pattern.match_times(df, steps, ["k"], **w).collect())
    for text in ("a" * 3, "aab", "baab", "b" * 2):
        runs, steps = [], []
        for c in text:
            if runs and runs[-1][0] == c:
                runs[-1][1] += 1
            else:
                runs.append([c, 1])
        steps = [(is_(c), n) for c, n in runs]
        want = [(i, i + len(text) - 1) for i in range(300 - len(text) + 1) if "".join(names[i : i + len(text)]) == text and (i < 150) == (i + len(text) - 1 < 150)]
        assert got(steps) == want == sorted((r["first_seq"], r["last_seq"]) for r in pattern.match_next(df, [c for s, n in steps for c in pattern.times(s, n)], ["k"]).collect())
    assert got([(is_("a"), 2)], within=10) == [] and len(got([(is_("a"), 2)], within=11)) > 50
    with pytest.raises(ValueError):
        pattern.match_times(df, [(is_("a"), 0)], ["k"])


def test_changing_lags_in_chunks(spark):
    rng = random.Random(9)
    rows = [(*r, rng.choice([1, 1, 1, 2])) for r in series(600)]
    df = spark.createDataFrame(rows, f"{SERIES}, n long")
    whole = sorted(map(str, sequences.lag_stage(df, "LAST", 2, ["k"], F.col("n")).collect()))
    for chunk in ("1m", "30m"):
        assert sorted(map(str, sequences.lag_stage(df, "LAST", 2, ["k"], F.col("n"), chunk).collect())) == whole
    assert len(whole) > 100
