"""Formulas, messages, changes, posting, streams, and every query against its SQL."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sensorloom import catalog
from sensorloom.functions import compile_formula, formula_tags, parse_duration
from sensorloom.operators import changes, enrich, route
from sensorloom.sources import connectors, messages
from sensorloom.streaming import operators as streams

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("text,row,want", [
    ("[a] / ([b] + [c])", (6.0, 1.0, 2.0), 2.0),
    ("([a] > [b])?1:0", (37.0, 3.0, 0.0), 1.0),
    ("[a] - [b]", (9.0, 7.0, 0.0), 2.0),
    ("[a] / [b]", (1.0, 0.0, 0.0), 0.0),
    ("[a] > [b]", (2.0, 1.0, 0.0), 0.0),
    ("[a] + [b]", (2.0, None, 0.0), 2.0),
    ("([a] > 1 && !([b] == 2) || [c] >= 9) ? ([a] > 5 ? 3 : [a]) : -1", (4.0, 1.0, 0.0), 4.0),
    ("[a] != [b] ? 2.5 : 1", (1.0, 1.0, 0.0), 1.0),
])
def test_formula(spark, text, row, want):
    df = spark.createDataFrame([row], "a double, b double, c double")
    assert df.select(compile_formula(text, lambda t: F.col(t)).alias("x")).first()["x"] == want


def test_formula_text(spark):
    assert formula_tags("[S::C4T/C4.MV] - [S::C6T/C6.MV] + [S::C4T/C4.MV]") == ["S::C4T/C4.MV", "S::C6T/C6.MV"]
    for bad in ("[a] +", "[a] ? 1", "__import__('os')", "[a].real", "f([a])"):
        with pytest.raises(ValueError):
            compile_formula(bad, F.col)
    assert [parse_duration(x) for x in ("5s", "1m", "2h", "1d", "250ms")] == [5000, 60000, 7200000, 86400000, 250]
    with pytest.raises(ValueError):
        parse_duration("5")


def test_messages(spark):
    tags = [("t1", "20240102030405", "1.23456"), ("t2", "20240102030405", "True"), ("", "20240102030405", "1"), ("t3", "x", "1"), ("t4", "20240102030405", "abc"), ("t5", "20240102030405", "")]
    assert messages.unpack_tags(messages.pack_tags(tags)) == tags
    assert messages.unpack_tags(b"\x0a\xff") == [] and messages.unpack_tags(None) == []
    df = spark.createDataFrame([(1, bytearray(messages.pack_tags(tags))), (2, bytearray(b"\x0a\xff")), (3, None)], "id int, value binary")
    got = messages.clean_tags(messages.decode_protobuf(df)).orderBy("name").collect()
    assert [(r["name"], float(r["value"]), r["str_value"], r["ms"]) for r in got] == [("t1", 1.2346, None, 1704164645000), ("t2", 1.0, "True", 1704164645000)]
    back = messages.decode_json(messages.encode_json(messages.clean_tags(messages.decode_protobuf(df)).drop("ms")).union(spark.createDataFrame([("{broken",)], "value string")))
    assert back.count() == 2


def test_changes(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, x string")
    log = spark.createDataFrame([(1, "a2", "u", 5), (1, "a3", "u", 7), (2, "b", "d", 6), (4, "d", "c", 1)], "id int, x string, op string, ts_ms long")
    assert sorted(map(tuple, changes.apply_changes(now, log, ["id"]).collect())) == [(1, "a3"), (3, "c"), (4, "d")]


def test_assembly_and_feedback(spark):
    setup = spark.createDataFrame([("p", " a, b ,a", "http://x")], "post_name string, post_keys string, post_url string")
    r = spark.createDataFrame([("a", 1, 1, 1.0), ("b", 1, 2, 2.0), ("a", 2, 3, 3.0), ("z_$", 1, 4, 9.0)], "out_name string, ms long, seq long, value double")
    got = route.assemble(r, setup).collect()
    assert [(g["ms"], g["values"]) for g in got] == [(1, {"a": 1.0, "b": 2.0})]
    assert [(x["ms"], x["tags"][0]["name"]) for x in route.feedback(r).collect()] == [(1, "z_$")]
    assert enrich.small(setup, most=0) is setup


def test_http(spark):
    rows = connectors.http_table(spark, "u", "a int, b string", fetch=lambda u: '[{"a": 1, "b": "x"}, {"a": 2}]').collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, None)]
    df = spark.createDataFrame([("ok", "1"), ("no", "2")], "url string, body string")

    def send(url, body):
        if url == "no":
            raise OSError
        return 200

    assert sorted((r["url"], r["status"], r["tries"]) for r in connectors.post_rows(df, send, tries=2).collect()) == [("no", -1, 2), ("ok", 200, 1)]


def stream_of(spark, tmp_path, rows, schema, name="in"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path), path


@pytest.mark.parametrize("op,args", [("VAR", (2,)), ("EMA", (5,)), ("DIF", (3, 6)), ("KF", (1.0, 0.5)), ("DEJUMP", (-1.0, 1.0))])
def test_stream_sequences_equal_batch(spark, tmp_path, op, args):
    from sensorloom.plans.compiler import run_stage
    from sensorloom.plans.spec import Stage

    schema = "k string, ms long, seq long, value double"
    first = [("a", i, i, float(i * i % 13)) for i in range(20)] + [("b", i, i, float(i % 5)) for i in range(9)]
    later = [("a", i, i, float(i * i % 13)) for i in range(20, 31)]
    s, path = stream_of(spark, tmp_path, first, schema)
    q = lambda: streams.replay(streams.stream_sequence(s, op, args, "k"), str(tmp_path / "run"))
    q()
    stream_of(spark, tmp_path, later, schema)
    got = sorted(map(tuple, q().select("k", "ms", "seq", "value").collect()))
    want = run_stage(spark.createDataFrame(first + later, schema), Stage(op, args), ["k"])
    assert got == sorted(map(tuple, want.select("k", "ms", "seq", "value").collect()))


def test_stream_drops_late_rows(spark, tmp_path):
    schema = "k string, ts timestamp, seq long, value double"
    import datetime as dt

    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=s)
    s, _ = stream_of(spark, tmp_path, [("a", t(1), 1, 1.0), ("a", t(30), 2, 2.0)], schema)
    run = lambda: streams.replay(streams.stream_windows(s, {"sum": "SUM"}, ["k"], "10 seconds", "10 seconds"), str(tmp_path / "run"))
    run()
    stream_of(spark, tmp_path, [("a", t(2), 3, 50.0), ("a", t(31), 4, 4.0), ("a", t(60), 5, 0.0)], schema)
    assert sorted(r["sum"] for r in run().collect()) == [1.0, 6.0]


def test_stream_assemble(spark, tmp_path):
    import datetime as dt

    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    schema = "post_name string, ts timestamp, out_name string, value double"
    s, _ = stream_of(spark, tmp_path, [("p", t(1), "a", 1.0), ("p", t(1), "b", 2.0), ("p", t(2), "a", 3.0), ("p", t(20), "a", 4.0)], schema)
    run = lambda: streams.replay(streams.stream_assemble(s, {"p": 2}), str(tmp_path / "run"))
    run()
    stream_of(spark, tmp_path, [("p", t(2), "b", 9.0), ("p", t(20), "b", 5.0)], schema)  # the first is too late
    assert sorted(json.loads(r["body"])["b"] for r in run().collect()) == [2.0, 5.0]


@pytest.fixture(scope="session")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, data, sql, name):
    got = entry.queries()[name](spark, data)
    cols = sorted(got.columns)
    want = sql.sql(f"select {', '.join(f'"{c}"' for c in cols)} from ({catalog.ORACLES[name]})").fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want, key=key)


def test_windows_are_one_aggregation(spark, data):
    plan = catalog.QUERIES["win_avg_sliding"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")  # panes are summed below the dealing to windows


def test_entry(spark, data):
    if data.endswith("sf0.001"):
        assert entry.entry(spark).count() > 0


def test_rules_beyond_the_bound_are_an_error(spark, monkeypatch):
    from sensorloom.operators import enrich
    from sensorloom.plans.compiler import run_rules

    monkeypatch.setattr(enrich, "SMALL", 2)
    conf = spark.createDataFrame([(f"n{k}", f"[a]+{k}") for k in range(3)], "out_name string, tag_name string")
    assert len(enrich.formulas_of(conf.limit(2))) == 2
    with pytest.raises(ValueError, match="more than 2 formula rules"):
        enrich.formulas_of(conf)


def test_rules_meet_by_shape(spark):
    """Hundreds of specs make one plan per shape, and each equals its own chain."""
    from sensorloom.plans.compiler import run_chain, run_rules
    from sensorloom.plans.spec import parse_spec

    specs = [("AVG", f"{k}s,{k}s") for k in range(1, 80)] + [("MAX_VAR", f"{k}s,1s|{1 + k % 3}") for k in range(1, 20)] + [("LAST", "3"), ("RSI_EMA", "2|4"), ("MEDIAN", "4s,2s"), ("RAW", ""), ("DEJUMP_DIF_SUM", "-3,3|2,4|5s,5s"), ("INTERP", "3s,3s")]
    points = [(i * 700, i, float(i * i % 11)) for i in range(60)]
    rows = [(kind, param, f"{kind}{param}", *x) for kind, param in specs for x in points]
    tags = spark.createDataFrame(rows, "calculate_type string, param string, tag string, ms long, seq long, value double")
    found = run_rules(tags, ["tag"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") <= 5
    got = {}
    for r in found.collect():
        got.setdefault((r["calculate_type"], r["param"]), []).append((r["ms"], r["value"]))
    one = spark.createDataFrame([("x", *p) for p in points], "tag string, ms long, seq long, value double")
    for kind, param in [specs[0], specs[6], ("MAX_VAR", "2s,1s|3"), *specs[-6:]]:
        want = [(r["ms"], None if r["value"] is None else float(r["value"])) for r in run_chain(one, parse_spec(kind, param), ["tag"]).collect()]
        assert sorted(got[kind, param], key=str) == sorted(want, key=str), (kind, param)
    assert len(got) == len(specs)
    with pytest.raises(Exception, match="needs a size"):
        run_rules(spark.createDataFrame([("AVG", "5s", "t", 0, 0, 1.0)], tags.schema), ["tag"]).collect()


def test_formulas_as_rows_equal_columns(spark):
    texts = ["[a] / ([b] + [c])", "([a] > [b]) ? 1 : 0", "[b] - [a]", "[a] > [b]", "[c] % [b]", "[a] / 0", "([a] > 1 && !([b] == 2) || [c] >= 9) ? ([a] > 5 ? 3 : [a]) : -1"]
    conf = spark.createDataFrame([(t, "top", f"f{i}", "RAW", "", "j", i, 1) for i, t in enumerate(texts)] + [("[d]", "other", "g", "RAW", "", "j", 9, 1)], "tag_name string, tag_topic string, out_name string, calculate_type string, param string, task_name string, line_id int, status int")
    rows = [(m, n, "top", m * 10 + i, m * 10 + i, v) for m, vs in enumerate([(6.0, 1.0, 2.0), (1.0, 0.0, 0.0), (None, 2.0, 9.0), (3.0, None, 1.0)]) for i, (n, v) in enumerate(zip("abc", vs)) if not (m == 3 and n == "a")]
    raw = spark.createDataFrame([*rows, (0, "a", "top", 99, 99, 8.0)], "m int, name string, topic string, ms long, seq long, value double")
    got = sorted((r["m"], r["out_name"], r["ms"], r["value"]) for r in enrich.formula_rows(raw, ["m"], conf).collect())
    want = enrich.formula_values(raw, ["m"], {f"f{i}": t for i, t in enumerate(texts)})
    assert got == sorted((r["m"], r["out_name"], r["ms"], r["value"]) for r in want.collect())


def test_change_messages_follow(spark, tmp_path):
    m = lambda before, after, op, ts: json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts, "source": {"table": "tag_conf"}})
    texts = [m(None, {"id": 1, "x": "a"}, "r", 1), m(None, {"id": 2, "x": "b"}, "r", 1), m({"id": 1, "x": "a"}, {"id": 1, "x": "c"}, "u", 3), "{broken", m(None, {"id": 5}, "?", 9), None]
    events = changes.parse_envelopes(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [tuple(r) for r in changes.normalize(events).where("type = 'update'").select("table", "ts", "old").collect()] == [("tag_conf", 3, {"x": "a"})]
    s, path = stream_of(spark, tmp_path, [(t,) for t in texts], "value string")
    run = lambda: changes.follow(s, ["id"], "id int, x string", str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination()
    table = lambda: sorted(map(tuple, changes.current(spark, str(tmp_path / "table"), "id int, x string", ["id"]).collect()))
    assert table() == []
    run()
    assert table() == [(1, "c"), (2, "b")]
    stream_of(spark, tmp_path, [(m({"id": 2, "x": "b"}, None, "d", 5),), (m(None, {"id": 7, "x": "z"}, "c", 6),)], "value string")
    run()
    assert table() == [(1, "c"), (7, "z")]


def test_stream_enrich_reads_rules_anew(spark, tmp_path):
    cols = "tag_name string, tag_topic string, out_name string, calculate_type string, param string, task_name string, line_id int, status int"
    now = [[("a", "t", "one", "RAW", "", "j", 1, 1)]]
    s, _ = stream_of(spark, tmp_path, [("a", "t", 1, 1, 1.0)], "name string, topic string, ms long, seq long, value double")
    run = lambda: streams.stream_enrich(s, lambda: spark.createDataFrame(now[0], cols), connectors.parquet_batches(str(tmp_path / "out")), str(tmp_path / "check")).awaitTermination()
    run()
    now[0] = [("a", "t", "two", "RAW", "", "j", 1, 1)]
    stream_of(spark, tmp_path, [("a", "t", 2, 2, 2.0)], "name string, topic string, ms long, seq long, value double")
    run()
    assert sorted((r["out_name"], r["seq"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("one", 1), ("two", 2)]


def test_stream_nulls(spark, tmp_path):
    """A null in a stream gives a null and leaves the filter's state as it is; TREND over 0 gives a null."""
    schema = "k string, ms long, seq long, value double"
    s, _ = stream_of(spark, tmp_path, [("a", i, i, v) for i, v in enumerate([1.0, None, 2.0, 0.0, 4.0])], schema)
    got = lambda op, args, name: [r["value"] for r in streams.replay(streams.stream_sequence(s, op, args, ["k"]), str(tmp_path / name)).orderBy("seq").collect()]
    assert got("FOF", (0.5,), "f") == [1.0, None, 1.5, 0.75, 2.375]
    assert got("TREND", (1,), "t") == [None, 2.0, 0.0, None] and got("VAR", (1,), "v") == [None, 1.0, -2.0, 4.0]


def test_stream_windows_of_each_record(spark, tmp_path):
    import datetime as dt

    from sensorloom.operators import windows
    from sensorloom.plans.spec import WINDOW_OPS

    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [("ab"[i % 2], t(i), i, None if i % 9 == 4 else round(i * i % 7 - 2.5, 2)) for i in range(40)]
    schema = "k string, ts timestamp, seq long, value double"
    s, _ = stream_of(spark, tmp_path, rows, schema)
    size, slide = F.when(F.col("k") == "a", 6000).cast("long"), F.when(F.col("k") == "a", 4000).cast("long")
    batch = spark.createDataFrame(rows, schema).withColumn("ms", F.unix_millis("ts"))
    want = windows.window_aggregate(batch, {o: o for o in WINDOW_OPS}, ["k"], size, slide).where("win_end <= 1704067200000 + 38000").collect()
    for op in ("SLOPE", "MEDIAN", "CV", "INTERP", "PSEQ", "AVG"):
        got = streams.replay(streams.stream_each_window(s, op, ["k"], size, slide), str(tmp_path / op)).collect()
        assert sorted((r["k"], r["win_start"], r["win_end"], r["value"]) for r in got if r["win_end"] <= 1704067200000 + 38000) == sorted((r["k"], r["win_start"], r["win_end"], r[op]) for r in want)


def test_micro_batches_and_polls(spark, tmp_path):
    import threading
    import time
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Answer(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b'[{"a": 1, "b": "x"}, {"a": 2}]')

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    polled = connectors.http_stream(spark, f"http://127.0.0.1:{server.server_port}", "a int, b string", str(tmp_path / "polls"))
    query = connectors.micro_batches(polled, connectors.parquet_batches(str(tmp_path / "out")), str(tmp_path / "check"), every="1 second")
    until = time.time() + 60
    while time.time() < until and len(query.recentProgress) < 3:
        time.sleep(0.5)
    query.stop()
    server.shutdown()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("a", "b", "batch").count().collect()
    assert {(r["a"], r["b"]) for r in got} == {(1, "x"), (2, None)} and len({r["batch"] for r in got}) >= 2 and all(r["count"] == 1 for r in got)


def test_tables_of_rules(spark):
    conf = spark.createDataFrame([("rt_a", 1), ("rt_a", 1), ("rt_b", 1), ("rt_off", 0), (None, 1)], "sink_table string, status int")
    assert connectors.create_rule_tables(spark, conf) == ["rt_a", "rt_b"]
    assert spark.table("rt_a").columns[:3] == ["out_name", "tag_topic", "value"] and spark.table("rt_b").count() == 0
    with pytest.raises(ValueError):
        connectors.create_rule_tables(spark, spark.createDataFrame([("x; drop table y", 1)], conf.schema))
    for n in ("rt_a", "rt_b"):
        spark.sql(f"DROP TABLE {n}")


def test_topics_and_route(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "line_id int, name string")
    got = messages.encode_json(df, topic=F.concat(F.lit("dwd-"), F.col("line_id")), key=F.col("name")).collect()
    assert [(r["topic"], r["key"], json.loads(r["value"])["name"]) for r in got] == [("dwd-1", "a", "a"), ("dwd-2", "b", "b")]
    post = spark.createDataFrame([("p", "a,b", "http://x")], "post_name string, post_keys string, post_url string")
    r = spark.createDataFrame([("b", 0, 1, 2.0), ("a", 0, 2, None)], "out_name string, ms long, seq long, value double")
    sent = route.post_requests(route.assemble(r, post), post).collect()
    assert [(x["url"], x["body"]) for x in sent] == [("http://x", '{"a":null,"b":"2.0","create_time":"1970-01-01 00:00:00"}')]


def test_generated_series_and_string_messages(spark):
    import time

    s = connectors.generated(spark, ["a", "b"], per_second=20)
    query = s.writeStream.format("memory").queryName("made").outputMode("append").start()
    until = time.time() + 60
    while time.time() < until and spark.table("made").count() < 40:
        time.sleep(0.5)
    query.stop()
    rows = spark.table("made").collect()
    assert {r["name"] for r in rows} == {"a", "b"} and all(0 <= r["value"] < 800 for r in rows) and len({r["seq"] for r in rows}) == len(rows)


def test_stream_patterns_across_batches(spark, tmp_path):
    """A pattern that one micro-batch begins and the next ends, and one that a switch breaks."""
    schema = "k string, ms long, seq long, name string"
    row = lambda i, n: ("k", i * 1000, i, n)
    is_ = lambda x: F.col("name") == x
    s, _ = stream_of(spark, tmp_path, [row(0, "a"), row(1, "b"), row(2, "a")], schema)
    run = lambda: streams.replay(streams.stream_match(s, [is_("a"), is_("b")], ["k"], 5000, [is_("e"), is_("f"), is_("g")], is_("change")), str(tmp_path / "run"))
    run()
    stream_of(spark, tmp_path, [row(3, "b"), row(4, "a"), row(5, "change"), row(6, "b"), row(7, "e"), row(8, "f"), row(9, "g"), row(10, "a"), row(11, "b")], schema)
    assert sorted((r["first_seq"], r["last_seq"]) for r in run().collect()) == [(0, 1), (2, 3), (7, 9)]
