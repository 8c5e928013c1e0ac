"""Compile specs into DataFrames: a chain is a fold of its stages; many rules are one branch per shape of chain."""

from __future__ import annotations

import math
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.formula import formula_tags
from ..functions.times import parse_duration
from ..operators.enrich import SMALL, at_hand, collected, enrich, formula_rows, messages_of, small
from ..operators.route import union_all
from ..operators.sequences import filter_stage, lag_stage, rsi, sequenced
from ..operators.windows import window_aggregate, window_each
from .spec import LAG_OPS, WINDOW_OPS, Stage, parse_spec

#: Operators of users: name -> function (df, args, keys) -> df.
PLUGINS: dict = {}


def operator(name: str):
    """Register a function of (df, args, keys) as an operator of chains."""
    def keep(f):
        PLUGINS[name] = f
        return f

    return keep


def run_stage(df: DataFrame, stage: Stage, keys: list[str], chunk=None) -> DataFrame:
    """(keys, ms, seq, value) -> the same columns after one operator; a window's row stands at its end.

    ``chunk`` cuts long series by time (see sequences.with_before and sequences.filtered).
    """
    op, args = stage.op, stage.args
    if op in PLUGINS:
        return PLUGINS[op](df, args, keys)
    if op in WINDOW_OPS:
        out = window_aggregate(df, {"value": op}, keys, *args)
        return out.select(*keys, F.col("win_end").alias("ms"), F.col("win_start").alias("seq"), "value")
    df = df.select(*keys, "ms", "seq", "value")
    if op in LAG_OPS:
        return lag_stage(df, op, args[0], keys, chunk=chunk)
    if op == "RSI":
        return rsi(df, args[0], keys, chunk)
    return df if op == "RAW" else filter_stage(df, op, args, keys, chunk)


def run_chain(df: DataFrame, stages: tuple[Stage, ...], keys: list[str], chunk=None) -> DataFrame:
    """The stages one after the other; ``chunk`` is for the first, as what follows a window is short."""
    for i, stage in enumerate(stages):
        df = run_stage(df, stage, keys, None if i else chunk)
    return df


def _letter(op: str) -> str:
    """What kind of step an operator is: sums (W), windows that need more (H), sequences (S), nothing (R)."""
    return "R" if op == "RAW" else "H" if op in ("MEDIAN", "SLOPE", "INTERP") else "W" if op in WINDOW_OPS else "S"


def read_specs(specs: DataFrame, last_wins: bool = False) -> DataFrame:
    """Distinct (calculate_type, param) -> those, shape (a letter a stage), ops, args (numbers of each stage).

    A spec that is wrong raises. Few specs become a local table for broadcasts, many stay as they are.
    """
    def work(batches):
        for pdf in batches:
            rows = []
            for kind, param in zip(pdf["calculate_type"], pdf["param"]):
                stages = parse_spec(kind, param, last_wins)
                rows.append((kind, param, "".join(_letter(s.op) for s in stages), [s.op for s in stages], [[float(a) for a in s.args] for s in stages]))
            yield pd.DataFrame(rows, columns=["calculate_type", "param", "shape", "ops", "args"])

    schema = "calculate_type string, param string, shape string, ops array<string>, args array<array<double>>"
    parsed = specs.select("calculate_type", F.coalesce("param", F.lit("")).alias("param")).distinct().mapInPandas(work, schema)
    return at_hand(parsed)


def spec_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(spec, change, reason): the type#param texts that only one of two rule tables has ('added', 'removed').

    ``reason`` says why an added one cannot run; it is null where it can. Rules without a type have no spec.
    """
    spec = F.concat_ws("#", "calculate_type", F.coalesce("param", F.lit("")))
    of = lambda df, name: df.where("calculate_type is not null").select(spec.alias("spec")).distinct().withColumn(name, F.lit(True))
    both = of(before, "_old").join(of(now, "_new"), "spec", "full").where("_old is null or _new is null")

    def checked(batches):
        for pdf in batches:
            why = [None if c == "removed" else _wrong(s) for s, c in zip(pdf["spec"], pdf["change"])]
            yield pdf.assign(reason=pd.Series(why, dtype=object))

    return both.select("spec", F.when(F.col("_new").isNull(), "removed").otherwise("added").alias("change")).mapInPandas(checked, "spec string, change string, reason string")


def _wrong(spec: str) -> str | None:
    try:
        parse_spec(*spec.split("#", 1))
    except ValueError as e:
        return str(e)
    return None


def _shapes(parsed: DataFrame) -> dict[str, list[list[str]]]:
    """Shape -> the operators that its rules have at each stage."""
    rows = parsed.groupBy("shape").agg(F.array_distinct(F.flatten(F.collect_set(F.transform("ops", lambda o, i: F.struct(i.alias("i"), o.alias("o")))))).alias("used")).collect()
    return {r["shape"]: [sorted(x["o"] for x in r["used"] if x["i"] == i) for i in range(len(r["shape"]))] for r in sorted(rows)}


def _branch(records: DataFrame, rules: DataFrame, shape: str, used: list[list[str]], keys: list[str], chunk=None) -> DataFrame:
    """All rules of one shape: (keys, calculate_type, param, ms, seq, value) after every stage; ``chunk`` is for the first."""
    named, own = [*keys, "calculate_type", "param"], ["ms", "seq", "value"]
    df = records.select(*keys, "calculate_type", F.coalesce("param", F.lit("")).alias("param"), "ms", "seq", F.col("value").cast("double").alias("value"))
    joined = False
    for i, letter in enumerate(shape):
        if letter == "R":
            continue
        if not joined:
            df, joined = df.join(rules, ["calculate_type", "param"]), True
        args = F.get("args", F.lit(i))
        rest = [c for c in ("ops", "args") if c in df.columns]
        if letter == "S":
            df = sequenced(df.select(*named, *own, *rest, F.get("ops", F.lit(i)).alias("_op"), args.alias("_args")), named, None if i else chunk).drop("_op", "_args")
        else:
            size, slide = (F.get(args, F.lit(k)).cast("long").alias(n) for k, n in enumerate(("_size", "_slide")))
            df = window_each(df.select(*named, *own, F.get("ops", F.lit(i)).alias("_op"), size, slide), named, used[i])
            df = df.select(*named, F.col("win_end").alias("ms"), F.col("win_start").alias("seq"), "value")
            joined = False
    return df.select(*keys, *own, "calculate_type", "param")


def run_rules(tags: DataFrame, keys: list[str], specs: DataFrame | None = None, last_wins: bool = False) -> DataFrame:
    """Enriched records (calculate_type, param, keys, ms, seq, value) -> results of all rules, in the same columns.

    Rules meet in one branch per shape, which is the kinds of their stages in order (such as a window, then a sequence):
    operators, sizes and arguments are columns, so neither plan nor scans grow with the rules. ``keys`` name a rule's
    series and may hold whatever else belongs to the rule (topic, line, job), as each result carries them. ``specs``
    gives the rules' (calculate_type, param), from the rule table; else they are read off the records. Plugins have
    chains of their own (run_chain).
    """
    parsed = read_specs(tags if specs is None else specs, last_wins)
    out = [_branch(tags.limit(0), parsed, "R", [], keys)]
    for shape, used in _shapes(parsed).items():
        rules = small(parsed.where(F.col("shape") == shape).select("calculate_type", "param", "ops", "args"))
        mine = tags.withColumn("param", F.coalesce("param", F.lit(""))).join(rules.select("calculate_type", "param"), ["calculate_type", "param"], "left_semi")
        out.append(_branch(mine, rules, shape, used, keys))
    return union_all(out)


def _local(spark, rows: list[dict], schema: str) -> DataFrame:
    """A few rows as a local table, whose joins cost no job."""
    from pyspark.sql.pandas.types import to_arrow_schema

    typed = T.StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(typed)), typed)


def calculate(raw: DataFrame, conf: DataFrame, message: list[str], keys: list[str], last_wins: bool = False, span: str = "1 day", late: str = "1 second", chunk=None) -> DataFrame:
    """Raw records (name, topic, ms, seq, value and the columns ``message``) and a rule table -> results of all its rules.

    As ``run_rules``, but each shape's rules meet the raw records by themselves, those that are formulas over one
    message's tags included, so that no record is read for rules of another shape; messages are gathered once for all.
    A small rule table is read once and compiled on the driver. ``chunk`` cuts the series of rules that begin with a
    sequence by time, so that many tasks work on one (see sequences.filtered). A stream of raw records gives a stream of results (see
    ``calculate_stream``).
    """
    if raw.isStreaming:
        return calculate_stream(raw, conf, message, keys, last_wins, span, late)
    known = conf.where("calculate_type is not null").withColumn("param", F.coalesce("param", F.lit("")))
    cols = [*keys, "calculate_type", "param", "ms", "seq", "value"]
    found = known.limit(SMALL + 1).collect()
    out, lists, used_by_formulas = [], None, None
    if len(found) <= SMALL:
        spark, schema = raw.sparkSession, known.schema.toDDL()
        stages = {(r["calculate_type"], r["param"]): parse_spec(r["calculate_type"], r["param"], last_wins) for r in found}
        shaped: dict[str, list] = {}
        for (kind, param), s in sorted(stages.items()):
            shaped.setdefault("".join(_letter(x.op) for x in s), []).append({"calculate_type": kind, "param": param, "ops": [x.op for x in s], "args": [[float(a) for a in x.args] for x in s]})
        by_shape = {k: (_local(spark, v, "calculate_type string, param string, ops array<string>, args array<array<double>>"), [sorted({r["ops"][i] for r in v}) for i in range(len(k))]) for k, v in shaped.items()}
        shape_of = {(r["calculate_type"], r["param"]): k for k, v in shaped.items() for r in v}
        mine = {k: [[r.asDict() for r in found if shape_of[r["calculate_type"], r["param"]] == k and ("[" in (r["tag_name"] or "")) == f] for f in (False, True)] for k in by_shape}
        parts_of = {k: [_local(spark, x, schema) if x else None for x in v] for k, v in mine.items()}
        read = sorted({(r["tag_topic"], t) for r in found if "[" in (r["tag_name"] or "") for t in formula_tags(r["tag_name"])}, key=str)
        used_by_formulas = _local(spark, [{"tag_topic": a, "tag_name": b} for a, b in read], "tag_topic string, tag_name string") if read else None
    else:
        parsed = read_specs(known, last_wins)
        known = known.join(parsed.select("calculate_type", "param", "shape"), ["calculate_type", "param"])
        is_formula = F.col("tag_name").contains("[")
        by_shape = {k: (small(parsed.where(F.col("shape") == k).select("calculate_type", "param", "ops", "args")), used) for k, used in _shapes(parsed).items()}
        parts_of = {k: [known.where((F.col("shape") == k) & f).drop("shape") for f in (~is_formula, is_formula)] for k in by_shape}
    for shape, (rules, used) in by_shape.items():
        single, formula = parts_of[shape]
        parts = []
        if single is not None:
            parts.append(enrich(raw, single).select(*cols))
        if formula is not None:
            lists = messages_of(raw, message, known, used=used_by_formulas) if lists is None else lists
            parts.append(formula_rows(raw, message, formula, lists=lists).select(*cols))
        out.append(_branch(union_all(parts), rules, shape, used, keys, chunk))
    return union_all(out or [enrich(raw, known).select(*cols).limit(0)])


def calculate_stream(raw: DataFrame, conf: DataFrame, message: list[str], keys: list[str], last_wins: bool = False, span: str = "1 day", late: str = "1 second") -> DataFrame:
    """As ``calculate`` for a stream: the results that the watermark, ``late`` behind the newest record, lets be told.

    All chains run in one stateful step (streaming.chains), whose shuffle is the only one of rules that begin with a
    sequence; what begins with a window is summed into panes before, as wide as all such windows allow. A message of
    formulas is what came in one ``span`` of event time. RAW rules over one tag give each record as it comes.
    """
    from ..streaming import chains

    known = at_hand(conf.where("calculate_type is not null").withColumn("param", F.coalesce("param", F.lit(""))))
    specs = {(r[0], r[1]): tuple(s for s in parse_spec(r[0], r[1], last_wins) if s.op != "RAW") for r in collected(known.select("calculate_type", "param").distinct(), "specs of a stream")}
    first = {k: s[0] if s else None for k, s in specs.items()}
    kinds = _local(raw.sparkSession, [{"calculate_type": k, "param": p, "_kind": "R" if s is None else "W" if s.op in WINDOW_OPS else "S", "_whole": s is not None and s.op in ("MEDIAN", "SLOPE")} for (k, p), s in first.items()], "calculate_type string, param string, _kind string, _whole boolean")
    known = known.join(F.broadcast(kinds), ["calculate_type", "param"])
    named = [*keys, "calculate_type", "param"]
    timed = raw.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", late)
    is_formula = F.col("tag_name").contains("[")
    out, rows = [], []

    def marked(df: DataFrame, kind: str) -> DataFrame:
        return df.join(F.broadcast(kinds.where(F.col("_kind") == kind)), ["calculate_type", "param"])

    plain = enrich(timed, known.where(~is_formula).drop("_kind", "_whole"))
    of = {r["_kind"]: r for r in known.groupBy("_kind").agg(F.max(~is_formula).alias("plain"), F.max(is_formula).alias("formula")).collect()}
    cols = [*named, "ms", "seq", "value"]
    if "W" in of and of["W"]["plain"]:
        width = math.gcd(*(a for s in first.values() if s is not None and s.op in WINDOW_OPS for a in s.args))
        rows.append(chains.panes(marked(plain, "W"), named, width, F.col("_whole")))
    if "S" in of and of["S"]["plain"]:
        rows.append(chains.singles(marked(plain, "S"), named))
    if "R" in of and of["R"]["plain"]:
        out.append(marked(plain, "R").select(*cols))
    if any(r["formula"] for r in of.values()):  # one aggregation for all formulas; those without a chain go through as they are
        found = formula_rows(timed, message, known.where(is_formula).drop("_kind", "_whole"), span)
        rows.append(chains.singles(found, named, parse_duration(_short(span))))
    if rows:
        out.insert(0, chains.run_chains(union_all(rows), named, chains.spec_of(named, last_wins)).select(*cols))
    return union_all([o.select(*keys, "ms", "seq", F.col("value").cast("double").alias("value"), "calculate_type", "param") for o in out])


def _short(span: str) -> str:
    """'1 day' as '1d'."""
    count, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", span).groups()
    return f"{count}{'ms' if unit.startswith('milli') else unit[0]}"


def results(found: DataFrame) -> DataFrame:
    """The columns of a result table, from run_rules with the keys out_name, tag_topic, task_name and line_id."""
    return found.select("out_name", "tag_topic", "value", F.timestamp_millis("ms").alias("calculate_time"), "calculate_type", F.col("param").alias("calculate_params"), F.col("task_name").alias("job_name"), "line_id")


def check_cycles(conf_rows) -> list[str]:
    """out_names in an order in which each rule comes after those it reads; ValueError if rules read each other."""
    from graphlib import CycleError, TopologicalSorter

    from ..functions.formula import is_formula

    rows = list(conf_rows)
    names = {r["out_name"] for r in rows}
    graph = {r["out_name"]: {t for t in (formula_tags(r["tag_name"]) if is_formula(r["tag_name"]) else [r["tag_name"]]) if t in names} for r in rows}
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as e:
        raise ValueError(f"rules read each other: {e.args[1]}") from e
