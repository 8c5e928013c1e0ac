"""Every registered query of the engine over the test tables, and the SQL that says the same.

``events`` is the stream of records: a series per event_type, or per (event_type, user_id) where each record depends on
the one before without end; a message is what one user sends in one hour.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.times import millis, round_half_up, time_text, wire_time
from .operators import changes, enrich, pattern, route, sequences, windows
from .plans import compiler
from .plans.compiler import calculate, results, run_chain, run_rules
from .plans.spec import WINDOW_OPS, parse_spec
from .sources import connectors, messages
from .streaming import operators as streams

HOUR = 3_600_000
DAY = 24 * HOUR


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_type, user_id, ms, seq, value of ``events``."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_type", "user_id", millis(F.col("ts")).alias("ms"), F.col("event_id").alias("seq"), "value")


T = "t AS (SELECT event_type, user_id, epoch_us(ts) // 1000 AS ms, event_id AS seq, value, CAST(value AS DECIMAL(19,9)) AS d FROM events)"


def r4(x: str, places: int = 4) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {places}) AS DOUBLE)"


# ---- windows --------------------------------------------------------------------------------------------------------


def _window_sql(op: str, size: str, slide: str, start: str | None = None) -> str:
    starts = start or (f"ms - ms % {slide}" if size == slide else f"unnest(range(ms - ms % {slide}, ms - {size}, -{slide}))")
    mean = r4("s / n")
    var = r4(f"greatest((q - 2 * {mean} * s + n * {mean} * {mean}) / n, 0.0)")
    form = {
        "AVG": mean, "SUM": "s", "MAX": "hi", "MIN": "lo", "RANGE": r4("hi - lo"), "MEDIAN": r4("med"), "VARIANCE": var, "STD": r4(f"sqrt({var})"),
        "CV": r4(f"sqrt({var}) / nullif({mean}, 0)"), "PSEQ": "CASE WHEN lo >= 0 THEN 1.0 ELSE 0.0 END", "INTERP": "late",
        "SLOPE": r4("(n * xy - n * (n + 1) / 2 * s) / nullif(n * (n * (n + 1) * (2 * n + 1) / 6) - n * (n + 1) / 2 * (n * (n + 1) / 2), 0)"),
    }[op]
    return f"""WITH {T}, x AS (SELECT *, {starts} AS win_start FROM t),
w AS (SELECT *, row_number() OVER (PARTITION BY event_type, win_start ORDER BY ms, seq) AS rn FROM x),
a AS (SELECT event_type, win_start, CAST(count(*) AS DOUBLE) AS n, CAST(sum(d) AS DOUBLE) AS s, CAST(sum(CAST(value * value AS DECIMAL(38,8))) AS DOUBLE) AS q, min(value) AS lo, max(value) AS hi,
 arg_max(value, (ms, seq)) AS late, median(value) AS med, CAST(sum(rn * d) AS DOUBLE) AS xy FROM w GROUP BY event_type, win_start)
SELECT event_type, win_start, win_start + {size} AS win_end, CAST({form} AS DOUBLE) AS value FROM a"""


def _window(op: str, size: str, slide: str):
    return lambda spark, sf: windows.window_aggregate(tags(spark, sf), {"value": op}, ["event_type"], size, slide)


def win_all_tumbling(spark, sf):
    """All window operators of one size in one aggregation."""
    return windows.window_aggregate(tags(spark, sf), {op.lower(): op for op in WINDOW_OPS}, ["event_type"], "1h", "1h")


SIZE_BY_TYPE = "CASE event_type WHEN 'click' THEN 7200000 WHEN 'view' THEN 3600000 ELSE 0 END"


def dynwin_sum(spark, sf):
    """Size and slide of each record's own; 0 means the default, here 2h,1h."""
    size = F.expr(SIZE_BY_TYPE).cast("long")
    slide = F.when(F.col("event_type") == "click", 5400000).otherwise(0).cast("long")
    return windows.window_aggregate(tags(spark, sf), {"value": "SUM"}, ["event_type"], size, slide, default=("2h", "1h"))


DYNWIN_SQL = f"""WITH {T}, p AS (SELECT *, CASE WHEN {SIZE_BY_TYPE} > 0 THEN {SIZE_BY_TYPE} ELSE 7200000 END AS size, CASE WHEN event_type = 'click' THEN 5400000 ELSE 3600000 END AS slide FROM t),
x AS (SELECT *, unnest(range(ms - ms % slide, ms - size, -slide)) AS win_start FROM p)
SELECT event_type, win_start, win_start + size AS win_end, CAST(sum(d) AS DOUBLE) AS value FROM x GROUP BY event_type, win_start, size"""


def win_null_key(spark, sf):
    """Windows of a series whose name is null, beside those of others; SLOPE and MEDIAN over the same windows as SUM."""
    t = tags(spark, sf).withColumn("event_type", F.when(F.col("event_type") != "view", F.col("event_type")))
    return windows.window_aggregate(t, {"sum": "SUM", "median": "MEDIAN", "slope": "SLOPE"}, ["event_type"], "2h", "1h")


NULL_KEY_SQL = f"""WITH {T}, x AS (SELECT nullif(event_type, 'view') AS event_type, ms, seq, value, d, unnest(range(ms - ms % 3600000, ms - 7200000, -3600000)) AS win_start FROM t),
w AS (SELECT *, row_number() OVER (PARTITION BY event_type, win_start ORDER BY ms, seq) AS rn FROM x)
SELECT event_type, win_start, win_start + 7200000 AS win_end, CAST(sum(d) AS DOUBLE) AS sum, {r4("median(value)")} AS median, {r4("nullif(regr_slope(value, rn), 'nan'::DOUBLE)")} AS slope FROM w GROUP BY event_type, win_start"""


def win_carry(spark, sf):
    """A window's result with columns of its earliest record."""
    return windows.window_aggregate(tags(spark, sf), {"avg": "AVG", "slope": "SLOPE"}, ["event_type"], "2h", "30m", carry=["user_id", "value"])


CARRY_SQL = f"""WITH {T}, x AS (SELECT *, unnest(range(ms - ms % 1800000, ms - 7200000, -1800000)) AS win_start FROM t),
w AS (SELECT *, row_number() OVER (PARTITION BY event_type, win_start ORDER BY ms, seq) AS rn FROM x)
SELECT event_type, win_start, win_start + 7200000 AS win_end, {r4("CAST(sum(d) AS DOUBLE) / count(*)")} AS avg, {r4("nullif(regr_slope(value, rn), 'nan'::DOUBLE)")} AS slope, arg_min(user_id, (ms, seq)) AS user_id, arg_min(value, (ms, seq)) AS value FROM w GROUP BY event_type, win_start"""


CARRIED = {"max": "MAX", "min": "MIN", "median": "MEDIAN", "interp": "INTERP", "sum": "SUM"}


def win_carry_each(spark, sf):
    """Each operator's result with columns of the record that it is about; users repeat whole values."""
    t = tags(spark, sf).withColumn("value", F.floor(F.col("value") / 40) * 40.0)
    return windows.window_aggregate(t, CARRIED, ["event_type"], "6h", "2h", carry_each=["user_id", "seq"])


_CARRIER = {"MAX": "arg_max({c}, (value, ms, seq))", "MEDIAN": "arg_max({c}, (value, ms, seq))", "MIN": "arg_max({c}, (-value, ms, seq))", "INTERP": "arg_max({c}, (ms, seq))", "SUM": "arg_min({c}, (ms, seq))"}
CARRY_EACH_SQL = f"""WITH {T}, f AS (SELECT event_type, user_id, ms, seq, floor(value / 40) * 40.0::DOUBLE AS value FROM t), x AS (SELECT *, unnest(range(ms - ms % 7200000, ms - 21600000, -7200000)) AS win_start FROM f)
SELECT event_type, win_start, win_start + 21600000 AS win_end, max(value) AS max, min(value) AS min, {r4("median(value)")} AS median, arg_max(value, (ms, seq)) AS interp, CAST(sum(CAST(value AS DECIMAL(19,9))) AS DOUBLE) AS sum,
 {", ".join(f"{_CARRIER[op].format(c=c)} AS {k}_{c}" for k, op in CARRIED.items() for c in ("user_id", "seq"))} FROM x GROUP BY event_type, win_start"""


def win_gap_offset(spark, sf):
    """A slide above the size leaves gaps; windows start 10 minutes past its multiples."""
    return windows.window_aggregate(tags(spark, sf), {"value": "SUM"}, ["event_type"], F.lit(HOUR).cast("long"), F.lit(2 * HOUR).cast("long"), offset="10m")


GAP_SQL = f"""WITH {T}, x AS (SELECT *, ms - (ms - 600000) % 7200000 AS win_start FROM t)
SELECT event_type, win_start, win_start + 3600000 AS win_end, CAST(sum(d) AS DOUBLE) AS value FROM x WHERE ms < win_start + 3600000 GROUP BY event_type, win_start"""


def win_integer_order(spark, sf):
    """MAX, MIN and RANGE by integer part, ties to the later record."""
    return windows.integer_order(tags(spark, sf), ["event_type"], "1h", "1h")


INTEGER_SQL = f"""WITH {T}, x AS (SELECT *, CAST(trunc(value) AS BIGINT) AS v, ms - ms % 3600000 AS win_start FROM t)
SELECT event_type, win_start, win_start + 3600000 AS win_end, arg_max(value, (v, seq)) AS max_int, arg_max(value, (-v, seq)) AS min_int,
 {r4("arg_max(value, (v, seq)) - arg_min(value, (v, seq))")} AS range_int FROM x GROUP BY event_type, win_start"""

# ---- sequences ------------------------------------------------------------------------------------------------------

ORDER = "PARTITION BY event_type ORDER BY ms, seq"
OUT = ["event_type", "ms", "seq", "value"]


#: Long series are cut by the day, so that more than one task works on each.
CHUNK = "1d"


def _lag(op: str, n: int):
    def run(spark, sf):
        t = tags(spark, sf)
        return sequences.lag_stage(t, op, n, ["event_type"], chunk=sequences.cut_if_long(t, CHUNK) if op == "LAST" else CHUNK).select(*OUT)

    return run


def _lag_sql(op: str, n: int) -> str:
    form = {"LAST": "o", "VAR": r4("value - o"), "TREND": r4("value / nullif(o, 0)")}[op]
    return f"WITH {T}, x AS (SELECT *, lag(value, {n}) OVER ({ORDER}) AS o, row_number() OVER ({ORDER}) AS rn FROM t) SELECT event_type, ms, seq, CAST({form} AS DOUBLE) AS value FROM x WHERE rn > {n}"


def last_changing(spark, sf):
    """The lag's n changes every day; each change starts anew."""
    n = F.floor(F.col("ms") / DAY) % 2
    return sequences.lag_stage(tags(spark, sf), "LAST", 2, ["event_type"], changing=n, chunk=CHUNK).select(*OUT)


LAST_CHANGING_SQL = f"""WITH {T}, x AS (SELECT *, (ms // {DAY}) % 2 AS n FROM t), y AS (SELECT *, CAST(n <> lag(n) OVER ({ORDER}) AS INT) AS c FROM x),
z AS (SELECT *, sum(coalesce(c, 0)) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS e FROM y),
l AS (SELECT *, lag(value, 2) OVER (PARTITION BY event_type, e ORDER BY ms, seq) AS o, row_number() OVER (PARTITION BY event_type, e ORDER BY ms, seq) AS rn FROM z)
SELECT event_type, ms, seq, o AS value FROM l WHERE rn > 2"""


def lag_fused(spark, sf):
    """LAST, VAR and TREND of one n share one sort."""
    ops = {"last": ("LAST", 3), "var": ("VAR", 3), "trend": ("TREND", 3)}
    t = tags(spark, sf)
    return sequences.lagged(t, ops, ["event_type"], sequences.cut_if_long(t, CHUNK)).select("event_type", "ms", "seq", *ops)


LAG_FUSED_SQL = f"""WITH {T}, x AS (SELECT *, lag(value, 3) OVER ({ORDER}) AS o FROM t)
SELECT event_type, ms, seq, o AS last, {r4("value - o")} AS var, {r4("value / nullif(o, 0)")} AS trend FROM x"""


def rsi(spark, sf):
    return sequences.rsi(tags(spark, sf), 14, ["event_type"], CHUNK).select(*OUT)


RSI_SQL = f"""WITH {T}, x AS (SELECT *, coalesce(d - lag(d) OVER ({ORDER}), 0) AS c, row_number() OVER ({ORDER}) AS rn FROM t),
y AS (SELECT *, CAST(sum(greatest(c, 0)) OVER w AS DOUBLE) AS g, CAST(sum(greatest(-c, 0)) OVER w AS DOUBLE) AS l FROM x WINDOW w AS ({ORDER} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT event_type, ms, seq, {r4("CASE WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0 END ELSE 100 - 100 / (1 + g / l) END")} AS value FROM y WHERE rn >= 14"""

FILTER_ARGS = {"FOF": (0.3,), "EMA": (5,), "DIF": (3, 6), "DEJUMP": (-50.0, 50.0), "KF": (1.0, 0.5)}
PAIR = ["event_type", "user_id"]


def _filter(op: str, chunk: str | None = None):
    def run(spark, sf):
        out = sequences.filtered(tags(spark, sf), {"_out": (op, *FILTER_ARGS[op])}, PAIR, chunk)
        return out.select(*PAIR, "ms", "seq", round_half_up(F.col("_out")).alias("value"))

    return run


def filters_fused(spark, sf):
    """All recursive filters in one pass over each series."""
    ops = {op.lower(): (op, *a) for op, a in FILTER_ARGS.items()}
    return sequences.filtered(tags(spark, sf), ops, PAIR).select(*PAIR, "ms", "seq", *(round_half_up(F.col(k)).alias(k) for k in ops))


def filters_chunked(spark, sf):
    """All recursive filters over series that are cut by the day: a day's state before its first record is found first."""
    ops = {op.lower(): (op, *a) for op, a in FILTER_ARGS.items()}
    return sequences.filtered(tags(spark, sf), ops, PAIR, CHUNK).select(*PAIR, "ms", "seq", *(round_half_up(F.col(k)).alias(k) for k in ops))


_ROWS = f"{T}, s AS (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ms, seq) AS rn FROM t)"


def _recursive(first: str, step: str, cols: str, out: str) -> str:
    return f"""WITH RECURSIVE {_ROWS}, r AS (SELECT event_type, user_id, ms, seq, rn, {first} FROM s WHERE rn = 1
UNION ALL SELECT s.event_type, s.user_id, s.ms, s.seq, s.rn, {step} FROM r JOIN s ON s.event_type = r.event_type AND s.user_id = r.user_id AND s.rn = r.rn + 1)
SELECT event_type, user_id, ms, seq, {out} FROM r"""


FILTER_SQL = {
    "FOF": _recursive("value AS y", "0.3::DOUBLE * s.value + (1 - 0.3::DOUBLE) * r.y", "y", f"{r4('y')} AS value"),
    "EMA": _recursive("value AS y", "(2 * s.value + 4 * r.y) / 6", "y", f"{r4('y')} AS value"),
    "DIF": _recursive("value AS y, value AS z", "(2 * s.value + 2 * r.y) / 4, (2 * s.value + 5 * r.z) / 7", "y, z", f"{r4('y - z')} AS value"),
    "DEJUMP": _recursive("value AS y", "CASE WHEN s.value - r.y BETWEEN -50 AND 50 THEN s.value ELSE r.y END", "y", f"{r4('y')} AS value"),
    # p, v and the covariance a, b, c are those foreseen for the row; z is what the row then brings
    "KF": _recursive(
        "value AS z, value AS p, 0.0::DOUBLE AS v, 2.05::DOUBLE AS a, 1.05::DOUBLE AS b, 1.05::DOUBLE AS c",
        "s.value, (r.p + r.a / (r.a + 0.5) * (r.z - r.p)) + (r.v + r.b / (r.a + 0.5) * (r.z - r.p)), r.v + r.b / (r.a + 0.5) * (r.z - r.p), "
        "(r.a - r.a / (r.a + 0.5) * r.a) + 2 * (r.b - r.a / (r.a + 0.5) * r.b) + (r.c - r.b / (r.a + 0.5) * r.b) + 0.05::DOUBLE, "
        "(r.b - r.a / (r.a + 0.5) * r.b) + (r.c - r.b / (r.a + 0.5) * r.b) + 0.05::DOUBLE, (r.c - r.b / (r.a + 0.5) * r.b) + 0.05::DOUBLE",
        "z, p, v, a, b, c", f"{r4('p')} AS value",
    ),
}

# ---- rules, routing, changes ----------------------------------------------------------------------------------------

# (id, line_id, tag_name, out_name, tag_topic, calculate_type, task_name, param, status)
RULES = [
    (1, 1, "click", "click_avg", "opc", "AVG", "job1", "1h,1h", 1),
    (2, 1, "click", "click_max", "opc", "MAX", "job1", "1h,1h", 1),
    (3, 1, "view", "view_dif", "opc", "AVG_VAR", "job1", "1h,1h|1", 1),
    (4, 2, "purchase", "purchase_$", "opc", "LAST", "job2", "2", 1),
    (5, 2, "signup", "signup_kf", "opc", "DEJUMP_FOF_AVG", "job2", "-50,50|0.3|1h,1h", 0),
    (6, 2, "[click] / ([view] + [purchase])", "ratio", "opc", "RAW", "job2", "", 1),
    (7, 2, "([click] > [view]) ? 1 : 0", "busy", "opc", "RAW", "job2", "", 1),
    (8, 1, "click", "other_topic", "sdk", "AVG", "job1", "1h,1h", 1),
    (9, 1, "click", "untyped", "opc", None, "job1", "1m,1m", 1),
    (10, 1, "[click] - [view]", "lead_avg", "opc", "AVG", "job1", "1d,1d", 1),
    (11, 1, "view", "view_mid", "opc", "MEDIAN", "job1", "2h,1h", 1),
    (12, 2, "purchase", "smooth", "opc", "FOF", "job2", "0.3", 1),
]
RULE_COLS = "id int, line_id int, tag_name string, out_name string, tag_topic string, calculate_type string, task_name string, param string, status int"
_NAMES = ", ".join(c.split()[0] for c in RULE_COLS.split(", "))


def _literal(x) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


CONF = f"conf({_NAMES}) AS (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in RULES)})"
POSTS = [("hourly", "click, view ,purchase", "http://a"), ("pair", "signup,error", "http://b")]
POST = f"post(post_name, post_keys, post_url) AS (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in POSTS)})"


def conf(spark) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_COLS)


def posts(spark) -> DataFrame:
    return spark.createDataFrame(POSTS, "post_name string, post_keys string, post_url string")


def raw(spark, sf) -> DataFrame:
    return tags(spark, sf).withColumnRenamed("event_type", "name").withColumn("topic", F.lit("opc"))


def enriched(spark, sf):
    return enrich.online(enrich.enrich(raw(spark, sf), conf(spark))).select("out_name", "calculate_type", "param", "task_name", "line_id", "ms", "seq", "value")


ENRICH = f"e AS (SELECT c.out_name, c.calculate_type, c.param, c.task_name, c.line_id, t.ms, t.seq, t.value, t.d FROM t JOIN conf c ON t.event_type = c.tag_name AND c.tag_topic = 'opc' WHERE c.calculate_type IS NOT NULL AND c.status = 1)"
ENRICH_SQL = f"WITH {T}, {CONF}, {ENRICH} SELECT out_name, calculate_type, param, task_name, line_id, ms, seq, value FROM e"


def _versions(spark, sf) -> DataFrame:
    """A rule per type and kind of user, changed or deleted by every 20th event of either: a log of versions."""
    t = tags(spark, sf).where(F.col("seq") % 20 == 0)
    op = F.when(F.col("seq") % 60 == 0, "d").otherwise("u")
    kind = F.concat("event_type", F.lit("_"), (F.col("user_id") % 2).cast("string"))
    return t.select(F.col("event_type").alias("tag_name"), F.lit("opc").alias("tag_topic"), kind.alias("out_name"), F.lit("LAST").alias("calculate_type"), F.col("seq").cast("string").alias("param"),
                    F.lit("job1").alias("task_name"), F.lit(1).alias("line_id"), F.lit(1).alias("status"), op.alias("op"), F.col("ms").alias("ts_ms"), F.col("seq").alias("pos"))


def _as_of(most: int):
    def run(spark, sf):
        found = changes.enrich_as_of(raw(spark, sf), changes.intervals(_versions(spark, sf), ["out_name"]), most=most)
        return found.select("name", "ms", "seq", "value", "out_name", "param")

    return run


AS_OF_SQL = f"""WITH {T}, c AS (SELECT event_type, event_type || '_' || (user_id % 2) AS out_name, seq, ms FROM t WHERE seq % 20 = 0),
v AS (SELECT *, lead(ms) OVER (PARTITION BY out_name ORDER BY ms, seq) AS until FROM c)
SELECT t.event_type AS name, t.ms, t.seq, t.value, v.out_name, CAST(v.seq AS VARCHAR) AS param FROM t JOIN v ON t.event_type = v.event_type AND t.ms >= v.ms AND (until IS NULL OR t.ms < until) WHERE v.seq % 60 <> 0"""


def spec_changes(spark, sf):
    """The specs that came and went between two times of the log of rule versions, with what is wrong with the new ones."""
    log = _versions(spark, sf).withColumn("calculate_type", F.when(F.col("pos") % 40 == 0, "LOST").otherwise(F.col("calculate_type")))
    versions = changes.intervals(log, ["out_name"])
    at = lambda ms: versions.where((F.col("valid_from") <= ms) & F.coalesce(F.col("valid_to") > ms, F.lit(True)))
    return compiler.spec_changes(at(F.lit(SPEC_TIMES[0])), at(F.lit(SPEC_TIMES[1])))


SPEC_TIMES = (1_705_276_800_000, 1_706_140_800_000)
SPEC_CHANGES_SQL = f"""WITH {T}, c AS (SELECT event_type || '_' || (user_id % 2) AS out_name, seq, ms, CASE WHEN seq % 40 = 0 THEN 'LOST' ELSE 'LAST' END || '#' || seq AS spec FROM t WHERE seq % 20 = 0),
v AS (SELECT *, lead(ms) OVER (PARTITION BY out_name ORDER BY ms, seq) AS until FROM c),
o AS (SELECT spec FROM v WHERE seq % 60 <> 0 AND ms <= {SPEC_TIMES[0]} AND (until IS NULL OR until > {SPEC_TIMES[0]})), n AS (SELECT spec FROM v WHERE seq % 60 <> 0 AND ms <= {SPEC_TIMES[1]} AND (until IS NULL OR until > {SPEC_TIMES[1]}))
SELECT spec, 'removed' AS change, NULL AS reason FROM o WHERE spec NOT IN (SELECT spec FROM n) UNION ALL SELECT spec, 'added', CASE WHEN spec LIKE 'LOST%' THEN {_literal("no operator 'LOST'")} END FROM n WHERE spec NOT IN (SELECT spec FROM o)"""


def tag_semi_filter(spark, sf):
    return enrich.keep_used(raw(spark, sf), conf(spark)).select("name", "ms", "seq", "value")


SEMI_SQL = f"WITH {T} SELECT event_type AS name, ms, seq, value FROM t WHERE event_type IN ('click', 'view', 'purchase', 'signup')"


def formula(spark, sf):
    r = raw(spark, sf).withColumn("day", F.floor(F.col("ms") / DAY).cast("long"))
    return enrich.formula_values(r, ["user_id", "day"], enrich.formulas_of(conf(spark))).withColumn("value", round_half_up(F.col("value")))


_MESSAGES = """m AS (SELECT user_id, ms // 86400000 AS day, arg_max(value, seq) FILTER (event_type = 'click') AS c, arg_max(ms, seq) FILTER (event_type = 'click') AS ms, arg_max(seq, seq) FILTER (event_type = 'click') AS seq,
 coalesce(arg_max(value, seq) FILTER (event_type = 'view'), 0) AS v, coalesce(arg_max(value, seq) FILTER (event_type = 'purchase'), 0) AS p FROM t GROUP BY ALL)"""
_RATIO, _BUSY = r4("coalesce(c / nullif(v + p, 0), 0)"), "CASE WHEN c > v THEN 1.0 ELSE 0.0 END"
FORMULA_SQL = f"""WITH {T}, {_MESSAGES}
SELECT user_id, day, 'ratio' AS out_name, ms, {_RATIO} AS value FROM m WHERE c IS NOT NULL
UNION ALL SELECT user_id, day, 'busy', ms, {_BUSY} FROM m WHERE c IS NOT NULL
UNION ALL SELECT user_id, day, 'lead_avg', ms, {r4("c - v")} FROM m WHERE c IS NOT NULL"""


def formula_rows(spark, sf):
    """The same formulas as rows that meet their operands, as rules of any number do."""
    r = raw(spark, sf).withColumn("day", F.floor(F.col("ms") / DAY).cast("long"))
    return enrich.formula_rows(r, ["user_id", "day"], conf(spark)).select("user_id", "day", "out_name", "ms", round_half_up(F.col("value")).alias("value"))


def flatten_normal(spark, sf):
    """Lists of records (a user's of one day) to one JSON text per normal record."""
    t = tags(spark, sf).withColumn("is_normal", F.when(F.col("seq") % 3 == 0, F.lit(0)).when(F.col("seq") % 3 == 1, F.lit(1)))
    lists = t.groupBy("user_id", F.floor(F.col("ms") / DAY).alias("day")).agg(F.collect_list(F.struct("event_type", "seq", "is_normal")).alias("records"))
    return enrich.flatten_normal(lists)


FLATTEN_SQL = f"""WITH {T} SELECT '{{"event_type":"' || event_type || '","seq":' || seq || CASE WHEN seq % 3 = 1 THEN ',"is_normal":1' ELSE '' END || '}}' AS value FROM t WHERE seq % 3 <> 0"""


def normal_job(spark, sf):
    e = enriched(spark, sf).withColumn("is_normal", F.when(F.col("seq") % 3 == 0, F.lit(0)).when(F.col("seq") % 3 == 1, F.lit(1)))
    return enrich.normal_and_job(e, ["job1"]).select("out_name", "seq", "value")


NORMAL_SQL = f"WITH {T}, {CONF}, {ENRICH} SELECT out_name, seq, value FROM e WHERE seq % 3 <> 0 AND task_name = 'job1'"


def parse_params(spark, sf):
    """Every enriched record with the length of its chain and the first operator's arguments."""
    return route.parse_params(enriched(spark, sf)).select("out_name", "seq", F.col("total_index").cast("long").alias("total_index"), "first_op", "first_args")


PARSE_SQL = f"WITH {T}, {CONF}, {ENRICH} SELECT out_name, seq, CAST(len(string_split(calculate_type, '_')) AS BIGINT) AS total_index, string_split(calculate_type, '_')[1] AS first_op, string_split(param, '|')[1] AS first_args FROM e"


def route_union(spark, sf):
    """Branches by current operator, each advanced, and joined again."""
    e = route.parse_params(enriched(spark, sf)).withColumnRenamed("first_op", "curr_cal").withColumn("curr_index", F.lit(0))
    branches = route.route(e, ["AVG", "MAX", "LAST", "MEDIAN", "FOF"])
    return route.union_all([route.advance(b) for b in branches.values()]).select("out_name", "seq", "value", "calculate_type", "curr_cal", "curr_index")


ROUTE_SQL = f"""WITH {T}, {CONF}, {ENRICH} SELECT out_name, seq, value, calculate_type, coalesce(string_split(calculate_type, '_')[2], 'over') AS curr_cal, 1 AS curr_index FROM e"""


def operands(spark, sf):
    """The arguments of the first and the last operator of each enriched record's chain, each in a column of its own."""
    c = enriched(spark, sf).withColumn("last", F.size(F.split("calculate_type", "_")) - 1)
    both = route.operands(c, 0).withColumn("place", F.lit(0)).unionByName(route.operands(c, F.col("last")).withColumn("place", F.col("last")))
    return both.select("out_name", "seq", "place", "curr_cal", *route.OPERANDS)


_AT = "string_split(string_split(param, '|')[place + 1], ',')"
_DUR = "CAST(regexp_extract({x}, '^([0-9]+)', 1) AS BIGINT) * CASE regexp_extract({x}, '([a-z]+)$', 1) WHEN 's' THEN 1000 WHEN 'm' THEN 60000 WHEN 'h' THEN 3600000 WHEN 'd' THEN 86400000 END"
_WIN = "curr_cal IN (" + ", ".join(f"'{o}'" for o in WINDOW_OPS) + ")"
OPERANDS_SQL = f"""WITH {T}, {CONF}, {ENRICH}, p AS (SELECT out_name, seq, calculate_type, param, unnest([0, len(string_split(calculate_type, '_')) - 1]) AS place FROM e),
q AS (SELECT out_name, seq, CAST(place AS INT) AS place, string_split(calculate_type, '_')[place + 1] AS curr_cal, {_AT} AS a FROM p)
SELECT out_name, seq, place, curr_cal, CASE WHEN {_WIN} THEN {_DUR.format(x="a[1]")} END AS win_size, CASE WHEN {_WIN} THEN {_DUR.format(x="a[2]")} END AS win_slide,
 CASE WHEN curr_cal IN ('LAST', 'VAR', 'TREND', 'EMA', 'RSI') THEN CAST(a[1] AS BIGINT) END AS n, CASE WHEN curr_cal = 'FOF' THEN CAST(a[1] AS DOUBLE) END AS a,
 CASE WHEN curr_cal = 'DEJUMP' THEN CAST(a[1] AS DOUBLE) END AS lower, CASE WHEN curr_cal = 'DEJUMP' THEN CAST(a[2] AS DOUBLE) END AS upper,
 CASE WHEN curr_cal = 'KF' THEN CAST(a[1] AS DOUBLE) END AS dt, CASE WHEN curr_cal = 'KF' THEN CAST(a[2] AS DOUBLE) END AS r,
 CASE WHEN curr_cal = 'DIF' THEN CAST(a[1] AS BIGINT) END AS fast, CASE WHEN curr_cal = 'DIF' THEN CAST(a[2] AS BIGINT) END AS slow FROM q"""


SPECS = sorted({f"{r[5]}#{r[7]}" for r in RULES if r[5] and r[7]})
_SPEC_LIST = ", ".join(map(_literal, SPECS))


def route_by_spec(spark, sf):
    """Branches by type and parameters together."""
    found = route.route_by_spec(enriched(spark, sf), [*SPECS, "MAX#5m,5m"])
    return route.union_all([b.select(F.lit(s).alias("spec"), "out_name", "seq", "value") for s, b in found.items()])


BY_SPEC_SQL = f"WITH {T}, {CONF}, {ENRICH} SELECT calculate_type || '#' || param AS spec, out_name, seq, value FROM e WHERE calculate_type || '#' || param IN ({_SPEC_LIST})"


def grade_split(spark, sf):
    g = route.grade(F.col("out_name"), F.col("param"))
    return enriched(spark, sf).groupBy("out_name", g.alias("grade")).agg(F.count("*").alias("n"), F.max("seq").alias("last_seq"))


GRADE_SQL = f"WITH {T}, {CONF}, {ENRICH} SELECT out_name, CASE WHEN out_name LIKE '%\\_$' ESCAPE '\\' THEN 'pre' WHEN contains(param, 's') THEN 'second' ELSE 'minute' END AS grade, count(*) AS n, max(seq) AS last_seq FROM e GROUP BY 1, 2"


def post_fanout(spark, sf):
    r = tags(spark, sf).withColumnRenamed("event_type", "out_name")
    return route.fan_out(r, posts(spark)).select("post_name", "out_name", "seq", "value")


KEYS = f"{POST}, k AS (SELECT post_name, unnest(string_split(replace(post_keys, ' ', ''), ',')) AS key FROM post)"
FANOUT_SQL = f"WITH {T}, {KEYS} SELECT post_name, event_type AS out_name, seq, value FROM t JOIN k ON event_type = key"


def _hourly(spark, sf):
    return tags(spark, sf).withColumnRenamed("event_type", "out_name").withColumn("ms", F.col("ms") - F.pmod("ms", F.lit(HOUR)))


def post_assemble(spark, sf):
    """A row per post and hour in which all its keys have a value: the hour's last."""
    v = lambda k: F.element_at("values", k).alias(k)
    return route.assemble(_hourly(spark, sf), posts(spark)).select("post_name", "ms", v("click"), v("view"), v("purchase"), v("signup"), v("error"))


_HOURS = f"{T}, h AS (SELECT event_type, ms - ms % 3600000 AS ms, arg_max(value, seq) AS value FROM t GROUP BY 1, 2)"
_IF = lambda keys: ", ".join(f"max(value) FILTER (event_type = '{k}' AND '{k}' IN ({keys})) AS {k}" for k in ("click", "view", "purchase", "signup", "error"))
ASSEMBLE_SQL = f"""WITH {_HOURS} SELECT 'hourly' AS post_name, ms, {_IF("'click', 'view', 'purchase'")} FROM h WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ms HAVING count(*) = 3
UNION ALL SELECT 'pair', ms, {_IF("'signup', 'error'")} FROM h WHERE event_type IN ('signup', 'error') GROUP BY ms HAVING count(*) = 2"""


def post_requests(spark, sf):
    """What is posted where: assembled rows as (url, body)."""
    return route.post_requests(route.assemble(_hourly(spark, sf), posts(spark)), posts(spark))


_BODY = lambda *keys: "'{' || " + " || ',' || ".join(f"""'"{k}":"' || CAST(max(value) FILTER (event_type = '{k}') AS VARCHAR) || '"'""" for k in keys) + """ || ',"create_time":"' || strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') || '"}'"""
REQUESTS_SQL = f"""WITH {_HOURS} SELECT 'http://a' AS url, {_BODY('click', 'purchase', 'view')} AS body FROM h WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ms HAVING count(*) = 3
UNION ALL SELECT 'http://b', {_BODY('error', 'signup')} FROM h WHERE event_type IN ('signup', 'error') GROUP BY ms HAVING count(*) = 2"""


def feedback(spark, sf):
    """Results that go back as raw tags: grouped by hour, packed as messages, and read again."""
    r = _hourly(spark, sf).groupBy("ms", "out_name").agg(F.max_by("value", "seq").cast("decimal(18,4)").alias("value")).withColumn("out_name", F.concat("out_name", F.when(F.col("out_name") != "view", F.lit("_$")).otherwise(F.lit(""))))
    groups = route.feedback(r).withColumn("time", F.regexp_replace(time_text(F.col("ms")), "[^0-9]", ""))
    packed = messages.encode_protobuf(groups, topic="tags_pre")
    back = messages.decode_protobuf(packed, keep=["topic"])
    return messages.clean_tags(back).select("topic", "name", "ms", F.col("value").cast("double").alias("value"))


FEEDBACK_SQL = f"WITH {_HOURS} SELECT 'tags_pre' AS topic, event_type || '_$' AS name, ms, value FROM h WHERE event_type <> 'view'"


def json_topics(spark, sf):
    """Records as JSON messages with a topic of their own each, and each topic read back; texts that are no record go."""
    t = tags(spark, sf).select(F.col("event_type").alias("name"), time_text(F.col("ms")).alias("time"), F.col("value").cast("decimal(38,4)").alias("value"), (F.col("seq") % 4).cast("int").alias("line_id"))
    sent = messages.encode_json(t, topic=F.concat(F.lit("dwd-"), F.col("line_id")), key=F.col("name"))
    broken = spark.createDataFrame([("{broken", "dwd-1", "x"), (None, "dwd-1", "y"), ("{}", "dwd-1", "z")], "value string, topic string, key string")
    every = sent.unionByName(broken)
    topics = [f"dwd-{k}" for k in range(4)]
    got = route.union_all([messages.decode_json(every.where(F.col("topic") == k).select("value")).withColumn("topic", F.lit(k)) for k in topics])
    return got.select("topic", "name", "time", F.col("value").cast("double").alias("value"), "line_id")


TOPICS_SQL = f"WITH {T} SELECT 'dwd-' || (seq % 4) AS topic, event_type AS name, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS time, value, CAST(seq % 4 AS INT) AS line_id FROM t"


def retain_today(spark, sf):
    t = tags(spark, sf)
    return route.retain_from(t, "2024-01-15").select("event_type", "ms", "seq", "value")


RETAIN_SQL = f"WITH {T} SELECT event_type, ms, seq, value FROM t WHERE ms >= epoch_ms(TIMESTAMP '2024-01-15')"


def _change_log(spark, sf) -> DataFrame:
    """A change log made of ``events``: each user's record of an id is created, updated by the next, or deleted."""
    t = tags(spark, sf)
    m = lambda k, v: F.create_map(F.lit("id"), k.cast("string"), F.lit("kind"), v)
    op = F.when(F.col("seq") % 7 == 0, "d").when(F.col("seq") % 3 == 0, "u").otherwise("c")
    after = F.when(F.col("seq") % 7 != 0, m(F.col("user_id"), F.col("event_type")))
    before = F.when(op != "c", m(F.col("user_id"), F.when(F.col("seq") % 2 == 0, F.col("event_type")).otherwise(F.lit("none"))))
    return t.select(before.alias("before"), after.alias("after"), op.alias("op"), F.col("seq").alias("ts_ms"), F.lit("tag_conf").alias("table"))


def cdc_normalize(spark, sf):
    n = changes.normalize(_change_log(spark, sf))
    return n.select("table", "type", "ts", F.col("data")["id"].alias("id"), F.col("data")["kind"].alias("kind"), F.coalesce(F.size("old"), F.lit(-1)).cast("long").alias("n_old"), F.col("old")["kind"].alias("old_kind"))


_OLD = "CASE WHEN seq % 2 = 0 THEN event_type ELSE 'none' END"
CDC_SQL = f"""WITH {T} SELECT 'tag_conf' AS "table", CASE WHEN seq % 7 = 0 THEN 'delete' WHEN seq % 3 = 0 THEN 'update' ELSE 'insert' END AS type, seq AS ts,
CAST(user_id AS VARCHAR) AS id, CASE WHEN seq % 7 = 0 THEN {_OLD} ELSE event_type END AS kind,
CAST(CASE WHEN seq % 7 <> 0 AND seq % 3 = 0 THEN CASE WHEN {_OLD} <> event_type THEN 1 ELSE 0 END ELSE -1 END AS BIGINT) AS n_old,
CASE WHEN seq % 7 <> 0 AND seq % 3 = 0 AND {_OLD} <> event_type THEN {_OLD} END AS old_kind FROM t"""


def cdc_apply(spark, sf):
    t = tags(spark, sf)
    now = spark.createDataFrame([(1, "old"), (-5, "kept")], "user_id long, event_type string")
    log = t.select("user_id", "event_type", F.when(F.col("seq") % 7 == 0, "d").otherwise("u").alias("op"), F.col("seq").alias("ts_ms"))
    return changes.apply_changes(now, log, ["user_id"])


CDC_APPLY_SQL = f"""WITH {T}, a AS (SELECT user_id, arg_max(event_type, seq) AS event_type, max(seq) AS s FROM t GROUP BY 1)
SELECT user_id, event_type FROM a WHERE s % 7 <> 0 UNION ALL SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'old'), (-5, 'kept')) v(user_id, event_type) WHERE user_id NOT IN (SELECT user_id FROM a)"""


def cep_next(spark, sf):
    """A user's click, then at once a view, then a purchase, within two days."""
    is_ = lambda k: F.col("event_type") == k
    return pattern.match_next(tags(spark, sf), [is_("click"), is_("view"), is_("purchase")], ["user_id"], within=2 * DAY)


CEP_SQL = f"""WITH {T}, x AS (SELECT *, lead(event_type) OVER w AS e1, lead(event_type, 2) OVER w AS e2, lead(seq, 2) OVER w AS last_seq, lead(ms, 2) OVER w AS last_ms FROM t WINDOW w AS (PARTITION BY user_id ORDER BY ms, seq))
SELECT user_id, seq AS first_seq, last_seq, ms AS first_ms, last_ms FROM x WHERE event_type = 'click' AND e1 = 'view' AND e2 = 'purchase' AND last_ms - ms < {2 * DAY}"""


def cep_times(spark, sf):
    """Two records in a row of one type, at once three of others, within ten days."""
    click = F.col("event_type").isin("click", "error")
    return pattern.match_times(tags(spark, sf), [(click, 2), (~click, 3)], ["user_id"], within=10 * DAY)


_CLICK = lambda k: f"lead(event_type IN ('click', 'error'), {k}) OVER w"
CEP_TIMES_SQL = f"""WITH {T}, x AS (SELECT *, {_CLICK(0)} AND {_CLICK(1)} AND NOT {_CLICK(2)} AND NOT {_CLICK(3)} AND NOT {_CLICK(4)} AS hit, lead(seq, 4) OVER w AS last_seq, lead(ms, 4) OVER w AS last_ms FROM t WINDOW w AS (PARTITION BY user_id ORDER BY ms, seq))
SELECT user_id, seq AS first_seq, last_seq, ms AS first_ms, last_ms FROM x WHERE hit AND last_ms - ms < {10 * DAY}"""


def cep_switching(spark, sf):
    """click-view pairs until a user's first signup, view-purchase pairs after."""
    is_ = lambda k: F.col("event_type") == k
    return pattern.match_switching(tags(spark, sf), [is_("click"), is_("view")], [is_("view"), is_("purchase")], is_("signup"), ["user_id"], within=5 * DAY)


CEP_SWITCH_SQL = f"""WITH {T}, x AS (SELECT *, sum(CAST(event_type = 'signup' AS INT)) OVER (PARTITION BY user_id ORDER BY ms, seq ROWS UNBOUNDED PRECEDING) AS e FROM t),
y AS (SELECT *, lead(event_type) OVER w AS e1, lead(seq) OVER w AS last_seq, lead(ms) OVER w AS last_ms FROM x WHERE event_type <> 'signup' WINDOW w AS (PARTITION BY user_id, e ORDER BY ms, seq))
SELECT user_id, seq AS first_seq, last_seq, ms AS first_ms, last_ms FROM y WHERE last_ms - ms < {5 * DAY} AND ((e = 0 AND event_type = 'click' AND e1 = 'view') OR (e > 0 AND event_type = 'view' AND e1 = 'purchase'))"""


def decode_messages(spark, sf):
    """Records of messages made clean: booleans as numbers, empty and broken values gone."""
    t = tags(spark, sf)
    text = F.when(F.col("seq") % 5 == 0, "True").when(F.col("seq") % 11 == 0, "n/a").when(F.col("seq") % 13 == 0, "").otherwise(F.col("value").cast("decimal(18,4)").cast("string"))
    wire = F.regexp_replace(time_text(F.col("ms")), "[^0-9]", "")
    return messages.clean_tags(t.select("seq", F.col("event_type").alias("name"), wire.alias("time"), text.alias("text"))).select("seq", "name", "ms", F.col("value").cast("double").alias("value"), "str_value")


DECODE_SQL = f"""WITH {T} SELECT seq, event_type AS name, ms - ms % 1000 AS ms, CASE WHEN seq % 5 = 0 THEN 1.0 ELSE CAST(d AS DOUBLE) END AS value, CASE WHEN seq % 5 = 0 THEN 'True' END AS str_value
FROM t WHERE seq % 5 = 0 OR (seq % 11 <> 0 AND seq % 13 <> 0)"""


def time_formats(spark, sf):
    t = tags(spark, sf).withColumn("text", time_text(F.col("ms")))
    return t.select("seq", "text", wire_time(F.regexp_replace("text", "[^0-9]", "")).alias("back"))


TIME_SQL = f"WITH {T} SELECT seq, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS text, ms - ms % 1000 AS back FROM t"

# ---- chains, rules, streams -----------------------------------------------------------------------------------------


def _chain_of(op: str, args: str, places: int) -> str:
    """SQL of a recursive operator's results, as it rounds them, summed by the day."""
    first, step, out = {"EMA": ("value AS y", "(2 * s.value + 4 * r.y) / 6", "y"), "DIF": ("value AS y, value AS z", "(2 * s.value + 2 * r.y) / 4, (2 * s.value + 5 * r.z) / 7", "y - z")}[op]
    return CHAIN_SQL.format(rows=_ROWS, first=first, step=step, out=r4(out, places), day=DAY, agg=f"CAST(round(CAST(CAST(sum(CAST(v AS DECIMAL(19,9))) AS DOUBLE) AS DECIMAL(28,10)), 6) AS DOUBLE)")


def _chain_sum(op: str, args: str):
    """A chain whose first stage gives more places than values have: none may be lost on the way to the sum."""
    return lambda spark, sf: run_chain(tags(spark, sf), parse_spec(f"{op}_SUM", f"{args}|1d,1d"), PAIR).select(*PAIR, "ms", round_half_up(F.col("value"), 6).alias("value"))


def _chain(kind: str, param: str, keys: list[str]):
    return lambda spark, sf: run_chain(tags(spark, sf), parse_spec(kind, param), keys).select(*keys, "ms", F.col("value").cast("double").alias("value"))


_AVG_H = f"a AS (SELECT event_type, ms - ms % 3600000 + 3600000 AS ms, {r4('CAST(sum(d) AS DOUBLE) / count(*)')} AS value FROM t GROUP BY 1, 2)"
CHAIN_AVG_VAR_SQL = f"WITH {T}, {_AVG_H}, x AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ms) AS o, row_number() OVER (PARTITION BY event_type ORDER BY ms) AS rn FROM a) SELECT event_type, ms, {r4('value - o')} AS value FROM x WHERE rn > 1"
CHAIN_SQL = """WITH RECURSIVE {rows}, r AS (SELECT event_type, user_id, ms, seq, rn, {first} FROM s WHERE rn = 1
UNION ALL SELECT s.event_type, s.user_id, s.ms, s.seq, s.rn, {step} FROM r JOIN s ON s.event_type = r.event_type AND s.user_id = r.user_id AND s.rn = r.rn + 1),
f AS (SELECT event_type, user_id, ms, {out} AS v FROM r)
SELECT event_type, user_id, ms - ms % {day} + {day} AS ms, {agg} AS value FROM f GROUP BY 1, 2, 3"""
_DJ = "CASE WHEN s.value - r.y BETWEEN -50 AND 50 THEN s.value ELSE r.y END"
CHAIN_FILTER_SQL = CHAIN_SQL.format(rows=_ROWS, first="value AS y, value AS z", step=f"{_DJ}, 0.3::DOUBLE * ({_DJ}) + (1 - 0.3::DOUBLE) * r.z", out=r4("z"), day=DAY, agg=r4("CAST(sum(CAST(v AS DECIMAL(18,4))) AS DOUBLE) / count(*)"))


RULE_KEYS = ["line_id", "task_name", "out_name", "tag_topic"]


def rules_chunked(spark, sf):
    """rules_all with the series of its sequences cut by the day."""
    r = raw(spark, sf).withColumn("day", F.floor(F.col("ms") / DAY))
    return _graded(calculate(r, enrich.online(conf(spark)), ["user_id", "day"], RULE_KEYS, chunk=CHUNK))


def rules_all(spark, sf):
    """The whole of it: enrich, formulas, every online rule's chain, and the results as a table of results has them."""
    r = raw(spark, sf).withColumn("day", F.floor(F.col("ms") / DAY))  # a message is what one user sends on one day
    return _graded(calculate(r, enrich.online(conf(spark)), ["user_id", "day"], RULE_KEYS))


def _graded(found: DataFrame) -> DataFrame:
    graded = results(found).withColumn("grade", route.grade(F.col("out_name"), F.col("calculate_params")))
    return graded.withColumn("value", round_half_up(F.col("value"))).withColumn("calculate_time", time_text(F.unix_millis("calculate_time")))


def rules_enriched(spark, sf):
    """The rules over single tags, from records that are enriched already."""
    out = run_rules(enriched(spark, sf), ["line_id", "task_name", "out_name"])
    return out.select("out_name", "calculate_type", F.floor(F.col("ms") / 1000).alias("s"), round_half_up(F.col("value")).alias("value"))


_RULE = "SELECT '{0}' AS out_name, 'opc' AS tag_topic, {1} AS value, ms, '{2}' AS calculate_type, '{3}' AS calculate_params, '{4}' AS job_name, CAST({5} AS INT) AS line_id, '{6}' AS grade FROM {7}"
RULES_SQL = f"""WITH RECURSIVE {T}, {_MESSAGES}, {_AVG_H}, mx AS (SELECT ms - ms % 3600000 + 3600000 AS ms, max(value) AS value FROM t WHERE event_type = 'click' GROUP BY 1),
v AS (SELECT ms, value - lag(value) OVER (ORDER BY ms) AS value, row_number() OVER (ORDER BY ms) AS rn FROM a WHERE event_type = 'view'),
l AS (SELECT ms, lag(value, 2) OVER (ORDER BY ms, seq) AS value, row_number() OVER (ORDER BY ms, seq) AS rn FROM t WHERE event_type = 'purchase'),
lead_ AS (SELECT ms - ms % {DAY} + {DAY} AS ms, CAST(sum(CAST(c - v AS DECIMAL(19,9))) AS DOUBLE) / count(*) AS value FROM m WHERE c IS NOT NULL GROUP BY 1),
mid AS (SELECT w + 7200000 AS ms, median(value) AS value FROM (SELECT value, unnest(range(ms - ms % 3600000, ms - 7200000, -3600000)) AS w FROM t WHERE event_type = 'view') GROUP BY w),
n AS (SELECT ms, value, row_number() OVER (ORDER BY ms, seq) AS rn FROM t WHERE event_type = 'purchase'),
f AS (SELECT ms, value, rn FROM n WHERE rn = 1 UNION ALL SELECT n.ms, 0.3::DOUBLE * n.value + (1 - 0.3::DOUBLE) * f.value, n.rn FROM f JOIN n ON n.rn = f.rn + 1),
z AS ({" UNION ALL ".join(_RULE.format(*x) for x in (
    ("click_avg", "value", "AVG", "1h,1h", "job1", 1, "minute", "a WHERE event_type = 'click'"), ("click_max", "value", "MAX", "1h,1h", "job1", 1, "minute", "mx"),
    ("view_dif", "value", "AVG_VAR", "1h,1h|1", "job1", 1, "minute", "v WHERE rn > 1"), ("purchase_$", "value", "LAST", "2", "job2", 2, "pre", "l WHERE rn > 2"),
    ("ratio", _RATIO, "RAW", "", "job2", 2, "minute", "m WHERE c IS NOT NULL"), ("busy", _BUSY, "RAW", "", "job2", 2, "minute", "m WHERE c IS NOT NULL"),
    ("lead_avg", "value", "AVG", "1d,1d", "job1", 1, "minute", "lead_"), ("view_mid", "value", "MEDIAN", "2h,1h", "job1", 1, "minute", "mid"), ("smooth", "value", "FOF", "0.3", "job2", 2, "minute", "f"),
))})
SELECT out_name, tag_topic, {r4("value")} AS value, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS calculate_time, calculate_type, calculate_params, job_name, line_id, grade FROM z"""


#: The same as far as the watermark comes: windows that have ended, records before it, messages whose day is over.
STREAM_RULES_SQL = RULES_SQL + f""" WHERE CASE WHEN out_name IN ('ratio', 'busy') THEN (ms // {DAY} + 1) * {DAY} <= (SELECT max(ms) FROM t) - 1000
 WHEN calculate_type IN ('LAST', 'FOF') THEN ms < (SELECT max(ms) FROM t) - 1000 ELSE ms <= (SELECT max(ms) FROM t) - 1000 END"""


def _stream(spark, sf) -> DataFrame:
    """``events`` as a stream; a micro-batch is a bounded number of files."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 16).parquet(sf)
    return e.select("event_type", "user_id", F.timestamp_millis(millis(F.col("ts"))).alias("ts"), millis(F.col("ts")).alias("ms"), F.col("event_id").alias("seq"), "value")


def _folder(spark) -> str:
    """A folder of its own for a stream under the shared folder; a temporary one only where everything is one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="sensorloom-")
    return f"{shared}/stream-{uuid.uuid4().hex[:12]}"


def _fed(spark, sf, result, times: int = 3) -> DataFrame:
    """``result`` of a stream over ``events`` that come in ``times`` stretches of time, the query started anew for each.

    A stretch is written to the stream's folder, then the query reads it from its checkpoint on; the records of a stretch
    stand in files in any order.
    """
    folder = _folder(spark)
    e = spark.read.parquet(f"{sf}/events.parquet")
    at = millis(F.col("ts"))
    bounds = e.select(at.alias("ms")).approxQuantile("ms", [k / times for k in range(1, times)], 0.01)
    part = sum((F.when(at > b, 1).otherwise(0) for b in bounds), F.lit(0))
    for k in range(times):
        e.where(part == k).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(e.schema).parquet(f"{folder}/in")
        out = streams.replay(result(source.select("event_type", "user_id", at.alias("ms"), F.col("event_id").alias("seq"), "value")), folder)
    return out


def stream_rules(spark, sf):
    """rules_all on a stream: every online rule's chain, formulas included, over several micro-batches and restarts."""
    def run(t):
        r = t.withColumnRenamed("event_type", "name").withColumn("topic", F.lit("opc")).withColumn("day", F.floor(F.col("ms") / DAY))
        return calculate(r, enrich.online(conf(spark)), ["user_id", "day"], RULE_KEYS)

    return _graded(_fed(spark, sf, run))


def stream_windows(spark, sf):
    """Hourly averages and maxima of the replayed stream, as far as its watermark came."""
    return streams.replay(streams.stream_windows(_stream(spark, sf), {"avg": "AVG", "max": "MAX"}, ["event_type"], "1 hour", "1 hour"), _folder(spark))


STREAM_SQL = f"""WITH {T}, {_AVG_H}, m AS (SELECT event_type, ms - ms % 3600000 + 3600000 AS ms, max(value) AS hi FROM t GROUP BY 1, 2)
SELECT event_type, ms - 3600000 AS win_start, ms AS win_end, value AS avg, hi AS max FROM a JOIN m USING (event_type, ms) WHERE ms <= (SELECT max(ms) FROM t) - 1000"""


def stream_holistic(spark, sf):
    """MEDIAN, SLOPE and INTERP of sliding windows in a stream."""
    return streams.replay(streams.stream_windows(_stream(spark, sf), {"median": "MEDIAN", "slope": "SLOPE", "interp": "INTERP"}, ["event_type"], "2 hours", "1 hour"), _folder(spark))


STREAM_HOLISTIC_SQL = f"""WITH {T}, x AS (SELECT *, unnest(range(ms - ms % 3600000, ms - 7200000, -3600000)) AS win_start FROM t),
w AS (SELECT *, row_number() OVER (PARTITION BY event_type, win_start ORDER BY ms, seq) AS rn FROM x)
SELECT event_type, win_start, win_start + 7200000 AS win_end, {r4("median(value)")} AS median, {r4("nullif(regr_slope(value, rn), 'nan'::DOUBLE)")} AS slope, arg_max(value, (ms, seq)) AS interp FROM w
WHERE win_start + 7200000 <= (SELECT max(ms) FROM t) - 1000 GROUP BY event_type, win_start"""


def stream_dynamic(spark, sf):
    """Windows of each record's own size and slide in a stream."""
    size = F.expr(SIZE_BY_TYPE).cast("long")
    slide = F.when(F.col("event_type") == "click", 5400000).otherwise(0).cast("long")
    return streams.replay(streams.stream_each_window(_stream(spark, sf), "SUM", ["event_type"], size, slide, default=("2h", "1h")), _folder(spark))


def stream_last(spark, sf):
    return streams.replay(streams.stream_sequence(_stream(spark, sf), "LAST", (2,), "event_type"), _folder(spark))


def stream_rsi(spark, sf):
    return streams.replay(streams.stream_sequence(_stream(spark, sf), "RSI", (14,), "event_type"), _folder(spark))


def stream_filter(spark, sf):
    """A recursive filter in a stream, state per type and user."""
    return streams.replay(streams.stream_sequence(_stream(spark, sf), "KF", FILTER_ARGS["KF"], PAIR), _folder(spark))


def stream_match(spark, sf):
    """The contiguous pattern of cep_next in a stream."""
    is_ = lambda k: F.col("event_type") == k
    return streams.replay(streams.stream_match(_stream(spark, sf), [is_("click"), is_("view"), is_("purchase")], ["user_id"], within=2 * DAY), _folder(spark))


def stream_switching(spark, sf):
    """The pattern of cep_switching in a stream."""
    is_ = lambda k: F.col("event_type") == k
    found = streams.stream_match(_stream(spark, sf), [is_("click"), is_("view")], ["user_id"], 5 * DAY, [is_("view"), is_("purchase")], is_("signup"))
    return streams.replay(found, _folder(spark))


def stream_enrich(spark, sf):
    """Each micro-batch meets the rules as they are when it comes."""
    folder = _folder(spark)
    r = _stream(spark, sf).withColumnRenamed("event_type", "name").withColumn("topic", F.lit("opc"))
    query = streams.stream_enrich(r, lambda: enrich.online(conf(spark)), connectors.parquet_batches(f"{folder}/out"), f"{folder}/check")
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("out_name", "calculate_type", "param", "task_name", "line_id", "ms", "seq", "value")


def stream_changes(spark, sf):
    """A table kept up to date by a stream of change messages in JSON that come out of order over several micro-batches."""
    folder = _folder(spark)
    e = spark.read.parquet(f"{sf}/events.parquet")
    row = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("event_type"), F.col("event_type"))
    gone = F.col("event_id") % 7 == 0
    op = F.when(gone, "d").when(F.col("event_id") % 3 == 0, "u").otherwise("c")
    text = F.to_json(F.struct(F.when(op != "c", row).alias("before"), F.when(~gone, row).alias("after"), op.alias("op"), F.col("event_id").alias("ts_ms"), F.struct(F.lit("tag_conf").alias("table")).alias("source")))
    schema, key = "user_id long, event_type string", ["user_id"]
    for k in range(3):  # each part has changes of all times, so a late one meets what a newer one has left
        e.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k).select(text.alias("value")).write.mode("append").text(f"{folder}/in")
        changes.follow(spark.readStream.text(f"{folder}/in"), key, schema, f"{folder}/table", f"{folder}/check", fold=2).awaitTermination()
    return changes.current(spark, f"{folder}/table", schema, key)


STREAM_CHANGES_SQL = f"WITH {T}, a AS (SELECT user_id, arg_max(event_type, seq) AS event_type, max(seq) AS s FROM t GROUP BY 1) SELECT user_id, event_type FROM a WHERE s % 7 <> 0"


def stream_assemble(spark, sf):
    """Rows of a post as soon as the hour's last value of each of its keys is there, and what never got complete.

    The values of an hour come in up to two of several micro-batches.
    """
    folder = _folder(spark)
    names = ("click", "view", "purchase")
    hours = _hourly(spark, sf).where(F.col("out_name").isin(*names)).groupBy("ms", "out_name").agg(F.max_by("value", "seq").alias("value"))
    hours.write.parquet(f"{folder}/hours")
    hours = spark.read.parquet(f"{folder}/hours")
    bounds = hours.approxQuantile("ms", [1 / 3, 2 / 3], 0.01)
    when = F.col("ms") + F.when(F.col("out_name") == "view", HOUR).otherwise(0)
    for k in range(3):
        hours.where(sum((F.when(when > b, 1).otherwise(0) for b in bounds), F.lit(0)) == k).write.mode("append").parquet(f"{folder}/in")
        s = spark.readStream.schema(hours.schema).parquet(f"{folder}/in").select(F.lit("hourly").alias("post_name"), F.timestamp_millis("ms").alias("ts"), "out_name", "value")
        out = streams.replay(streams.stream_assemble(s, {"hourly": 3}, 3 * HOUR, "2 hours", {"hourly": "http://a"}, incomplete=True), folder)
    value = F.from_json("body", "map<string,double>")
    return out.select("post_name", "url", "ms", "complete", "missing", *(value[n].alias(n) for n in names))


STREAM_ASSEMBLE_SQL = f"""WITH {_HOURS}, k AS (SELECT ms, count(*) AS n, {", ".join(f"max(value) FILTER (event_type = '{n}') AS {n}" for n in ("click", "view", "purchase"))} FROM h WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ms)
SELECT 'hourly' AS post_name, 'http://a' AS url, ms, n = 3 AS complete, CAST(3 - n AS INT) AS missing, click, view, purchase FROM k WHERE n = 3 OR ms + 3 * {HOUR} <= (SELECT max(ms) FROM k) - 2 * {HOUR}"""


def stream_last_changing(spark, sf):
    """last_changing_n in a stream: each record brings its n."""
    n = F.floor(F.col("ms") / DAY) % 2 + 1
    return _fed(spark, sf, lambda t: streams.stream_sequence(t, "LAST", (1,), "event_type", changing=n))


STREAM_CHANGING_SQL = f"""WITH {T}, x AS (SELECT *, (ms // {DAY}) % 2 + 1 AS n FROM t), y AS (SELECT *, CAST(n <> lag(n) OVER ({ORDER}) AS INT) AS c FROM x),
z AS (SELECT *, sum(coalesce(c, 0)) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS e FROM y),
l AS (SELECT *, lag(value) OVER w AS o1, lag(value, 2) OVER w AS o2, row_number() OVER w AS rn FROM z WINDOW w AS (PARTITION BY event_type, e ORDER BY ms, seq))
SELECT event_type, ms, seq, CASE n WHEN 1 THEN o1 ELSE o2 END AS value FROM l WHERE rn > n"""


def retain_rewrite(spark, sf):
    """A table rewritten without its old rows."""
    name = f"kept_{uuid.uuid4().hex[:12]}"
    tags(spark, sf).select("event_type", "ms", "seq").write.saveAsTable(name)
    route.keep_from(spark, name, "2024-01-15")
    return spark.table(name)


REWRITE_SQL = f"WITH {T} SELECT event_type, ms, seq FROM t WHERE ms >= epoch_ms(TIMESTAMP '2024-01-15')"


def entry_query(spark: SparkSession, sf: str) -> DataFrame:
    return rules_all(spark, sf)


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _register(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


for _op in WINDOW_OPS:
    _register(f"win_{_op.lower()}_tumbling", _window(_op, "1h", "1h"), _window_sql(_op, "3600000", "3600000"))
    _register(f"win_{_op.lower()}_sliding", _window(_op, "2h", "30m"), _window_sql(_op, "7200000", "1800000"))
_all = ", ".join(f"w{i}.value AS {op.lower()}" for i, op in enumerate(WINDOW_OPS))
_register("win_all_tumbling", win_all_tumbling, f"SELECT w0.event_type, w0.win_start, w0.win_end, {_all} FROM " + " ".join(("JOIN " if i else "") + f"({_window_sql(op, '3600000', '3600000')}) w{i}" + (" ON w0.event_type = w%d.event_type AND w0.win_start = w%d.win_start" % (i, i) if i else "") for i, op in enumerate(WINDOW_OPS)))
_register("dynwin_sum", dynwin_sum, DYNWIN_SQL)
_register("win_gap_offset", win_gap_offset, GAP_SQL)
_register("win_integer_order", win_integer_order, INTEGER_SQL)
for _op in ("LAST", "VAR", "TREND"):
    _register(_op.lower(), _lag(_op, 2), _lag_sql(_op, 2))
_register("last_changing_n", last_changing, LAST_CHANGING_SQL)
_register("lag_fused", lag_fused, LAG_FUSED_SQL)
_register("rsi", rsi, RSI_SQL)
for _op in FILTER_ARGS:
    _register(_op.lower(), _filter(_op), FILTER_SQL[_op])
_FUSED = "SELECT " + "f0.event_type, f0.user_id, f0.ms, f0.seq, " + ", ".join(f"f{i}.value AS {op.lower()}" for i, op in enumerate(FILTER_ARGS)) + " FROM " + " ".join(("JOIN " if i else "") + f"({FILTER_SQL[op]}) f{i}" + (f" ON f0.seq = f{i}.seq" if i else "") for i, op in enumerate(FILTER_ARGS))
_register("filters_fused", filters_fused, _FUSED)
_register("filters_chunked", filters_chunked, _FUSED)
for _op in FILTER_ARGS:
    _register(f"{_op.lower()}_chunked", _filter(_op, CHUNK), FILTER_SQL[_op])
_register("raw", lambda spark, sf: run_chain(tags(spark, sf), parse_spec("RAW", ""), ["event_type"]), f"WITH {T} SELECT event_type, ms, seq, value FROM t")
for _name, _query, _sql in (
    ("enrich", enriched, ENRICH_SQL), ("spec_changes", spec_changes, SPEC_CHANGES_SQL), ("enrich_as_of", _as_of(enrich.SMALL), AS_OF_SQL), ("enrich_as_of_buckets", _as_of(0), AS_OF_SQL), ("tag_semi_filter", tag_semi_filter, SEMI_SQL), ("formula", formula, FORMULA_SQL), ("filter_normal_job", normal_job, NORMAL_SQL),
    ("parse_params", parse_params, PARSE_SQL), ("route_union", route_union, ROUTE_SQL), ("grade_split", grade_split, GRADE_SQL), ("post_fanout", post_fanout, FANOUT_SQL),
    ("post_assemble", post_assemble, ASSEMBLE_SQL), ("post_requests", post_requests, REQUESTS_SQL), ("feedback", feedback, FEEDBACK_SQL), ("json_topics", json_topics, TOPICS_SQL),
    ("win_null_key", win_null_key, NULL_KEY_SQL), ("win_carry", win_carry, CARRY_SQL), ("win_carry_each", win_carry_each, CARRY_EACH_SQL), ("formula_rows", formula_rows, FORMULA_SQL), ("flatten_normal", flatten_normal, FLATTEN_SQL),
    ("operands", operands, OPERANDS_SQL), ("route_by_spec", route_by_spec, BY_SPEC_SQL), ("retain_rewrite", retain_rewrite, REWRITE_SQL),
    ("chain_ema_sum", _chain_sum("EMA", "5"), _chain_of("EMA", "5", 8)), ("chain_dif_sum", _chain_sum("DIF", "3,6"), _chain_of("DIF", "3,6", 9)),
    ("stream_holistic", stream_holistic, STREAM_HOLISTIC_SQL), ("stream_dynamic", stream_dynamic, f"SELECT * FROM ({DYNWIN_SQL}) WHERE win_end <= (SELECT max(epoch_us(ts) // 1000) FROM events) - 1000"),
    ("stream_rsi", stream_rsi, RSI_SQL), ("stream_filter", stream_filter, FILTER_SQL["KF"]), ("stream_match", stream_match, CEP_SQL), ("stream_switching", stream_switching, CEP_SWITCH_SQL),
    ("stream_enrich", stream_enrich, ENRICH_SQL), ("stream_changes", stream_changes, STREAM_CHANGES_SQL), ("stream_assemble", stream_assemble, STREAM_ASSEMBLE_SQL), ("retain_today", retain_today, RETAIN_SQL), ("cdc_normalize", cdc_normalize, CDC_SQL), ("cdc_apply", cdc_apply, CDC_APPLY_SQL),
    ("cep_next", cep_next, CEP_SQL), ("cep_times", cep_times, CEP_TIMES_SQL), ("stream_last_changing", stream_last_changing, STREAM_CHANGING_SQL), ("cep_switching", cep_switching, CEP_SWITCH_SQL), ("decode_messages", decode_messages, DECODE_SQL), ("time_formats", time_formats, TIME_SQL),
    ("chain_avg_var", _chain("AVG_VAR", "1h,1h|1", ["event_type"]), CHAIN_AVG_VAR_SQL),
    ("chain_dejump_fof_avg", _chain("DEJUMP_FOF_AVG", "-50,50|0.3|1d,1d", PAIR), CHAIN_FILTER_SQL),
    ("rules_all", rules_all, RULES_SQL), ("rules_chunked", rules_chunked, RULES_SQL), ("stream_rules", stream_rules, STREAM_RULES_SQL),
    ("rules_enriched", rules_enriched, f"SELECT out_name, calculate_type, epoch_us(strptime(calculate_time, '%Y-%m-%d %H:%M:%S')) // 1000000 AS s, value FROM ({RULES_SQL}) WHERE out_name NOT IN ('ratio', 'busy', 'lead_avg')"), ("stream_windows", stream_windows, STREAM_SQL), ("stream_last", stream_last, _lag_sql("LAST", 2)),
):
    _register(_name, _query, _sql)
