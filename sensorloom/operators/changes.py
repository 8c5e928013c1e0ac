"""Change logs of the rule table: normal form, the state after all changes, and which version of a rule held when.

A change has a position, (ts_ms, pos). A state keeps with every key the position it was last set or deleted at, so
changes may come in any order and in any number of steps: a late one never undoes a newer one, and a deleted key stays
deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import parse_duration
from .enrich import RULE, SMALL

# The change log's operations.
KINDS = {"c": "insert", "r": "insert", "u": "update", "d": "delete"}
#: What a state has beside the table's columns: the position of the last change, and whether it was a deletion.
POSITION = ("_ts", "_pos", "_gone")


def normalize(events: DataFrame) -> DataFrame:
    """(before, after: map<string,string>, op, ts_ms, table) -> table, type, ts, data, old (only the changed columns)."""
    kind = F.create_map(*[F.lit(x) for p in KINDS.items() for x in p])[F.col("op")]
    old = F.map_filter("before", lambda k, v: ~v.eqNullSafe(F.element_at("after", k)))
    data = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return events.select("table", kind.alias("type"), F.col("ts_ms").alias("ts"), data.alias("data"), F.when(F.col("op") == "u", old).alias("old"))


def _placed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Changes (op, ts_ms and perhaps pos), or a table without positions, which is older than all changes, as a state's rows."""
    if set(POSITION) <= set(df.columns):
        return df.select(*columns, *POSITION)
    if "op" not in df.columns:
        return df.select(*columns, F.lit(None).cast("long").alias("_ts"), F.lit(None).cast("long").alias("_pos"), F.lit(False).alias("_gone"))
    pos = F.col("pos").cast("long") if "pos" in df.columns else F.lit(0).cast("long")
    return df.select(*columns, F.col("ts_ms").cast("long").alias("_ts"), pos.alias("_pos"), (F.col("op") == "d").alias("_gone"))


def latest(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of the rows of states, each key's of the last position; at one position a deletion counts, then the greatest row."""
    lowest = F.lit(-(2**63))
    columns = [c for c in rows.columns if c not in POSITION]
    order = F.struct(F.coalesce("_ts", lowest), F.coalesce("_pos", lowest), "_gone", F.xxhash64(*columns))
    return rows.groupBy(*key).agg(F.max_by(F.struct(*columns, *POSITION), order).alias("x")).select("x.*")


def merge_changes(state: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The state after ``changes``, deleted keys included; ``state`` is a table, or what this gave before."""
    columns = [c for c in state.columns if c not in POSITION]
    return latest(_placed(state, columns).unionByName(_placed(changes, columns)), key)


def live(state: DataFrame) -> DataFrame:
    """The table that a state stands for."""
    return state.where("not _gone").drop(*POSITION)


def apply_changes(current: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The rule table after ``changes`` (its columns plus op and ts_ms): of each key the latest change, none if deleted.

    Where more changes are to come later, keep the state of ``merge_changes`` instead, as ``follow`` does.
    """
    return live(merge_changes(current, changes, key))


def forget(state: DataFrame, before: int) -> DataFrame:
    """A state without deletions of earlier than ``before`` (ms): no change from that time may come any more."""
    return state.where(~F.col("_gone") | (F.col("_ts") >= before))


def parse_envelopes(df: DataFrame, column: str = "value") -> DataFrame:
    """Change messages as JSON text -> before, after (maps of texts), op, ts_ms, pos, table; texts that are none go.

    A snapshot's rows come as op 'r'; a deletion has no after. So the result feeds ``normalize`` and, by ``columns_of``,
    ``merge_changes``.
    """
    schema = "before map<string,string>, after map<string,string>, op string, ts_ms long, source struct<table:string,pos:long>"
    parsed = df.select(F.from_json(F.col(column).cast("string"), schema).alias("_e")).where(F.col("_e.op").isin(*KINDS))
    return parsed.select("_e.before", "_e.after", "_e.op", "_e.ts_ms", F.coalesce("_e.source.pos", F.lit(0)).alias("pos"), F.col("_e.source.table").alias("table"))


def columns_of(events: DataFrame, schema: str) -> DataFrame:
    """Parsed change messages of one table as rows of ``schema`` with op, ts_ms and pos; a deletion has the row that went."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    names = [c.split() for c in schema.split(", ")]
    more = ["pos"] if "pos" in events.columns else []
    return events.select(*(row[n].try_cast(t).alias(n) for n, t in names), "op", "ts_ms", *more)


#: Micro-batches whose changes are kept apart before they are folded into a new base.
FOLD = 20


def _versions(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers under ``path``/kind=number that are whole, in order."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = store.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS"))
    return sorted(int(x.getPath().getParent().getName().partition("=")[2]) for x in done or [])


def _state_schema(schema: str) -> str:
    return f"{schema}, _ts long, _pos long, _gone boolean"


def state_of(spark: SparkSession, path: str, schema: str, key: list[str], until: int | None = None) -> DataFrame:
    """The state under ``path`` after the micro-batch ``until`` (the last one by default): the newest base and what came since."""
    ok = lambda v: until is None or v <= until
    base = max((v for v in _versions(spark, path, "base") if ok(v)), default=-1)
    since = [v for v in _versions(spark, path, "delta") if v > base and ok(v)]
    folders = [f"{path}/base={base}"] * (base >= 0) + [f"{path}/delta={v}" for v in since]
    whole = _state_schema(schema)
    if not folders:
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).parquet(*folders)
    return latest(rows, key) if since else rows


def follow(log: DataFrame, key: list[str], schema: str, path: str, checkpoint: str, every: str | None = None, fold: int = FOLD, forget_ms: int | None = None):
    """Start a query that keeps a table up to date with a stream of change messages (text column ``value``).

    Each micro-batch writes its own changes under ``path``/delta=number; every ``fold`` of them they are folded into
    ``path``/base=number, and what the base before the last one needed is removed, so a reader that is at work keeps its
    files. A batch that is repeated replaces its own. ``current`` reads the table. Deletions are kept unless
    ``forget_ms`` says how far behind the newest change one may still come.
    """
    spark = log.sparkSession

    def batch(df: DataFrame, number: int) -> None:
        changes = columns_of(parse_envelopes(df), schema)
        latest(_placed(changes, [c.split()[0] for c in schema.split(", ")]), key).write.mode("overwrite").parquet(f"{path}/delta={number}")
        if number % fold == fold - 1:
            state = state_of(spark, path, schema, key, number)
            if forget_ms is not None:
                newest = state.agg(F.max("_ts")).first()[0]
                state = state if newest is None else forget(state, newest - forget_ms)
            state.write.mode("overwrite").parquet(f"{path}/base={number}")
            _prune(spark, path, number)

    w = log.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def _prune(spark: SparkSession, path: str, newest: int) -> None:
    """Remove what no reader of the newest base or of the one before it needs."""
    bases = [v for v in _versions(spark, path, "base") if v < newest]
    if not bases:
        return
    store = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f"base={v}" for v in bases[:-1]] + [f"delta={v}" for v in _versions(spark, path, "delta") if v <= bases[-1]]
    for name in old:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


def current(spark: SparkSession, path: str, schema: str, key: list[str]) -> DataFrame:
    """The table that ``follow`` keeps under ``path``, or an empty one; a micro-batch counts once it is whole."""
    return live(state_of(spark, path, schema, key))


# ---- versions ---------------------------------------------------------------------------------------------------------


def intervals(log: DataFrame, key: list[str]) -> DataFrame:
    """Changes -> every version of each key with valid_from and valid_to (ms, null: to this day); what is deleted has none.

    Of changes at one time the one of the last pos holds.
    """
    columns = [c for c in log.columns if c not in ("op", "ts_ms", "pos")]
    placed = _placed(log, columns)
    w = W.partitionBy(*key).orderBy("_ts", "_pos", "_gone")
    timed = placed.withColumn("valid_to", F.lead("_ts").over(w)).withColumnRenamed("_ts", "valid_from")
    return timed.where("not _gone and (valid_to is null or valid_from < valid_to)").select(*columns, "valid_from", "valid_to")


def _valid(ms: Column, versions: DataFrame) -> Column:
    return (ms >= versions["valid_from"]) & (versions["valid_to"].isNull() | (ms < versions["valid_to"]))


def enrich_as_of(raw: DataFrame, versions: DataFrame, bucket: str = "1d", most: int = SMALL) -> DataFrame:
    """As ``enrich.enrich``, with the version of each rule that was valid at the record's time, online ones only.

    ``versions``: the rule table's columns with valid_from and valid_to, see ``intervals``. Up to ``most`` versions are
    broadcast after they have been counted. More meet the records by tag and bucket of time: a version goes to the buckets
    that its tag has records in and that it overlaps, so no version is spread over empty time, no tag is one task's work.
    """
    rules = versions.where("calculate_type is not null and status = 1").select("tag_name", "tag_topic", *RULE, "valid_from", "valid_to")
    same = lambda l, r: (l["name"] == r["tag_name"]) & (l["topic"] == r["tag_topic"])
    if rules.limit(most + 1).count() <= most:
        rules = F.broadcast(rules)
        return raw.join(rules, same(raw, rules) & _valid(raw["ms"], rules)).select(*(c for c in raw.columns if c != "topic"), "tag_topic", *RULE)
    width = parse_duration(bucket)
    placed = raw.withColumn("_b", F.floor(F.col("ms") / width))
    used = placed.select("name", "topic", "_b").distinct()
    overlaps = (used["_b"] >= F.floor(rules["valid_from"] / width)) & (rules["valid_to"].isNull() | (used["_b"] * width < rules["valid_to"]))
    spread = rules.join(used, same(used, rules) & overlaps).drop("name", "topic").withColumnRenamed("_b", "_vb")
    met = placed.join(spread, same(placed, spread) & (placed["_b"] == spread["_vb"]) & _valid(placed["ms"], spread))
    return met.select(*(c for c in raw.columns if c != "topic"), "tag_topic", *RULE)
