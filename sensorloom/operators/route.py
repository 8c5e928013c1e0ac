"""Where results go: branches by operator, grades by name and parameters, and rows assembled for posting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import UNITS, time_text
from ..plans.spec import COUNT_OPS, LAG_OPS, WINDOW_OPS


def route(df: DataFrame, ops: list[str], column: str = "curr_cal") -> dict[str, DataFrame]:
    """One branch per operator."""
    return {op: df.where(F.col(column) == op) for op in ops}


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def route_by_spec(df: DataFrame, specs: list[str]) -> dict[str, DataFrame]:
    """One branch per ``type#param``."""
    return {s: df.where(F.concat_ws("#", "calculate_type", F.coalesce("param", F.lit(""))) == s) for s in specs}


#: Operand columns -> the operators that have them, and which of their arguments it is.
OPERANDS = {
    "win_size": (WINDOW_OPS, 0), "win_slide": (WINDOW_OPS, 1), "n": ((*LAG_OPS, *COUNT_OPS), 0), "a": (("FOF",), 0), "lower": (("DEJUMP",), 0), "upper": (("DEJUMP",), 1),
    "dt": (("KF",), 0), "r": (("KF",), 1), "fast": (("DIF",), 0), "slow": (("DIF",), 1),
}


def operands(df: DataFrame, index: Column | int = 0) -> DataFrame:
    """``df`` with curr_cal, the operator at place ``index`` of its chain, and OPERANDS, null where it has none such."""
    at = F.lit(index) if isinstance(index, int) else index
    op = F.get(F.split("calculate_type", "_"), at)
    args = F.split(F.coalesce(F.get(F.split("param", r"\|"), at), F.lit("")), ",")

    def number(ops, k):
        text = F.trim(F.coalesce(F.get(args, F.lit(k)), F.lit("")))
        if ops is WINDOW_OPS:
            unit = F.create_map(*[F.lit(x) for p in UNITS.items() for x in p])[F.regexp_extract(text, "([a-z]+)$", 1)]
            plain = F.regexp_extract(text, "^([0-9]+)", 1).try_cast("long") * unit
        else:
            plain = text.try_cast("long" if ops != ("FOF",) and ops[0] in (*LAG_OPS, *COUNT_OPS, "DIF") else "double")
        return F.when(op.isin(*ops), plain)

    return df.withColumn("curr_cal", op).select("*", *(number(*o).alias(k) for k, o in OPERANDS.items()))


def parse_params(df: DataFrame) -> DataFrame:
    """``df`` with total_index, first_op, first_args of its calculate_type and param."""
    ops, groups = F.split("calculate_type", "_"), F.split("param", r"\|")
    return df.withColumn("total_index", F.size(ops)).withColumn("first_op", F.get(ops, F.lit(0))).withColumn("first_args", F.get(groups, F.lit(0)))


def advance(df: DataFrame) -> DataFrame:
    """``df`` with curr_index one further and the operator that follows as curr_cal ('over' behind the last)."""
    step = F.col("curr_index") + 1
    return df.withColumn("curr_cal", F.coalesce(F.get(F.split("calculate_type", "_"), step), F.lit("over"))).withColumn("curr_index", step)


def grade(name: Column, param: Column) -> Column:
    """'pre' for names that end in _$, else 'second' if the parameters speak of seconds, else 'minute'."""
    return F.when(name.endswith("_$"), "pre").when(param.contains("s"), "second").otherwise("minute")


def post_keys(setup: DataFrame) -> DataFrame:
    """(post_name, key) of a setup with comma-joined post_keys; blanks are stripped."""
    keys = F.split(F.regexp_replace("post_keys", r"\s+", ""), ",")
    return setup.select("post_name", F.explode(F.array_distinct(keys)).alias("key")).where("key <> ''")


def fan_out(results: DataFrame, setup: DataFrame) -> DataFrame:
    """A row per result and post that names it."""
    from .enrich import small

    keys = small(post_keys(setup))
    return results.join(keys, results["out_name"] == keys["key"]).drop("key")


def assemble(results: DataFrame, setup: DataFrame, at: str = "ms") -> DataFrame:
    """(post_name, time) -> one row with a map of all values, where every key of the post is there."""
    from .enrich import small

    need = small(post_keys(setup).groupBy("post_name").agg(F.count("*").alias("need")))
    latest = fan_out(results, setup).groupBy("post_name", at, "out_name").agg(F.max_by("value", "seq").alias("value"))
    # a null value counts as there
    rows = latest.groupBy("post_name", at).agg(F.map_from_entries(F.collect_list(F.struct("out_name", "value"))).alias("values"), F.count("*").alias("have"))
    return rows.join(need, "post_name").where("have = need").drop("have", "need")


def post_requests(assembled: DataFrame, setup: DataFrame, at: str = "ms") -> DataFrame:
    """(url, body) of assembled rows: the values as JSON in the order of their names, with the row's time as create_time."""
    from .enrich import small

    urls = small(setup.groupBy("post_name").agg(F.max("post_url").alias("url")))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(F.transform_values("values", lambda k, v: v.cast("string")))))
    body = F.to_json(F.map_concat(ordered, F.create_map(F.lit("create_time"), time_text(F.col(at)))))
    return assembled.join(urls, "post_name").select("url", body.alias("body"))


def feedback(results: DataFrame, at: str = "ms") -> DataFrame:
    """Per time, the list of results that go back as raw tags (names that end in _$)."""
    back = results.where(F.col("out_name").endswith("_$"))
    return back.groupBy(at).agg(F.sort_array(F.collect_list(F.struct(F.col("out_name").alias("name"), "value"))).alias("tags"))


def retain_from(df: DataFrame, day: str, column: str = "ms") -> DataFrame:
    """Rows of ``day`` ('yyyy-MM-dd', UTC) or later."""
    return df.where(F.col(column) >= F.unix_date(F.lit(day).cast("date")).cast("long") * 86_400_000)


def keep_from(spark: SparkSession, name: str, day: str, column: str = "ms") -> None:
    """Rewrite the table ``name`` without the rows before ``day``; the old one stays until the new one is whole."""
    kept, gone = f"{name}_kept", f"{name}_gone"
    spark.sql(f"DROP TABLE IF EXISTS {kept}")
    retain_from(spark.table(name), day, column).write.saveAsTable(kept)
    for sql in (f"DROP TABLE IF EXISTS {gone}", f"ALTER TABLE {name} RENAME TO {gone}", f"ALTER TABLE {kept} RENAME TO {name}", f"DROP TABLE {gone}"):
        spark.sql(sql)
