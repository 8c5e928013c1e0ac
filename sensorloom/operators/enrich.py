"""Raw records meet the rule table: filters, fan-out and formulas over several tags of one message."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.formula import ARRAYS, compile_formula, formula_tags, is_formula

#: Rows up to which a rule table is broadcast; larger ones are joined by shuffling.
SMALL = 100_000


def collected(rows: DataFrame, what: str) -> list:
    """All rows on the driver; an error if they are more than SMALL, never a part of them."""
    found = rows.limit(SMALL + 1).collect()
    if len(found) > SMALL:
        raise ValueError(f"more than {SMALL} {what}")
    return found


def small(rules: DataFrame, most: int = SMALL) -> DataFrame:
    """``rules`` marked for broadcast if it has at most ``most`` rows, which is counted, else as it is."""
    plan = rules._jdf.queryExecution().optimizedPlan()
    rows = plan.data().size() if plan.nodeName() == "LocalRelation" else rules.limit(most + 1).count()
    return F.broadcast(rules) if rows <= most else rules


def at_hand(rules: DataFrame, most: int = SMALL) -> DataFrame:
    """``rules`` as a local table if it has at most ``most`` rows, so that what is made of it costs no job; else as it is."""
    rows = rules.limit(most + 1).toArrow()
    return rules.sparkSession.createDataFrame(rows, rules.schema) if rows.num_rows <= most else rules


def online(df: DataFrame) -> DataFrame:
    return df.where("status = 1")


def normal_and_job(df: DataFrame, jobs: list[str]) -> DataFrame:
    """Records of normal quality (null counts as normal) that belong to one of the jobs."""
    return df.where((F.coalesce("is_normal", F.lit(1)) == 1) & F.col("task_name").isin(jobs))


def used_tags(conf: DataFrame) -> DataFrame:
    """(tag_topic, tag_name) that any rule reads, the operands of formulas included."""
    operands = F.when(F.col("tag_name").contains("["), F.regexp_extract_all("tag_name", F.lit(r"\[([^\[\]]+)\]"), F.lit(1))).otherwise(F.array("tag_name"))
    return conf.select("tag_topic", F.explode(operands).alias("tag_name")).distinct()


def keep_used(raw: DataFrame, conf: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """Raw records whose tag some rule reads: a semi-join that drops the rest before anything else.

    ``used``: used_tags of ``conf``, if it is at hand.
    """
    used = small(used_tags(conf) if used is None else used)
    return raw.join(used, (raw["name"] == used["tag_name"]) & (raw["topic"] == used["tag_topic"]), "left_semi")


RULE = ("out_name", "calculate_type", "param", "task_name", "line_id", "status")


def enrich(raw: DataFrame, conf: DataFrame) -> DataFrame:
    """A row per record and rule on its (name, topic), with the rule's columns; rules without a type give none."""
    rules = small(conf.where("calculate_type is not null").select("tag_name", "tag_topic", *RULE))
    return raw.join(rules, (raw["name"] == rules["tag_name"]) & (raw["topic"] == rules["tag_topic"])).drop("tag_name", "topic")


def messages_of(raw: DataFrame, message: list[str], conf: DataFrame, span: str | None = None, used: DataFrame | None = None) -> DataFrame:
    """A row per message (the columns ``message`` and topic) with the list ``_l`` of its records that formulas read.

    In a stream, whose records have ts under a watermark, a message is what came in one ``span`` of event time.
    """
    own = list(dict.fromkeys([*message, "topic"]))
    kept = keep_used(raw, conf.where(F.col("tag_name").contains("[")), used)
    record = F.struct("seq", "ms", "name", F.col("value").cast("double").alias("v"))
    window = [] if span is None else [F.window("ts", span)]
    return kept.groupBy(*own, *window).agg(F.collect_list(record).alias("_l")).select(*own, "_l")


def formula_rows(raw: DataFrame, message: list[str], conf: DataFrame, span: str | None = None, lists: DataFrame | None = None) -> DataFrame:
    """Records of the rules that are formulas over several tags of one message, with the columns that ``enrich`` gives.

    As ``formula_values``, but the formulas stay data: a message's records meet in one list, which is joined with the
    formulas whose first tag it has, so the plan is the same for any number of rules, messages are shuffled once, and
    each text is read once a batch. Of a tag that repeats in a message the last record counts. ``lists``: messages_of,
    if several calls share it. Columns: the rule's, tag_topic, the message's, name (the formula), ms, seq and value.
    """
    lists = messages_of(raw, message, conf, span) if lists is None else lists
    own = lists.columns[:-1]
    formulas = conf.where(F.col("calculate_type").isNotNull() & F.col("tag_name").contains("["))
    tags = F.array_distinct(F.regexp_extract_all("tag_name", F.lit(r"\[([^\[\]]+)\]"), F.lit(1)))
    rules = small(formulas.select("tag_name", "tag_topic", *RULE, tags.alias("_tags"), F.get(tags, F.lit(0)).alias("_first")))
    each = lists.select("*", F.explode(F.array_distinct(F.transform("_l", lambda x: x["name"]))).alias("_name"))
    met = each.join(rules, (each["_name"] == rules["_first"]) & (each["topic"] == rules["tag_topic"]))
    last = lambda t: F.array_max(F.filter("_l", lambda x: x["name"] == t))
    by = [*own, "tag_name", *RULE]
    rows = met.select(*by, last(F.col("_first")).alias("_x"), F.transform("_tags", lambda t: last(t)["v"]).alias("_values"))
    rows = rows.select(*by, F.col("_x.ms").alias("ms"), F.col("_x.seq").alias("seq"), "_values")
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "_values"), T.StructField("value", T.DoubleType())])

    def work(batches):
        for pdf in batches:
            value = np.zeros(len(pdf))
            for text, at in pdf.groupby("tag_name").indices.items():
                given = np.array(pdf["_values"].iloc[at].tolist(), float)  # a column per tag
                place = {t: k for k, t in enumerate(formula_tags(text))}
                value[at] = compile_formula(text, lambda t: given[:, place[t]], ARRAYS)  # noqa: B023
            yield pdf.drop(columns="_values").assign(value=value)

    return rows.mapInPandas(work, schema).withColumnRenamed("tag_name", "name").withColumnRenamed("topic", "tag_topic")


def flatten_normal(df: DataFrame, column: str = "records") -> DataFrame:
    """A list of records per row -> one JSON text (``value``) per record of normal quality (is_normal 1; null counts as 1)."""
    each = df.select(F.explode(column).alias("_r"))
    return each.where(F.coalesce("_r.is_normal", F.lit(1)) == 1).select(F.to_json("_r").alias("value"))


def formula_values(raw: DataFrame, message: list[str], formulas: dict[str, str]) -> DataFrame:
    """Per message (the columns ``message``) and formula: out_name, ms and value.

    Operands come from the same message; a missing one counts as 0, but without its first operand, which gives time
    and place, a formula has no row. Operands are pivoted by one aggregation over all formulas; of a tag that repeats
    in a message the last record (by seq) counts.
    """
    tags = list(dict.fromkeys(t for f in formulas.values() for t in formula_tags(f)))
    at = {t: f"_t{i}" for i, t in enumerate(tags)}
    wide = raw.where(F.col("name").isin(tags)).groupBy(*message).agg(*(
        F.max(F.when(F.col("name") == t, F.struct("seq", F.col("value").cast("double").alias("v"), "ms"))).alias(c) for t, c in at.items()
    ))
    rows = []
    for name, text in formulas.items():
        first = at[formula_tags(text)[0]]
        value = compile_formula(text, lambda t: F.col(f"{at[t]}.v"))
        rows.append(F.when(F.col(first).isNotNull(), F.struct(F.lit(name).alias("out_name"), F.col(f"{first}.ms").alias("ms"), value.alias("value"))))
    found = wide.select(*message, F.explode(F.array_compact(F.array(*rows))).alias("_f"))
    return found.select(*message, "_f.out_name", "_f.ms", "_f.value")


def formulas_of(conf: DataFrame) -> dict[str, str]:
    """out_name -> formula of the rules that are formulas (the rule table is small by ``small``'s bound)."""
    rows = collected(conf.where(F.col("tag_name").contains("[")).select("out_name", "tag_name"), "formula rules")
    return {r["out_name"]: r["tag_name"] for r in rows if is_formula(r["tag_name"])}
