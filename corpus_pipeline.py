"""A corpus through five stages: toxicity, near-duplicates, decontamination, personal data, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm.common import Scratch
from sensorloom.llm.decontaminate import drop_contaminated
from sensorloom.llm.mixing import mix_sources
from sensorloom.llm.neardup import one_of_each
from sensorloom.llm.pii import redact_pii
from sensorloom.llm.toxicity import reject_toxic

#: (name, function of (spark, docs, sf_dir)); each stage's result is written and read again as the next one's docs.
STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_pii),
    ("mixing", mix_sources),
]
#: SQL can't say what the stages do; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(*before)  # no later stage reads it
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
