"""Corpus pipeline over ``documents``: toxicity filter, near-dedup, pseudonyms, source mixing, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet to the shared folder and read back as the
next stage's ``docs``.  The last stage returns the packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import minhash, mixing, packing, pii, toxicity
from quarry.llm.common import Scratch, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_dedup", minhash.stage),
    ("pii", pii.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: A fitted classifier and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for i, (name, stage) in enumerate(STAGES):
            docs = scratch.put(stage(spark, docs, sf_dir), name, keep=stage is STAGES[-1][1])
            if i:  # a stage's input goes once its output is written
                scratch.drop(STAGES[i - 1][0])
        return docs
