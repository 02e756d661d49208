"""The corpus pipeline: documents through quality rules, line dedup, near-dedup, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and reread as the next
stage's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dialoom.llm.decontaminate import remove_contaminated
from dialoom.llm.line_dedup import keep_lines
from dialoom.llm.near_dedup import drop_near_duplicates
from dialoom.llm.packing import op2_packing
from dialoom.llm.quality_rules import keep_good
from dialoom.llm.storage import Scratch, read_table, release_all


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_packing(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]
#: SQL can't express SimHash links, MinHash components, the tokenizer or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Scratch(spark, "pipeline")
    docs, opened = read_table(spark, sf_dir, "documents"), len(Scratch.open_ones)
    for name, stage in STAGES:
        docs = stages.save(stage(spark, docs, sf_dir), name)
        release_all(since=opened)
    return docs
