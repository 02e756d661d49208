"""The queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dialoom.llm.decontaminate import op6_contamination
from dialoom.llm.line_dedup import op3_line_dedup
from dialoom.llm.near_dedup import op9_near_dedup
from dialoom.llm.packing import op2_packing
from dialoom.llm.pii import op1_pii
from dialoom.llm.quality_model import op4_quality_model
from dialoom.llm.quality_rules import op8_quality_rules
from dialoom.llm.secrets import op7_secrets
from dialoom.llm.sharding import op5_sharding
from dialoom.llm.storage import read_table
from dialoom.llm.token_files import op10_token_file


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda spark, d: read_table(spark, d, "documents")
    return {
        "op1_pii": lambda s, d: op1_pii(docs(s, d)),
        "op2_packing": lambda s, d: op2_packing(docs(s, d)),
        "op3_line_dedup": lambda s, d: op3_line_dedup(docs(s, d)),
        "op4_quality_model": lambda s, d: op4_quality_model(docs(s, d), read_table(s, d, "labels")),
        "op5_sharding": lambda s, d: op5_sharding(docs(s, d)),
        "op7_secrets": lambda s, d: op7_secrets(docs(s, d)),
        "op8_quality_rules": lambda s, d: op8_quality_rules(docs(s, d), read_table(s, d, "labels")),
        "op6_decontamination": lambda s, d: op6_contamination(docs(s, d), read_table(s, d, "benchmark")),
        "op9_near_dedup": lambda s, d: op9_near_dedup(docs(s, d)),
        "op10_token_file": lambda s, d: op10_token_file(docs(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {}
