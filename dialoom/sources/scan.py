"""Bytes are read once: what is hashed is what is parsed."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions import digests
from dialoom.sources.errors import GateError


def verified(spark: SparkSession, files: list[tuple[str, Path, str]]) -> DataFrame:
    """(source_id, sha256, content) of (source_id, path, declared sha256). The control plane's few files are read by the
    driver, once; the frame holds those bytes, so no later action goes back to the file."""
    rows = []
    for source_id, path, declared in files:
        if not path.is_file():
            raise GateError(f"{source_id}: no such file: {path}")
        data = path.read_bytes()
        if digests.bytes_digest(data) != declared:
            raise GateError(f"{source_id}: sha256 differs from the manifest's")
        rows.append((source_id, declared, bytearray(data)))
    return spark.createDataFrame(rows, "source_id string, sha256 string, content binary")


def verified_at_scale(spark: SparkSession, paths: str, declared: DataFrame, to: str) -> tuple[DataFrame, DataFrame]:
    """The same for very many files in a store: read with ``binaryFile``, written to ``to`` once, and hashed and parsed
    from there. ``declared`` has (name, source_id, sha256). Gives the verified rows and the violations."""
    files = spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    files.join(declared, "name", "right").write.parquet(to)
    kept = spark.read.parquet(to)
    good = F.coalesce(F.sha2("content", 256) == F.col("sha256"), F.lit(False))
    return kept.where(good).select("source_id", "sha256", "content"), kept.where(~good).select("source_id", "name", F.when(F.col("content").isNull(), "missing").otherwise("hash").alias("violation"))


# Explicit schemas: nothing is inferred, so "001" stays a string and an absent key a null.
LOCATOR = T.StructType([T.StructField(n, T.LongType() if n in {"end_char", "end_ms", "line", "page", "page_line", "source_line", "start_char", "start_ms", "timestamp_seconds"} else T.StringType()) for n in ("cue", "end_char", "end_ms", "line", "page", "page_line", "source_line", "start_char", "start_ms", "subtitle_id", "timestamp", "timestamp_seconds")])
UTTERANCE = T.StructType([T.StructField(n, LOCATOR if n == "source_locator" else T.StringType()) for n in ("character_id", "dataset_version", "episode", "language", "parser_version", "schema_version", "series", "source_id", "source_locator", "source_sha256", "speaker_normalized", "speaker_raw", "text", "utterance_id")])
QUARANTINE = T.StructType([T.StructField(n, T.LongType() if n == "line_no" else T.StringType()) for n in ("dataset_version", "line_no", "parser_version", "raw", "reason", "schema_version", "source_id", "source_sha256")])
CUE = T.StructType([T.StructField(n, k) for n, k in (("subtitle_id", T.StringType()), ("start_ms", T.LongType()), ("end_ms", T.LongType()), ("source_line", T.LongType()), ("source_char", T.LongType()), ("source_byte", T.LongType()), ("visible_text", T.StringType()), ("korean_text", T.StringType()), ("is_clear", T.BooleanType()), ("timing_issue", T.StringType()))])
