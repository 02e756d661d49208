"""Speaker resolution: an equi-join with the alias dimension; its size decides how it is joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import text


def resolve(rows: DataFrame, aliases: DataFrame, speaker: str = "speaker_raw") -> DataFrame:
    """Adds ``kind`` (persona, non_dialogue, unknown) and ``persona_id``. A key that is both counts as non-dialogue."""
    ranked = aliases.groupBy("key").agg(F.min_by(F.struct("kind", "persona_id"), "kind").alias("r")).select("key", "r.kind", "r.persona_id")
    keyed = rows.withColumn("__key", text.speaker_key(text.without_qualifier(F.col(speaker))))
    found = keyed.join(ranked, (F.col("__key") == F.col("key")) & (F.col("__key") != ""), "left")
    return found.withColumn("kind", F.coalesce("kind", F.lit("unknown"))).drop("__key", "key")


def speakers_seen(rows: DataFrame, speaker: str = "speaker_raw", by: str = "source_id") -> DataFrame:
    return rows.groupBy(by, text.normalize(F.col(speaker)).alias("speaker")).agg(F.count("*").alias("n"))
