"""Optional streaming intake: documents that arrive as files are audited in micro-batches, each batch committed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dialoom.operators import audit


def audited_stream(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str, short_text_max: int = audit.SHORT) -> StreamingQuery:
    """Flags short text as files arrive; a batch's number names its output, so a replayed batch replaces itself."""

    def batch(rows: DataFrame, number: int) -> None:
        marked = rows.withColumn("text_sha256", F.sha2("text", 256)).withColumn("short_text", audit.is_short(F.col("text"), short_text_max))
        marked.drop("text").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
