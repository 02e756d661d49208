"""Quality audit of a corpus: duplicates, short text, lengths, reasons and references. No text reaches its output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import text

SHORT = 20
# The length histogram's buckets, by their greatest length.
BUCKETS = ((20, "0-20"), (50, "21-50"), (100, "51-100"), (200, "101-200"), (None, "201+"))
# The three shapes of a source locator, with the kind of each field.
SHAPES = (
    (("timestamp", "string"), ("timestamp_seconds", "long"), ("line", "long")),
    (("page", "long"), ("page_line", "long"), ("cue", "string")),
    (("subtitle_id", "string"), ("start_ms", "long"), ("end_ms", "long"), ("source_line", "long"), ("start_char", "long"), ("end_char", "long")),
)


def duplicate_sizes(rows: DataFrame, column: str = "text") -> DataFrame:
    """(digest, n): counted before it meets its members, so a text that many rows hold is one row."""
    return rows.groupBy(text.digest(F.col(column)).alias("text_sha256")).agg(F.count("*").alias("n"))


def with_duplicates(rows: DataFrame, column: str = "text") -> DataFrame:
    """Adds text_sha256 and duplicate_count, by a join with the digests held more than once only."""
    more = duplicate_sizes(rows, column).where("n > 1").withColumnsRenamed({"text_sha256": "__digest", "n": "__n"})
    keyed = rows.withColumn("text_sha256", text.digest(F.col(column)))
    joined = keyed.join(more, F.col("text_sha256") == F.col("__digest"), "left")
    return joined.withColumn("duplicate_count", F.coalesce("__n", F.lit(1)).cast("long")).drop("__digest", "__n")


def duplicate_totals(rows: DataFrame, column: str = "text") -> DataFrame:
    sizes = duplicate_sizes(rows, column)
    return sizes.agg(F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("duplicate_utterances"))


def is_short(column: Column, most: int = SHORT) -> Column:
    if most < 0:
        raise ValueError("short_text_max can't be negative")
    return F.length(column) <= most


def reasons(short: Column, copies: Column) -> Column:
    return F.filter(F.array(F.when(short, "short_text"), F.when(copies > 1, "exact_duplicate")), lambda x: x.isNotNull())


def bucket(length: Column) -> Column:
    out = F.lit(BUCKETS[-1][1])
    for most, name in reversed(BUCKETS[:-1]):
        out = F.when(length <= most, name).otherwise(out)
    return out


def length_buckets(rows: DataFrame, column: str = "text") -> DataFrame:
    """Every bucket, those without rows as 0."""
    found = rows.groupBy(bucket(F.length(column)).alias("bucket")).agg(F.count("*").alias("n"))
    every = rows.sparkSession.createDataFrame([(i, name) for i, (_, name) in enumerate(BUCKETS)], "position int, bucket string")
    return every.join(found, "bucket", "left").select("position", "bucket", F.coalesce("n", F.lit(0)).alias("n"))


def reason_rollup(quarantine: DataFrame, by: str = "source_id", reason: str = "reason") -> DataFrame:
    """Counts per source and reason, and per reason over all sources (source null), in one pass."""
    return quarantine.groupingSets([[F.col(by), F.col(reason)], [F.col(reason)]], by, reason).agg(F.count("*").alias("n"))


def safe_locator(locator: str = "source_locator") -> Column:
    """The locator's fields of the first shape that is complete; null where none is."""
    out = F.lit(None).cast("string")
    for shape in reversed(SHAPES):
        whole = None
        for name, _ in shape:
            there = F.col(f"{locator}.{name}").isNotNull()
            whole = there if whole is None else whole & there
        out = F.when(whole, F.to_json(F.struct(*(F.col(f"{locator}.{n}").alias(n) for n in sorted(n for n, _ in shape))))).otherwise(out)
    return out


def utterance_candidates(rows: DataFrame, short_text_max: int = SHORT) -> DataFrame:
    """Utterances to look at, without their text."""
    found = with_duplicates(rows).withColumn("char_count", F.length("text").cast("long"))
    found = found.withColumn("reasons", reasons(is_short(F.col("text"), short_text_max), F.col("duplicate_count")))
    return found.where(F.size("reasons") > 0).withColumn("candidate_type", F.lit("utterance")).drop("text")


def mismatched(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Rows whose source and version are not a declared pair."""
    return rows.join(declared.select("source_id", F.col("dataset_version").alias("declared")), "source_id", "left").where(~F.col("dataset_version").eqNullSafe(F.col("declared")))


def miscounted(rows: DataFrame, declared: DataFrame, column: str) -> DataFrame:
    """Declared sources whose number of rows is another one, or that declare none."""
    actual = rows.groupBy("source_id").agg(F.count("*").alias("actual"))
    joined = declared.join(actual, "source_id", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return joined.where(~F.col(column).eqNullSafe(F.col("actual"))).select("source_id", F.col(column).alias("declared"), "actual")


def summary(rows: DataFrame, declared: DataFrame, quarantine: DataFrame | None = None, short_text_max: int = SHORT) -> DataFrame:
    """Per declared source: utterances, short and duplicate ones, and quarantined rows; 0 where there are none."""
    marked = with_duplicates(rows)
    of = marked.groupBy("source_id").agg(F.count("*").alias("utterances"), F.count_if(is_short(F.col("text"), short_text_max)).alias("short_text"), F.count_if(F.col("duplicate_count") > 1).alias("exact_duplicate"))
    out = declared.select("source_id").join(of, "source_id", "left")
    if quarantine is not None:
        out = out.join(quarantine.groupBy("source_id").agg(F.count("*").alias("quarantine")), "source_id", "left")
    return out.select("source_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in out.columns if c != "source_id"))
