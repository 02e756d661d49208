"""Transcripts: lines to blocks by a running count of headers, blocks to utterances and quarantine.

Every line is in a block, in quarantine with its reason, or blank. Nothing is attributed to a guessed speaker: after a
malformed header, lines are orphaned until the next valid one. One source's lines are one window, sources are spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import text
from dialoom.operators import speakers

PARSER_VERSION = "transcript-txt-v2"
S = text.SPACE
CANDIDATE = f"(?U)^[{S}]*\\[[{S}]*\\d"
HEADER = f"(?Us)^[{S}]*\\[[{S}]*(\\d{{1,3}}:\\d{{2}}(?::\\d{{2}})?)[{S}]*\\][{S}]*([^{S}].*)\\z"


@dataclass
class Parsed:
    """The frames a parser gives for any number of sources."""

    utterances: DataFrame  # source_id, seq, locator columns, speaker_raw, text
    quarantine: DataFrame  # source_id, phase, line_no, reason, raw
    counts: DataFrame  # source_id, counter, n
    speakers: DataFrame  # source_id, speaker, n
    errors: DataFrame  # source_id, error


def unarchived(raw: Column) -> Column:
    """Archived Markdown: literal breaks become line ends, bold headers lose their stars, entities are decoded."""
    broken = F.regexp_replace(raw, "(?i)<br[\\s\\x1c-\\x1f\\x85\\xa0]*/?>", "\n")
    bare = F.regexp_replace(broken, f"(?Umd)^([{S}]*)\\*\\*(\\[[{S}]*\\d.*)\\*\\*([{S}]*)$", "$1$2$3")
    return text.unescape(bare)


def ascii_digits(stamp: Column) -> Column:
    """Decimal digits of any script as 0-9: those below U+FFFF come in runs of ten that start at a multiple of two."""
    starts = [0x660, 0x6F0, 0x7C0, 0x966, 0x9E6, 0xA66, 0xAE6, 0xB66, 0xBE6, 0xC66, 0xCE6, 0xD66, 0xE50, 0xED0, 0xF20, 0x1040, 0xFF10]
    return F.translate(stamp, "".join(chr(s + i) for s in starts for i in range(10)), "0123456789" * len(starts))


def numbered_lines(texts: DataFrame, column: str = "text") -> DataFrame:
    """(source_id, line_no, raw) for each line of ``column``."""
    return texts.select("source_id", F.posexplode(text.split_lines(F.col(column))).alias("pos", "raw")).select("source_id", (F.col("pos") + 1).alias("line_no"), text.rstrip(F.col("raw")).alias("raw"))


def segmented(lines: DataFrame) -> DataFrame:
    """Adds ``hdr``, ``bad``, ``seq`` (of the block) and ``state`` (h: in a block, m: after a malformed header)."""
    flagged = lines.withColumn("candidate", F.col("raw").rlike(CANDIDATE)).withColumn("hdr", F.col("candidate") & F.col("raw").rlike(HEADER)).withColumn("bad", F.col("candidate") & ~F.col("hdr"))
    upto = W.partitionBy("source_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    event = F.when(F.col("hdr"), "h").when(F.col("bad"), "m")
    return flagged.withColumns({"seq": F.sum(F.col("hdr").cast("int")).over(upto), "state": F.last(event, ignorenulls=True).over(upto)})


def stray_lines(lines: DataFrame) -> DataFrame:
    """Lines of ``segmented`` outside any block, with the reason."""
    reason = F.when(F.col("bad"), "malformed_header").when(F.col("state").isNull(), "text_before_first_header").otherwise("orphaned_body_after_malformed_header")
    stray = lines.where((text.strip(F.col("raw")) != "") & (F.col("bad") | (~F.col("candidate") & ~F.col("state").eqNullSafe("h"))))
    return stray.select("source_id", F.lit(0).alias("phase"), "line_no", reason.alias("reason"), text.strip(F.col("raw")).alias("raw"))


def blocks(lines: DataFrame) -> DataFrame:
    """(source_id, seq, line_no, timestamp, speaker_raw, text) of the blocks of ``segmented`` lines."""
    inside = lines.where(F.col("hdr") | (~F.col("candidate") & F.col("state").eqNullSafe("h")))
    composed = inside.withColumn("composed", text.nfc(F.col("raw")))
    body = F.transform(F.sort_array(F.collect_list(F.when(~F.col("hdr"), F.struct("line_no", "composed")))), lambda x: x["composed"])
    made = composed.groupBy("source_id", "seq").agg(F.min("line_no").alias("line_no"), F.max(F.when(F.col("hdr"), F.col("raw"))).alias("header"), body.alias("body"))
    return made.select("source_id", "seq", "line_no", ascii_digits(F.regexp_extract("header", HEADER, 1)).alias("timestamp"), text.rstrip(F.regexp_extract("header", HEADER, 2)).alias("speaker_raw"), text.merge_lines(F.col("body")).alias("text"))


def with_disposition(resolved: DataFrame, target: Column) -> DataFrame:
    """What becomes of a block; an empty body comes before the question who speaks."""
    return resolved.withColumn("disposition", F.when(F.col("text") == "", "quarantined").when(F.col("kind") == "non_dialogue", "excluded_non_dialogue").when(F.col("kind") == "unknown", "excluded_unknown_speaker").when(F.col("persona_id") != target, "excluded_other_persona").otherwise("target"))


def parse(sources: DataFrame, aliases: DataFrame) -> Parsed:
    """``sources``: (source_id, target, content)."""
    valid = F.is_valid_utf8(F.col("content"))
    errors = sources.where(~valid).select("source_id", F.lit("not valid UTF-8").alias("error"))
    texts = sources.where(valid).select("source_id", "target", unarchived(F.decode("content", "UTF-8")).alias("text"))
    return parse_texts(texts, aliases, errors)


def parse_texts(texts: DataFrame, aliases: DataFrame, errors: DataFrame) -> Parsed:
    raw = numbered_lines(texts)
    lines = segmented(raw)
    made = blocks(lines)
    resolved = speakers.resolve(made, aliases).join(texts.select("source_id", "target"), "source_id")
    decided = with_disposition(resolved, F.col("target"))
    stray = stray_lines(lines)
    empty = decided.where("disposition = 'quarantined'").select("source_id", F.lit(1).alias("phase"), "line_no", F.lit("empty_body").alias("reason"), F.format_string("[%s] %s", "timestamp", "speaker_raw").alias("raw"))
    quarantine = stray.unionByName(empty)
    one = lambda rows, name: rows.groupBy("source_id").agg(F.count("*").alias("n")).select("source_id", F.lit(name).alias("counter"), "n")
    counts = one(raw, "input_lines").unionByName(one(made, "blocks_total")).unionByName(one(quarantine, "quarantined"))
    kinds = decided.where("disposition <> 'quarantined'").groupBy("source_id", F.col("disposition").alias("counter")).agg(F.count("*").alias("n"))
    target = decided.where("disposition = 'target'")
    locator = F.struct(F.col("line_no").cast("long").alias("line"), "timestamp", text.clock_seconds(F.col("timestamp")).cast("long").alias("timestamp_seconds"))
    utterances = target.select("source_id", "seq", locator.alias("source_locator"), text.normalize(F.col("speaker_raw")).alias("speaker_raw"), F.col("target").alias("speaker_normalized"), "text", F.format_string("%s-t%05d-%04d", "source_id", text.clock_seconds(F.col("timestamp")), "seq").alias("utterance_id"))
    return Parsed(utterances, quarantine, counts.unionByName(kinds), speakers.speakers_seen(made), errors)
