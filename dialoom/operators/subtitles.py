"""SAMI subtitles: cues with intervals and offsets, labels of their parts, and the export of labelled parts.

A file's SYNC scan needs code point and byte offsets, so a file is a row through a Python table function; intervals,
labels and the export are DataFrame work.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.functions import text

PARSER_VERSION = "subtitle-smi-v1"
LABELS = ("gintoki", "other", "non_dialogue", "undetermined")
SYNC = re.compile(r"<sync\b[^>]*\bstart\s*=\s*[\"']?(\d+)[^>]*>", re.I)
BLOCKS = "source_id string, ordinal long, start_ms long, source_line long, source_char long, source_byte long, block string, error string"


def sync_blocks(source_id: str, data: bytes) -> list[tuple]:
    try:
        source = data.decode("cp949")
    except UnicodeDecodeError:
        return [(source_id, None, None, None, None, None, None, "not valid CP949")]
    found = list(SYNC.finditer(source))
    if not found:
        return [(source_id, None, None, None, None, None, None, "no SYNC block")]
    out, line, size, at = [], 1, 0, 0
    for i, m in enumerate(found):
        line += source.count("\n", at, m.start())
        size += len(source[at : m.start()].encode("cp949"))
        at = m.start()
        stop = found[i + 1].start() if i + 1 < len(found) else len(source)
        out.append((source_id, i + 1, int(m[1]), line, at, size, html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"(?i)<br\s*/?>", "\n", source[m.end() : stop]))), None))
    return out


def scan(sources: DataFrame) -> DataFrame:
    """``sources``: (source_id, content). A row per SYNC block, or an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in BLOCKS.split(", ")]
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield pd.DataFrame(sync_blocks(row.source_id, bytes(row.content)), columns=names).astype({n: "Int64" for n in names[1:6]})

    return sources.select("source_id", "content").mapInPandas(run, BLOCKS)


def with_intervals(cues: DataFrame, by: str = "source_id", order: str | list[str] = "ordinal", start: str = "start_ms") -> DataFrame:
    """Adds ``end_ms``, the next cue's start unless time runs back, and ``timing_issue``."""
    following = F.lead(start).over(W.partitionBy(by).orderBy(order))
    issue = F.when(following.isNull(), "missing_end").when(following < F.col(start), "time_reversed")
    return cues.withColumn("end_ms", F.when(following >= F.col(start), following)).withColumn("timing_issue", issue)


def visible(block: Column) -> Column:
    """Lines of a block without markup: NBSP as a space, blanks collapsed, empty lines dropped."""
    plain = F.translate(block, "\xa0", " ")
    lines = F.transform(text.split_lines(plain), lambda x: text.strip(F.regexp_replace(x, "[ \\t]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def without_markup(fragment: Column) -> Column:
    """Breaks as line ends, tags gone; entities are left to ``functions.text.unescape``."""
    return F.regexp_replace(F.regexp_replace(fragment, "(?i)<br\\s*/?>", "\n"), "<[^>]+>", "")


def hangul_lines(shown: Column) -> Column:
    return F.array_join(F.filter(F.split(shown, "\n"), lambda x: x.rlike("[가-힣]")), "\n")


def parse(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cues, errors) of any number of files."""
    blocks = scan(sources)
    timed = with_intervals(blocks.where("error is null")).withColumn("visible_text", visible(F.col("block")))
    cues = timed.select("source_id", F.format_string("s%06d", "ordinal").alias("subtitle_id"), "start_ms", "end_ms", "source_line", "source_char", "source_byte", "visible_text", hangul_lines(F.col("visible_text")).alias("korean_text"), (F.col("visible_text") == "").alias("is_clear"), "timing_issue")
    return cues, blocks.where("error is not null").select("source_id", "error")


def segments_valid(shown: Column, segments: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """Segments are known labels over ranges that follow each other from 0 to the text's end, none empty."""
    end = F.aggregate(segments, F.lit(0).cast("long"), lambda at, s: F.when((s["start_char"] == at) & (s["end_char"] > s["start_char"]), s["end_char"].cast("long")).otherwise(F.lit(-1).cast("long")))
    known = F.forall(segments, lambda s: F.coalesce(s["label"].isin(*labels), F.lit(False)))
    return F.coalesce((F.size(segments) > 0) & known & (end == F.length(shown)), F.lit(False))


def reviewed(segments: Column) -> Column:
    return F.transform(segments, lambda s: F.struct(s["start_char"].alias("start_char"), s["end_char"].alias("end_char"), s["label"].alias("label"), F.when(s["label"] == "undetermined", "needs_video").otherwise("confirmed").alias("review_state")))


def incomplete(cues: DataFrame, annotations: DataFrame) -> DataFrame:
    """Cues without a fitting annotation, with the reason: a left join whose misses are errors."""
    joined = cues.where(~F.col("is_clear")).join(annotations, "subtitle_id", "left")
    stale = F.col("text_sha256") != text.digest(F.col("visible_text"))
    reason = F.when(F.col("text_sha256").isNull(), "missing").when(stale, "stale").when(~segments_valid(F.col("visible_text"), F.col("segments")), "invalid")
    return joined.withColumn("reason", reason).where("reason is not null").select("subtitle_id", "reason")


def upsert(annotations: DataFrame, entries: DataFrame, key: str = "subtitle_id") -> DataFrame:
    """Entries replace those of the same key."""
    return annotations.join(entries, key, "left_anti").unionByName(entries)


def cue_list(cues: DataFrame, annotations: DataFrame) -> DataFrame:
    """Cues that show something, with the label of their first segment."""
    return cues.where(~F.col("is_clear")).join(annotations, "subtitle_id", "left").withColumn("label", F.get("segments", F.lit(0))["label"])


def export(cues: DataFrame, annotations: DataFrame, target: str = "gintoki") -> DataFrame:
    """A row per segment: its number, text and what becomes of it. The label is asked before the timing."""
    parts = cues.where(~F.col("is_clear")).join(annotations, "subtitle_id").select(*cues.columns, F.posexplode("segments").alias("pos", "segment"))
    cut = parts.withColumn("text", text.normalize(F.expr("substring(visible_text, segment.start_char + 1, segment.end_char - segment.start_char)")))
    kind = F.when(F.col("segment.label") != target, F.concat(F.lit("excluded_"), F.col("segment.label"))).when(F.col("timing_issue").isNotNull(), "invalid_timing").when(F.col("text") == "", "empty_segment").otherwise("target")
    return cut.select(*cues.columns, (F.col("pos") + 1).alias("n"), "segment", "text", kind.alias("disposition"))
