"""Subtitle work: prepare a file for review, keep annotations, export what was labelled."""

from __future__ import annotations

import json
import os
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import digests
from dialoom.operators import subtitles
from dialoom.plans import publish
from dialoom.plans.corpus_audit import json_object, json_rows
from dialoom.plans.ingest import SCHEMA_VERSION
from dialoom.sources import scan
from dialoom.sources.errors import ConfigError, ParseFailure
from dialoom.sources.manifest import load_manifest, load_personas

SEGMENTS = "array<struct<start_char:long,end_char:long,label:string,review_state:string>>"
ENTRY = f"subtitle_id string, text_sha256 string, segments {SEGMENTS}"


def prepare(spark: SparkSession, manifest: Path, root: Path, out: Path, today: date | None = None) -> dict:
    m = load_manifest(manifest)
    if m.input_type != "subtitle_smi":
        raise ConfigError(f"{m.source_id}: input_type must be subtitle_smi")
    m.check_retention(today or date.today())
    cues, errors = subtitles.parse(scan.verified(spark, [(m.source_id, m.path_below(root), m.sha256)]))
    if bad := errors.first():
        raise ParseFailure(f"{bad.source_id}: {bad.error}")
    metadata = {"schema_version": "1", "parser_version": subtitles.PARSER_VERSION, "source_id": m.source_id, "source_sha256": m.sha256, "manifest_digest": m.digest, "character_id": m.character_id, "series": m.series, "episode": m.episode, "language": m.language, "input_type": m.input_type}
    out.mkdir(parents=True, exist_ok=True)
    publish.pretty_json(out / "source.json", metadata)
    publish.json_lines(out / "subtitles.jsonl", (r.asDict() for r in cues.drop("source_id").orderBy("subtitle_id").toLocalIterator()))
    return metadata


def load_prepared(spark: SparkSession, folder: Path) -> tuple[dict, DataFrame]:
    return json_object(folder / "source.json"), json_rows(spark, [folder / "subtitles.jsonl"], scan.CUE)


def load_annotations(path: Path, metadata: dict) -> dict:
    """The annotation document; an empty one where there is no file yet."""
    if not path.exists():
        return {"schema_version": "1", "source_id": metadata["source_id"], "source_sha256": metadata["source_sha256"], "parser_version": metadata["parser_version"], "subtitles": {}}
    doc = json_object(path)
    if doc.get("source_sha256") != metadata["source_sha256"]:
        raise ConfigError(f"{path}: stale, made for another source")
    return doc


def entries(spark: SparkSession, doc: dict) -> DataFrame:
    return spark.createDataFrame([(k, v.get("text_sha256"), v.get("segments")) for k, v in sorted(doc.get("subtitles", {}).items())], ENTRY)


def annotate(spark: SparkSession, prepared: Path, path: Path, subtitle_id: str, segments: list[dict]) -> dict:
    """Label one cue. Writers of one file must take turns; the file itself is replaced at once."""
    metadata, cues = load_prepared(spark, prepared)
    cue = cues.where(F.col("subtitle_id") == subtitle_id).first()
    if cue is None:
        raise KeyError(subtitle_id)
    if cue.is_clear:
        raise ConfigError("a clear cue can't be labelled")
    new = spark.createDataFrame([(subtitle_id, digests.bytes_digest(cue.visible_text.encode()), segments, cue.visible_text)], f"{ENTRY}, visible_text string")
    if not new.where(subtitles.segments_valid(F.col("visible_text"), F.col("segments"))).count():
        raise ConfigError("segments must be known labels over ranges that cover the cue in order")
    doc = load_annotations(path, metadata)
    after = subtitles.upsert(entries(spark, doc), new.drop("visible_text").withColumn("segments", subtitles.reviewed(F.col("segments"))))
    doc["subtitles"] = {r.subtitle_id: {"text_sha256": r.text_sha256, "segments": [s.asDict() for s in r.segments]} for r in after.collect()}
    staged = path.with_name(f".{path.name}.{os.getpid()}")
    publish.pretty_json(staged, doc)
    staged.replace(path)
    return doc


def exported(spark: SparkSession, prepared: Path, annotations: Path, personas: Path, target: str = "gintoki") -> tuple[dict, str, DataFrame]:
    """(metadata, dataset version, a row per segment) of a completely labelled source."""
    metadata, cues = load_prepared(spark, prepared)
    notes = entries(spark, load_annotations(annotations, metadata))
    if bad := subtitles.incomplete(cues, notes).orderBy("subtitle_id").first():
        raise ConfigError(f"{bad.subtitle_id}: annotation {bad.reason}")
    config = load_personas(personas)
    if metadata["character_id"] not in config.ids:
        raise ConfigError("the persona file lacks the prepared character_id")
    version = digests.dataset_version(metadata["parser_version"], config.digest, metadata["manifest_digest"], digests.bytes_digest(annotations.read_bytes()))
    return metadata, version, subtitles.export(cues, notes, target)


def export(spark: SparkSession, prepared: Path, annotations: Path, personas: Path, out: Path, target: str = "gintoki") -> str:
    metadata, version, rows = exported(spark, prepared, annotations, personas, target)
    source = metadata["source_id"]
    common = {"dataset_version": version, "parser_version": metadata["parser_version"], "schema_version": SCHEMA_VERSION, "source_id": source, "source_sha256": metadata["source_sha256"]}
    said, strays, counts = [], [], {}
    for r in rows.orderBy("subtitle_id", "n").toLocalIterator():
        kind = "quarantined" if r.disposition in {"invalid_timing", "empty_segment"} else r.disposition.removeprefix("excluded_")
        counts[kind] = counts.get(kind, 0) + 1
        if kind == "quarantined":
            strays.append(common | {"line_no": r.source_line, "reason": r.disposition, "raw": r.text})
        elif kind == "target":
            at = {k: r[k] for k in ("subtitle_id", "start_ms", "end_ms", "source_line")} | {"start_char": r.segment.start_char, "end_char": r.segment.end_char}
            said.append(common | {k: metadata[k] for k in ("character_id", "series", "episode", "language")} | {"source_locator": at, "speaker_raw": f"reviewed:{target}", "speaker_normalized": target, "text": r.text, "utterance_id": f"{source}-{r.subtitle_id}-{r.n:02d}"})
    for folder in ("parsed", "quarantine", "reports"):
        (out / folder).mkdir(parents=True, exist_ok=True)
    publish.json_lines(out / "parsed" / f"{source}.jsonl", said)
    publish.json_lines(out / "quarantine" / f"{source}.jsonl", strays)
    publish.pretty_json(out / "reports" / f"{source}.json", {"source_id": source, "character_id": metadata["character_id"], "parser_version": metadata["parser_version"], "counts": counts, "speakers_seen": {}})
    corpus = digests.corpus_version({source: version})
    sizes = {"target": len(said), "quarantined": len(strays)}
    publish.pretty_json(out / "run_report.json", {"dataset_version": corpus, "sources": [{"source_id": source, "dataset_version": version} | sizes], "totals": {k: v for k, v in sizes.items()}})
    return corpus


def pasted(spark: SparkSession, prepared: Path, annotations: Path, personas: Path, target: str = "gintoki") -> str:
    _, _, rows = exported(spark, prepared, annotations, personas, target)
    return "".join(f"{target}: {r.text}\n" for r in rows.where("disposition = 'target'").orderBy("subtitle_id", "n").toLocalIterator())


def listing(spark: SparkSession, prepared: Path, annotations: Path) -> list[dict]:
    metadata, cues = load_prepared(spark, prepared)
    rows = subtitles.cue_list(cues, entries(spark, load_annotations(annotations, metadata))).orderBy("subtitle_id")
    return [json.loads(r.j) for r in rows.select(F.to_json(F.struct("subtitle_id", "start_ms", "end_ms", "visible_text", "timing_issue", "label")).alias("j")).collect()]
