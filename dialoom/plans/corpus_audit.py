"""The audit of an ingested corpus, as a report and a list of candidates."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import digests
from dialoom.operators import audit
from dialoom.plans import publish
from dialoom.sources import scan
from dialoom.sources.errors import ConfigError

AUDIT_VERSION, SCHEMA = "quality-audit-v1", "1"
FILES = {"quality_report.json", "review_candidates.jsonl"}


def json_object(path: Path) -> dict:
    try:
        value = json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ConfigError(f"{path}: {e}") from e
    if not isinstance(value, dict):
        raise ConfigError(f"{path}: no JSON object")
    return value


def json_rows(spark: SparkSession, paths: list[Path], schema) -> DataFrame:
    """JSON lines by an explicit schema; a line that doesn't parse is named in the error."""
    for path in paths:
        try:
            with path.open(encoding="utf-8") as f:
                for n, line in enumerate(f, 1):
                    if not isinstance(json.loads(line), dict):
                        raise ConfigError(f"{path}:{n}: no JSON object")
        except ValueError as e:
            raise ConfigError(f"{path}:{n}: {e}") from e
        except OSError as e:
            raise ConfigError(f"{path}: {e}") from e
    return spark.read.schema(schema).json([str(p) for p in paths]) if paths else spark.createDataFrame([], schema)


def build(spark: SparkSession, corpus: Path, short_text_max: int = audit.SHORT) -> tuple[dict, list[dict]]:
    if short_text_max < 0:
        raise ConfigError("--short-text-max can't be negative")
    run = json_object(corpus / "run_report.json")
    listed = run.get("sources")
    if not isinstance(listed, list) or not all(isinstance(s, dict) and isinstance(s.get("source_id"), str) and s["source_id"] and isinstance(s.get("dataset_version"), str) for s in listed):
        raise ConfigError("run_report.json: sources must name source_id and dataset_version")
    listed = sorted(listed, key=lambda s: s["source_id"])
    ids = [s["source_id"] for s in listed]
    if len(set(ids)) < len(ids):
        raise ConfigError("run_report.json: a source is listed twice")
    for s in listed:
        if wrong := [c for c in ("target", "quarantined") if not isinstance(s.get(c), int)]:
            raise ConfigError(f"run_report.json: {s['source_id']}: {wrong[0]} is no whole number")
    if digests.corpus_version({s["source_id"]: s["dataset_version"] for s in listed}) != run.get("dataset_version"):
        raise ConfigError("run_report.json: dataset_version isn't that of its sources")
    declared = spark.createDataFrame([(s["source_id"], s["dataset_version"], s.get("target"), s.get("quarantined")) for s in listed], "source_id string, dataset_version string, target long, quarantined long")
    file_of = F.regexp_extract(F.input_file_name(), "([^/]+)\\.jsonl$", 1)
    said = json_rows(spark, [corpus / "parsed" / f"{s}.jsonl" for s in ids], scan.UTTERANCE).withColumn("__file", file_of)
    schema = scan.QUARANTINE.__class__([f for f in scan.QUARANTINE if f.name != "raw"])  # the audit never reads raw lines
    strays = json_rows(spark, [corpus / "quarantine" / f"{s}.jsonl" for s in ids], schema).withColumn("__file", file_of)
    for what, rows, column in (("utterances", said, "target"), ("quarantine rows", strays, "quarantined")):
        if bad := audit.mismatched(rows, declared).select("source_id").first():
            raise ConfigError(f"{what} of {bad.source_id!r} have another source or version than declared")
        if bad := audit.miscounted(rows, declared, column).orderBy("source_id").first():
            raise ConfigError(f"{bad.source_id}: {bad.declared} {what} declared, {bad.actual} found")
    located = said.withColumn("safe", audit.safe_locator())
    if located.where("safe is null or text is null or coalesce(utterance_id, '') = ''").limit(1).count():
        raise ConfigError("an utterance lacks its id, its text or a known locator")
    flagged = audit.utterance_candidates(located, short_text_max)
    summary = {r.source_id: r.asDict() for r in audit.summary(said, declared, strays, short_text_max).collect()}
    by_reason: dict[str | None, dict[str, int]] = {}
    for r in audit.reason_rollup(strays).orderBy("reason").collect():
        by_reason.setdefault(r.source_id, {})[r.reason] = r.n
    totals = audit.duplicate_totals(said).first()
    candidates = [{"candidate_type": "quarantine", "dataset_version": r.dataset_version, "line_no": r.line_no, "reason": r.reason, "source_id": r.source_id} for r in strays.toLocalIterator()]
    candidates += [{"candidate_type": "utterance", "char_count": r.char_count, "dataset_version": r.dataset_version, "duplicate_count": r.duplicate_count, "reasons": list(r.reasons), "source_id": r.source_id, "source_locator": json.loads(r.safe), "text_sha256": r.text_sha256, "utterance_id": r.utterance_id} for r in flagged.toLocalIterator()]
    candidates.sort(key=lambda c: (c["source_id"], c["candidate_type"], c.get("line_no", 0), c.get("utterance_id", "")))
    report = {
        "audit_version": AUDIT_VERSION, "schema_version": SCHEMA, "corpus_dataset_version": run["dataset_version"], "short_text_max": short_text_max,
        "sources": [{"source_id": v["source_id"], "dataset_version": v["dataset_version"], "utterances": n["utterances"], "quarantine": n["quarantine"], "quarantine_reasons": by_reason.get(v["source_id"], {}), "duplicate_utterances": n["exact_duplicate"], "short_utterances": n["short_text"]} for v in listed for n in [summary[v["source_id"]]]],
        "text_length_buckets": {r.bucket: r.n for r in audit.length_buckets(said).orderBy("position").collect()},
        "totals": {"sources": len(ids), "utterances": sum(v["utterances"] for v in summary.values()), "quarantine": sum(v["quarantine"] for v in summary.values()), "short_utterances": sum(v["short_text"] for v in summary.values()), "exact_duplicate_groups": totals.duplicate_groups, "exact_duplicate_utterances": totals.duplicate_utterances, "review_candidates": len(candidates)},
        "quarantine_reasons": by_reason.get(None, {}),
    }
    return report, candidates


def write(spark: SparkSession, corpus: Path, out: Path, short_text_max: int = audit.SHORT) -> dict:
    publish.disjoint(corpus, out)
    publish.replaceable(out, FILES, exact=True)
    report, candidates = build(spark, corpus, short_text_max)

    def files(at: Path) -> None:
        publish.json_lines(at / "review_candidates.jsonl", candidates)
        publish.pretty_json(at / "quality_report.json", report)

    publish.publish(out, files)
    return report
