"""Versions: digests of canonical JSON over whatever shapes an output. A handful of values a source, made on the driver."""

from __future__ import annotations

import hashlib
import json

SCHEME = "ds1"


def canonical(value: object) -> str:
    """JSON with sorted keys, no blanks, nothing escaped beyond need."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def bytes_digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def dataset_version(parser_version: str, persona_digest: str, manifest_digest: str, annotation_digest: str | None = None) -> str:
    """Of one source. Reviewed subtitles have the annotations' digest as an input as well."""
    parts = {"scheme": SCHEME, "parser_version": parser_version, "persona_config_digest": persona_digest, "manifest_digest": manifest_digest}
    if annotation_digest is not None:
        parts["annotation_digest"] = annotation_digest
    return f"{SCHEME}-{digest(parts)[:16]}"


def corpus_version(by_source: dict[str, str]) -> str:
    return f"{SCHEME}corpus-{digest(by_source)[:16]}"
