"""Manifests and persona files: small control-plane YAML, read and checked on the driver."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from datetime import date, datetime
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from dialoom.functions import digests
from dialoom.sources.errors import ConfigError, GateError

# Fixed values of the manifest format.
REQUIRED = ("source_id", "character_id", "series", "episode", "input_type", "language", "rights_status", "file", "sha256", "parser_profile")
INPUT_TYPES = {"transcript_txt", "script_pdf", "subtitle_smi"}
RIGHTS = {"synthetic", "licensed", "private_unverified"}
VERSIONED = ("character_id", "series", "episode", "input_type", "language", "sha256", "parser_profile")


@dataclass(frozen=True)
class Manifest:
    source_id: str
    character_id: str
    series: str
    episode: str
    input_type: str
    language: str
    rights_status: str
    file: str
    sha256: str
    parser_profile: str
    acquired_at: date | None = None
    delete_at: date | None = None

    @property
    def digest(self) -> str:
        return digests.digest({k: getattr(self, k) for k in VERSIONED})

    def path_below(self, root: Path) -> Path:
        return contained(root, self.file, self.source_id)

    def check_retention(self, today: date) -> None:
        """The last day is still allowed."""
        if self.delete_at and today > self.delete_at:
            raise GateError(f"{self.source_id}: retention ended on {self.delete_at.isoformat()}")


def contained(root: Path, relative: str, who: str, error: type[Exception] = GateError) -> Path:
    base = root.resolve()
    path = (base / relative).resolve()
    if not path.is_relative_to(base):
        raise error(f"{who}: {relative!r} leaves {base}")
    return path


def as_date(value: object, name: str, who: str) -> date | None:
    if isinstance(value, datetime):
        raise ConfigError(f"{who}: {name} has a time of day")
    if value is None or isinstance(value, date):
        return value
    try:
        return date.fromisoformat(value.strip()) if isinstance(value, str) else date.fromisoformat("")
    except ValueError:
        raise ConfigError(f"{who}: {name} is no ISO date: {value!r}") from None


def _yaml(path: Path) -> dict:
    try:
        value = yaml.safe_load(path.read_text(encoding="utf-8"))
    except (OSError, UnicodeDecodeError, yaml.YAMLError) as e:
        raise ConfigError(f"{path}: {e}") from e
    if not isinstance(value, dict):
        raise ConfigError(f"{path}: not a mapping")
    return value


def load_manifest(path: Path) -> Manifest:
    raw = _yaml(path)
    if absent := [k for k in REQUIRED if k not in raw]:
        raise ConfigError(f"{path}: missing {', '.join(absent)}")
    who = raw["source_id"]
    if not isinstance(who, str) or not who.strip():
        raise ConfigError(f"{path}: source_id must be a string with content")
    if "/" in who or "\\" in who or ".." in who:  # it names output files
        raise ConfigError(f"{path}: source_id can't be a path")
    text = {k: str(raw[k]) for k in REQUIRED if k != "source_id"}
    if blank := [k for k, v in text.items() if not v.strip()]:
        raise ConfigError(f"{who}: blank {', '.join(blank)}")
    text["sha256"] = text["sha256"].lower()
    for name, allowed in (("input_type", INPUT_TYPES), ("rights_status", RIGHTS)):
        if text[name] not in allowed:
            raise ConfigError(f"{who}: {name} {text[name]!r} is none of {sorted(allowed)}")
    if not re.fullmatch("[0-9a-f]{64}", text["sha256"]):
        raise ConfigError(f"{who}: sha256 must be 64 hex digits")
    return Manifest(who, *(text[k] for k in REQUIRED[1:]), *(as_date(raw.get(k), k, who) for k in ("acquired_at", "delete_at")))


def load_manifests(folder: Path) -> list[Manifest]:
    found = sorted((load_manifest(p) for p in sorted([*folder.glob("*.yaml"), *folder.glob("*.yml")])), key=lambda m: m.source_id)
    if not found:
        raise ConfigError(f"{folder}: no manifests")
    if twice := {a.source_id for a, b in zip(found, found[1:], strict=False) if a.source_id == b.source_id}:
        raise ConfigError(f"{folder}: source_id used twice: {sorted(twice)}")
    return found


def folded_key(value: str) -> str:
    """The driver's twin of functions.text.speaker_key, for the handful of aliases in a persona file."""
    plain = "".join(c for c in unicodedata.normalize("NFC", value) if c not in "​‌‍﻿")
    return " ".join(plain.split()).casefold()


@dataclass(frozen=True)
class Personas:
    """Who is meant by a speaker's name: alias keys to persona ids, and keys that are no dialogue."""

    aliases: dict[str, str]
    non_dialogue: frozenset[str]
    digest: str = field(default="")

    @property
    def ids(self) -> set[str]:
        return set(self.aliases.values())

    def frame(self, spark: SparkSession) -> DataFrame:
        """The alias dimension: one row a key."""
        rows = [(k, "persona", v) for k, v in sorted(self.aliases.items())] + [(k, "non_dialogue", None) for k in sorted(self.non_dialogue)]
        return spark.createDataFrame(rows, "key string, kind string, persona_id string")


def load_personas(path: Path) -> Personas:
    raw = _yaml(path)
    listed = raw.get("personas")
    if not isinstance(listed, list) or not listed:
        raise ConfigError(f"{path}: personas must be a list with entries")
    aliases: dict[str, str] = {}
    for entry in listed:
        who = entry.get("id") if isinstance(entry, dict) else None
        if not isinstance(who, str) or not who.strip():
            raise ConfigError(f"{path}: a persona needs a string id")
        names = entry.get("aliases") or []
        if not isinstance(names, list) or not all(isinstance(x, str) and folded_key(x) for x in [who, *names]):
            raise ConfigError(f"{path}: aliases of {who!r} must be strings with content")
        for key in map(folded_key, [who, *names]):
            if aliases.setdefault(key, who) != who:
                raise ConfigError(f"{path}: {key!r} belongs to {aliases[key]!r} and {who!r}")
    silent = raw.get("non_dialogue_speakers") or []
    if not isinstance(silent, list):
        raise ConfigError(f"{path}: non_dialogue_speakers must be a list")
    keys = frozenset(k for k in (folded_key(str(x)) for x in silent) if k)
    if both := sorted(keys & aliases.keys()):
        raise ConfigError(f"{path}: persona and non-dialogue at once: {both}")
    return Personas(aliases, keys, digests.bytes_digest(path.read_bytes()))
