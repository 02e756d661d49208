"""Outputs: canonical JSON lines, and folders that appear whole or not at all."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import digests
from dialoom.sources.errors import ConfigError


def json_column(columns: list[str]) -> Column:
    """Canonical JSON of a row: keys in order, nulls kept. Rows with control characters need ``json_lines``."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def json_lines(path: Path, rows: Iterable[dict]) -> int:
    n = 0
    with path.open("w", encoding="utf-8", newline="\n") as f:
        for row in rows:
            f.write(digests.canonical(row) + "\n")
            n += 1
    return n


def pretty_json(path: Path, value: object) -> None:
    path.write_text(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8", newline="\n")


def scaled_json_lines(df: DataFrame, path: str, by: str = "source_id") -> None:
    """The same lines written by the executors, a folder per source, for corpora beyond one machine."""
    df.select(by, json_column(df.columns).alias("value")).write.partitionBy(by).text(path)


def replaceable(out: Path, known: set[str], empty_ok: bool = True, exact: bool = False) -> None:
    """Refuse to replace a folder that isn't one of our own outputs."""
    if not out.exists():
        return
    if not out.is_dir():
        raise ConfigError(f"{out} is no folder")
    names = {p.name for p in out.iterdir()}
    ours = names == known if exact else known <= names
    if not ours and not (empty_ok and not names):
        raise ConfigError(f"{out} holds something else")


def disjoint(a: Path, b: Path) -> None:
    a, b = a.resolve(), b.resolve()
    if a.is_relative_to(b) or b.is_relative_to(a):
        raise ConfigError(f"{a} and {b} overlap")


def publish(out: Path, write: Callable[[Path], None]) -> None:
    """Write beside ``out``, then swap by renames; what was there before returns if the swap fails."""
    out.parent.mkdir(parents=True, exist_ok=True)
    staged, old = (out.parent / f".{out.name}.{kind}-{os.getpid()}" for kind in ("tmp", "old"))
    for leftover in (staged, old):
        shutil.rmtree(leftover, ignore_errors=True)
    staged.mkdir()
    try:
        write(staged)
        if out.exists():
            out.rename(old)
        try:
            staged.rename(out)
        except OSError:
            if old.exists():
                old.rename(out)
            raise
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    shutil.rmtree(old, ignore_errors=True)
