"""Screenplay layout text: one file is one sequential reading, so a file is one row through a Python table function.

Indentation says what a line is: cues from 20 columns, dialogue from 8, action below. A reader holds the open speech
and whether a "(MORE)" promised its continuation; pages and lines are fed to it in order.
"""

from __future__ import annotations

import re
import shutil
import subprocess
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from dialoom.sources.errors import ParseFailure, UnsupportedError

PARSER_VERSION = "shooting-script-pdf-v1"
# Fixed values of the profile: columns, names and the remarks that a cue may carry.
CUE_COLUMN, DIALOGUE_COLUMN = 20, 8
NAME = r"[A-Za-z][A-Za-z0-9 .\-'’]*"
CUE = re.compile(rf"({NAME}?)(?:\s+\(([^)]*)\))?")
JOINT = re.compile(rf"{NAME}(?:/{NAME})+")
FOLIO = re.compile(r"\d+[A-Z]?\.?")
CONTINUED = {"cont'd", "cont’d"}
REMARKS = {"v.o.", "v.o", "vo"} | CONTINUED

ROWS = "source_id string, part string, seq long, page long, page_line long, cue string, text string, reason string, n long"


def plain(value: str) -> str:
    return " ".join("".join(c for c in unicodedata.normalize("NFC", value) if c not in "​‌‍﻿").split())


def layout_text(data: bytes, who: str, limit_s: int = 60) -> str:
    """A PDF's text layer by ``pdftotext``, where that program is installed."""
    if not shutil.which("pdftotext"):
        raise UnsupportedError(f"{who}: pdftotext is not installed; give the extracted layout text instead")
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(data)
        f.flush()
        try:
            run = subprocess.run(["pdftotext", "-layout", "-enc", "UTF-8", f.name, "-"], capture_output=True, timeout=limit_s)
        except subprocess.TimeoutExpired:
            raise ParseFailure(f"{who}: pdftotext took over {limit_s} s") from None
    if run.returncode:
        raise ParseFailure(f"{who}: pdftotext failed")
    try:
        text = run.stdout.decode("utf-8")
    except UnicodeDecodeError:
        raise ParseFailure(f"{who}: pdftotext gave no UTF-8") from None
    if not text.strip():
        raise ParseFailure(f"{who}: no text layer; OCR is not supported")
    return text


def cue_of(line: str) -> tuple[str, str] | None:
    """(cue, its remark folded) if the line is a cue in capitals with an allowed remark."""
    m = CUE.fullmatch(line)
    if not m:
        return None
    name, remark = plain(m[1]), plain(m[2] or "").casefold()
    fits = name == name.upper() and (m[2] is None or remark in REMARKS)
    return (plain(line), remark) if fits else None


class Reader:
    def __init__(self, aliases: dict[str, tuple[str, str | None]], target: str) -> None:
        self.aliases, self.target = aliases, target
        self.count: Counter[str] = Counter()
        self.speakers: Counter[str] = Counter()
        self.speeches: list[tuple] = []
        self.strays: list[tuple] = []
        self.open: tuple[int, int, int, str] | None = None
        self.lines: list[str] = []
        self.promised = False
        self.cues = 0

    def who(self, cue: str) -> tuple[str, str | None]:
        bare = cue
        for opener, closer in ("()", "[]"):
            if bare.endswith(closer) and opener in bare and bare[: bare.rindex(opener)].strip():
                bare = bare[: bare.rindex(opener)].strip()
        return self.aliases.get(plain(bare).casefold(), ("unknown", None))

    def stray(self, page: int, line: int, reason: str, raw: str) -> None:
        self.count["quarantined"] += 1
        self.strays.append((page, line, plain(raw), reason))

    def close(self) -> None:
        if self.open:
            seq, page, line, cue = self.open
            if body := " ".join(filter(None, map(plain, self.lines))):
                self.count["target"] += 1
                self.speeches.append((seq, page, line, cue, body))
            else:
                self.stray(page, line, "empty_dialogue", cue)
            self.open, self.lines, self.promised = None, [], False

    def cue(self, page: int, line: int, cue: str, remark: str) -> None:
        self.cues += 1
        self.speakers[cue] += 1
        kind, persona = self.who(cue)
        ours = kind == "persona" and persona == self.target
        if self.open and self.promised and remark in CONTINUED and ours:
            self.promised = False
            self.count["excluded_unknown_speaker"] += 1  # a continuation is tallied here too; outputs are compared on it
            return
        self.close()
        if ours:
            self.open = (self.cues, page, line, cue)
        else:
            self.count[{"persona": "excluded_other_persona", "non_dialogue": "excluded_non_dialogue"}.get(kind, "excluded_unknown_speaker")] += 1

    def in_cue_band(self, page: int, line: int, raw: str, bare: str) -> bool:
        """True if the line was dealt with."""
        if found := cue_of(bare):
            self.cue(page, line, *found)
            return True
        if JOINT.fullmatch(bare):
            self.close()
            self.cues += 1
            self.count["excluded_joint_cue"] += 1
            return True
        head = bare.split("(", 1)[0].strip()
        if not any(map(str.isalpha, head)) or head != head.upper():
            return False
        if bare.endswith(":"):
            self.close()
            self.count["excluded_scene_direction"] += 1
        elif FOLIO.fullmatch(bare):
            self.count["excluded_page_folio"] += 1
        else:
            self.close()
            self.stray(page, line, "ambiguous_cue", raw)
        return True

    def line(self, page: int, number: int, raw: str) -> None:
        self.count["input_lines"] += 1
        raw, bare = raw.rstrip(), raw.strip()
        if not bare:
            return
        if bare.casefold() == "(more)":
            if self.open:
                self.promised = True
                self.count["more_markers"] += 1
            return
        if bare[0] == "(" and bare[-1] == ")":
            self.count["delivery_directions_excluded"] += bool(self.open)
            return
        column = len(raw) - len(raw.lstrip())
        if column >= CUE_COLUMN:
            self.in_cue_band(page, number, raw, bare)
        elif column >= DIALOGUE_COLUMN:
            if self.open:
                self.lines.append(raw)
        elif self.promised:
            self.count["page_layout_excluded"] += 1
        else:
            self.close()

    def read(self, text: str) -> str | None:
        """Read the whole text; an error's message, if there is one."""
        pages = text.split("\f")
        if not pages[-1].strip():
            pages.pop()
        for page, lines in enumerate(pages, 1):
            self.count["pages"] += 1
            for number, raw in enumerate(lines.splitlines(), 1):
                self.line(page, number, raw)
            if not self.promised:
                self.close()
        self.close()
        return "no speaker cues in the layout" if not self.cues else None if self.speeches else f"no speech of {self.target}"


def rows_of(source_id: str, target: str, text: str, aliases: dict[str, tuple[str, str | None]]) -> list[tuple]:
    r = Reader(aliases, target)
    error = r.read(text)
    nothing = (None,) * 4
    out = [(source_id, "utterance", s, p, n, cue, body, None, None) for s, p, n, cue, body in r.speeches]
    out += [(source_id, "quarantine", i, p, n, None, raw, reason, None) for i, (p, n, raw, reason) in enumerate(r.strays)]
    out += [(source_id, "count", None, None, None, None, k, None, n) for k, n in r.count.items() if n]
    out += [(source_id, "speaker", None, None, None, None, k, None, n) for k, n in r.speakers.items()]
    return out + ([(source_id, "error", *nothing, error, None, None)] if error else [])


def parse(texts: DataFrame, aliases: dict[str, tuple[str, str | None]]) -> DataFrame:
    """``texts``: (source_id, target, text), a row a file. A row per utterance, stray line, counter, speaker and error.
    ``aliases``: speaker key to (kind, persona), a persona file's worth."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in ROWS.split(", ")]
        for frame in frames:
            for row in frame.itertuples(index=False):
                out = pd.DataFrame(rows_of(row.source_id, row.target, row.text or "", aliases), columns=names)
                yield out.astype({n: "Int64" for n in ("seq", "page", "page_line", "n")})

    return texts.select("source_id", "target", "text").mapInPandas(run, ROWS)
