"""Commands: ingest, audit, smi-prepare, smi-review, smi-export, wiki-extract. Exit codes: 0 done, 2 configuration,
3 gate, 4 no parser, 5 parse failure."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from dialoom.session import local_session
from dialoom.sources.errors import CorpusError


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dialoom")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for x in paths:
            p.add_argument(f"--{x}", type=Path, required=True)
        return p

    p = command("ingest", "private-root", "personas", "out")
    one = p.add_mutually_exclusive_group(required=True)
    one.add_argument("--manifest", type=Path)
    one.add_argument("--manifest-dir", type=Path)
    p.add_argument("--parquet", action="store_true")
    p.add_argument("--today")
    command("audit", "corpus", "out").add_argument("--short-text-max", type=int, default=20)
    command("smi-prepare", "manifest", "private-root", "out")
    p = command("smi-review", "prepared", "annotations")
    p.add_argument("--subtitle-id")
    p.add_argument("--segments", help="JSON list of start_char, end_char and label; without it, cues are listed")
    command("smi-export", "prepared", "annotations", "personas", "out").add_argument("--format", choices=("jsonl", "paste"), default="jsonl")
    command("wiki-extract", "input-root", "out").add_argument("--format", choices=("jsonl", "paste"), default="jsonl")
    return top


def run(a: argparse.Namespace) -> str:
    spark = local_session(f"dialoom {a.command}", shuffle_partitions=4)
    if a.command == "ingest":
        from dialoom.plans.ingest import ingest, today_of
        from dialoom.sources.manifest import load_manifest, load_manifests, load_personas

        manifests = [load_manifest(a.manifest)] if a.manifest else load_manifests(a.manifest_dir)
        report = ingest(spark, manifests, a.private_root, load_personas(a.personas), a.out, today_of(a.today), a.parquet)
        return json.dumps(report["totals"])
    if a.command == "audit":
        from dialoom.plans import corpus_audit

        return json.dumps(corpus_audit.write(spark, a.corpus, a.out, a.short_text_max)["totals"])
    if a.command == "wiki-extract":
        from dialoom.plans import wiki_extract

        if a.format == "jsonl":
            return json.dumps(wiki_extract.write(spark, a.input_root, a.out)["totals"])
        return _written(a.out, wiki_extract.markdown(spark, a.input_root))
    from dialoom.plans import subtitles

    if a.command == "smi-prepare":
        return json.dumps(subtitles.prepare(spark, a.manifest, a.private_root, a.out))
    if a.command == "smi-review":
        if a.segments:
            subtitles.annotate(spark, a.prepared, a.annotations, a.subtitle_id, json.loads(a.segments))
        return json.dumps(subtitles.listing(spark, a.prepared, a.annotations), ensure_ascii=False)
    if a.format == "jsonl":
        return subtitles.export(spark, a.prepared, a.annotations, a.personas, a.out)
    return _written(a.out, subtitles.pasted(spark, a.prepared, a.annotations, a.personas))


def _written(out: Path, text: str) -> str:
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text(text, encoding="utf-8", newline="\n")
    return str(out)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        print(run(args))
    except CorpusError as e:
        print(f"error: {e}", file=sys.stderr)
        return e.code if args.command == "ingest" else 2
    except (OSError, KeyError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
