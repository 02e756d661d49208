import hashlib
import json

import pyarrow as pa
import pytest

from dialoom import cli
from dialoom.operators import audit, screenplay, subtitles, wiki
from dialoom.plans import corpus_audit

SCRIPT = """Title

[00:06] Hero
Hello there.

[00:10] Friend
Hi.

[00:15] H
More
words.

[00:20] Sign
EXIT

[0:33 Hero
lost line

[00:40] Hero (quietly)
[NOTE] still body

[00:50] Hero

[00:55] Nobody
[3 people laugh]
gone
[01:02:07] Hero
١ end
"""
PERSONAS = "personas:\n- id: hero\n  aliases: [H]\n- id: friend\nnon_dialogue_speakers: [Sign]\n"


@pytest.fixture
def source(tmp_path):
    def make(data: bytes = SCRIPT.encode(), profile="transcript-txt", kind="transcript_txt", extra=""):
        (tmp_path / "a.txt").write_bytes(data)
        (tmp_path / "p.yaml").write_text(PERSONAS)
        (tmp_path / "m.yaml").write_text(f"source_id: s1\ncharacter_id: hero\nseries: x\nepisode: '1'\ninput_type: {kind}\nlanguage: en\nrights_status: synthetic\nfile: a.txt\nsha256: {hashlib.sha256(data).hexdigest()}\nparser_profile: {profile}\n{extra}")
        return ["ingest", "--manifest", f"{tmp_path}/m.yaml", "--private-root", str(tmp_path), "--personas", f"{tmp_path}/p.yaml", "--out", f"{tmp_path}/out", "--today", "2030-01-01"]

    return make


def rows(path):
    return [json.loads(x) for x in path.read_text().splitlines()]


def test_transcript(spark, source, tmp_path):
    assert cli.main([*source(), "--parquet"]) == 0
    said = rows(tmp_path / "out/parsed/s1.jsonl")
    assert [(u["source_locator"]["line"], u["text"], u["utterance_id"]) for u in said] == [(3, "Hello there.", "s1-t00006-0001"), (9, "More words.", "s1-t00015-0003"), (19, "[NOTE] still body", "s1-t00040-0005"), (27, "١ end", "s1-t3727-0008".replace("t3727", "t03727"))]
    strays = rows(tmp_path / "out/quarantine/s1.jsonl")
    assert [(q["line_no"], q["reason"]) for q in strays] == [(1, "text_before_first_header"), (16, "malformed_header"), (17, "orphaned_body_after_malformed_header"), (25, "malformed_header"), (26, "orphaned_body_after_malformed_header"), (22, "empty_body"), (24, "empty_body")]
    counts = json.loads((tmp_path / "out/reports/s1.json").read_text())["counts"]
    assert counts == {"input_lines": 28, "blocks_total": 8, "quarantined": 7, "target": 4, "excluded_other_persona": 1, "excluded_non_dialogue": 1}
    first = (tmp_path / "out/parsed/s1.jsonl").read_bytes()
    assert cli.main(source()) == 0
    assert (tmp_path / "out/parsed/s1.jsonl").read_bytes() == first


@pytest.mark.parametrize("change, code", [(dict(profile="nothing"), 4), (dict(kind="script_pdf"), 4), (dict(extra="delete_at: 2029-12-31\n"), 3), (dict(data=b"\xff\xfe"), 5), (dict(extra="acquired_at: x\n"), 2)])
def test_exit_codes_leave_the_output_alone(spark, source, tmp_path, change, code):
    assert cli.main(source()) == 0
    before = (tmp_path / "out/run_report.json").read_bytes()
    assert cli.main(source(**change)) == code
    assert (tmp_path / "out/run_report.json").read_bytes() == before


def test_hash_gate_and_foreign_folder(spark, source, tmp_path):
    args = source()
    (tmp_path / "a.txt").write_bytes(b"changed")
    assert cli.main(args) == 3
    (tmp_path / "out").mkdir()
    (tmp_path / "out/mine").write_text("x")
    assert cli.main(source()) == 2
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["mine"]


def test_audit_of_an_ingested_corpus(spark, source, tmp_path):
    assert cli.main(source()) == 0
    report = corpus_audit.write(spark, tmp_path / "out", tmp_path / "audit")
    assert report["totals"] == {"sources": 1, "utterances": 4, "quarantine": 7, "short_utterances": 4, "exact_duplicate_groups": 0, "exact_duplicate_utterances": 0, "review_candidates": 11}
    assert "Hello there" not in (tmp_path / "audit/review_candidates.jsonl").read_text()
    assert list(report["text_length_buckets"]) == ["0-20", "21-50", "51-100", "101-200", "201+"]
    with pytest.raises(Exception, match="overlap"):
        corpus_audit.write(spark, tmp_path / "out", tmp_path / "out/audit")


def test_short_is_inclusive(spark):
    df = spark.createDataFrame([("a" * 20,), ("a" * 21,), ("\U0001f600" * 20,)], "text string")
    assert [r.x for r in df.select(audit.is_short(df.text).alias("x")).collect()] == [True, False, True]


def layout(*pages):
    return "\f".join("\n".join(p) for p in pages)


def test_screenplay():
    cue, talk = " " * 24, " " * 12
    text = layout([cue + "HERO", talk + "One", talk + "(beat)", cue + "(MORE)"], ["header", cue + "HERO (CONT'D)", talk + "two.", "Action.", talk + "lost", cue + "HERO/FRIEND", talk + "x", cue + "FRIEND", talk + "y", cue + "CUT TO:", cue + "12A.", cue + "12.", cue + "HERO (shouting)", cue + "HERO"])
    out = screenplay.rows_of("s", "hero", text, {"hero": ("persona", "hero"), "friend": ("persona", "friend")})
    assert [r[2:7] for r in out if r[1] == "utterance"] == [(1, 1, 1, "HERO", "One two.")]
    assert [(r[3], r[4], r[7]) for r in out if r[1] == "quarantine"] == [(2, 13, "ambiguous_cue"), (2, 14, "empty_dialogue")]
    counts = {r[6]: r[8] for r in out if r[1] == "count"}
    assert counts["excluded_unknown_speaker"] == 1 and counts["page_layout_excluded"] == 1 and counts["excluded_joint_cue"] == 1 and counts["excluded_scene_direction"] == 1 and counts["excluded_page_folio"] == 1
    assert not any(r[1] == "error" for r in out)
    assert screenplay.rows_of("s", "hero", "nothing", {})[-1][1] == "error"


def test_subtitles(spark):
    body = "<SAMI><SYNC Start=100><P>안녕<br>Hi &amp; you\n<SYNC Start=300><P>&nbsp;<SYNC Start=200><P>끝".encode("cp949")
    cues, errors = subtitles.parse(spark.createDataFrame([("s", bytearray(body)), ("bad", bytearray(b"\xff\xff")), ("none", bytearray(b"x"))], "source_id string, content binary"))
    got = cues.orderBy("subtitle_id").collect()
    assert [(c.start_ms, c.end_ms, c.timing_issue, c.visible_text, c.korean_text, c.is_clear) for c in got] == [(100, 300, None, "안녕\nHi & you", "안녕", False), (300, None, "time_reversed", "", "", True), (200, None, "missing_end", "끝", "끝", False)]
    assert (got[1].source_line, got[1].source_byte - got[1].source_char) == (2, 2)
    assert {r.source_id for r in errors.collect()} == {"bad", "none"}


def test_review_and_export(spark, tmp_path):
    body = "<SYNC Start=0><P>one two<SYNC Start=5><P>&nbsp;<SYNC Start=9><P>end".encode()
    (tmp_path / "a.smi").write_bytes(body)
    (tmp_path / "p.yaml").write_text("personas:\n- id: hero\n")
    (tmp_path / "m.yaml").write_text(f"source_id: s1\ncharacter_id: hero\nseries: x\nepisode: '1'\ninput_type: subtitle_smi\nlanguage: ko\nrights_status: synthetic\nfile: a.smi\nsha256: {hashlib.sha256(body).hexdigest()}\nparser_profile: sami\n")
    d = str(tmp_path)
    assert cli.main(["smi-prepare", "--manifest", f"{d}/m.yaml", "--private-root", d, "--out", f"{d}/prep"]) == 0
    note = ["smi-review", "--prepared", f"{d}/prep", "--annotations", f"{d}/notes.json"]
    export = ["smi-export", "--prepared", f"{d}/prep", "--annotations", f"{d}/notes.json", "--personas", f"{d}/p.yaml", "--out"]
    seg = lambda *x: json.dumps([{"start_char": a, "end_char": b, "label": c} for a, b, c in x])
    assert cli.main([*note, "--subtitle-id", "s000001", "--segments", seg((0, 3, "gintoki"), (4, 7, "other"))]) == 2
    assert cli.main([*note, "--subtitle-id", "s000002", "--segments", seg((0, 1, "other"))]) == 2
    assert cli.main([*note, "--subtitle-id", "s000001", "--segments", seg((0, 3, "gintoki"), (3, 7, "other"))]) == 0
    assert cli.main([*export, f"{d}/out"]) == 2
    assert cli.main([*note, "--subtitle-id", "s000003", "--segments", seg((0, 3, "gintoki"))]) == 0
    assert cli.main([*export, f"{d}/out"]) == 0
    assert [(u["text"], u["utterance_id"]) for u in rows(tmp_path / "out/parsed/s1.jsonl")] == [("one", "s1-s000001-01")]
    assert [q["reason"] for q in rows(tmp_path / "out/quarantine/s1.jsonl")] == ["invalid_timing"]
    assert cli.main([*export, f"{d}/paste.txt", "--format", "paste"]) == 0
    assert (tmp_path / "paste.txt").read_text() == "gintoki: one\n"


PAGE = """<html><body><article><h1>T</h1>lead<h2>A</h2><p>first <b>x</b> <b>y</b><a class="wikiFootnote" href="#f1">[1]</a></p>
<nav>toc</nav><h4>Deep</h4><p>a &amp;lt; b<br>c<br><br>d [[link]]</p><h2>B</h2><p>before<img>after</p>
<span class="footnote-list" id="f1"><p>note one</p><p>more</p></span></article></body></html>"""


def test_wiki_page():
    found, error = wiki.read_page(PAGE)
    assert error is None
    assert [(r["kind"], r["text"], r["heading_path"]) for r in found] == [("body", "first xy", ["A"]), ("body", "a < b c", ["A", "Deep"]), ("body", "d [[link]]", ["A", "Deep"]), ("body", "before", ["B"]), ("body", "after", ["B"]), ("footnote", "note one", ["B"]), ("footnote", "more", ["B"])]
    assert found[0]["footnote_refs"] == ["f1"] and found[5]["footnote_id"] == "f1"


@pytest.mark.parametrize("old, new, message", [("<article>", "<div>", "missing"), ("</article>", "", "unclosed"), ("</html>", "", "unclosed HTML"), ('href="#f1"', 'href="#f9"', "unresolved"), ("</article>", "</article><article></article>", "multiple")])
def test_broken_pages(old, new, message):
    assert message in (wiki.read_page(PAGE.replace(old, new))[1] or "")


def test_paragraphs_are_handed_over_in_pieces(spark):
    """However many pages come at once, and however long the headings that their rows repeat."""
    page = f"<article><h2>{'head ' * 400}</h2>{'<p>one</p>' * 200}</article>"
    batch = pa.RecordBatch.from_pydict({"document_id": [str(i) for i in range(30)], "html": [page] * 29 + [None]})

    class Pages:
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run(iter([batch]))
        mapInPandas = lambda self, run, _: run(iter([batch.to_pandas()]))

    sizes = [len(x) for x in wiki.paragraphs(Pages())]
    assert sum(sizes) == 29 * 200 + 1 and max(sizes) < 600


def test_wiki_command(spark, tmp_path):
    def source(i):
        page = PAGE.replace("first", f"first{i}")
        (tmp_path / f"{i}.html").write_text(page)
        return {"source_id": f"w{i}", "title": f"T{i}", "file": f"{i}.html", "language": "ko", "sha256": hashlib.sha256(page.encode()).hexdigest()}

    (tmp_path / "acquisition.json").write_text(json.dumps({"sources": [source(i) for i in (2, 0, 1)]}))
    (tmp_path / "profile-acquisition.json").write_text(json.dumps({"sources": [source(3)]}))
    args = ["wiki-extract", "--input-root", str(tmp_path), "--out"]
    (tmp_path / "empty").mkdir()
    assert cli.main([*args, f"{tmp_path}/empty"]) == 2
    assert cli.main([*args, f"{tmp_path}/out"]) == 0
    report = json.loads((tmp_path / "out/extract_report.json").read_text())
    assert report["totals"] == {"sources": 4, "paragraphs": 28, "review_required": 4}
    assert cli.main([*args, f"{tmp_path}/w.md", "--format", "paste"]) == 0
    text = (tmp_path / "w.md").read_text()
    assert text.startswith("# A\n\nfirst0 xy[^1]\n\n## Deep\n\na < b c\n\nd [[link]]\n\n# B\n\nbefore\n\nafter\n\n## 각주\n\n[^1]: note one\n\n# A\n\nfirst1")
    (tmp_path / "0.html").write_text("changed")
    assert cli.main([*args, f"{tmp_path}/out"]) == 2
