from datetime import date

import pytest

from dialoom.sources.errors import ConfigError, GateError
from dialoom.sources.manifest import load_manifest, load_manifests, load_personas

GOOD = "source_id: s1\ncharacter_id: hero\nseries: x\nepisode: '001'\ninput_type: transcript_txt\nlanguage: en\nrights_status: synthetic\nfile: a.txt\nsha256: " + "A" * 64 + "\nparser_profile: transcript-txt\n"


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return path


def test_good_manifest(tmp_path):
    m = load_manifest(put(tmp_path / "m.yaml", GOOD + "delete_at: 2030-01-02\n"))
    assert (m.episode, m.sha256, m.delete_at) == ("001", "a" * 64, date(2030, 1, 2))
    m.check_retention(date(2030, 1, 2))
    with pytest.raises(GateError):
        m.check_retention(date(2030, 1, 3))


@pytest.mark.parametrize("old, new", [("source_id: s1", "source_id: ''"), ("source_id: s1", "source_id: ../x"), ("transcript_txt", "video"), ("synthetic", "stolen"), ("A" * 64, "abc"), ("file: a.txt\n", ""), ("series: x", "series: ' '")])
def test_bad_manifests(tmp_path, old, new):
    with pytest.raises(ConfigError):
        load_manifest(put(tmp_path / "m.yaml", GOOD.replace(old, new)))


@pytest.mark.parametrize("value", ["2030-01-01 10:00:00", "soon", "7"])
def test_bad_dates(tmp_path, value):
    with pytest.raises(ConfigError):
        load_manifest(put(tmp_path / "m.yaml", GOOD + f"delete_at: {value}\n"))


def test_unquoted_episode_and_null_text(tmp_path):
    m = load_manifest(put(tmp_path / "m.yaml", GOOD.replace("'001'", "001").replace("series: x", "series: null")))
    assert (m.episode, m.series) == ("1", "None")


def test_paths_stay_below_the_root(tmp_path):
    m = load_manifest(put(tmp_path / "m.yaml", GOOD.replace("a.txt", "../a.txt")))
    with pytest.raises(GateError):
        m.path_below(tmp_path)


def test_source_ids_are_unique_and_sorted(tmp_path):
    put(tmp_path / "b.yaml", GOOD)
    put(tmp_path / "a.yml", GOOD.replace("s1", "s2"))
    assert [m.source_id for m in load_manifests(tmp_path)] == ["s1", "s2"]
    put(tmp_path / "c.yml", GOOD)
    with pytest.raises(ConfigError):
        load_manifests(tmp_path)


def test_digest_covers_what_shapes_the_output(tmp_path):
    a = load_manifest(put(tmp_path / "a.yaml", GOOD))
    b = load_manifest(put(tmp_path / "b.yaml", GOOD.replace("series: x", "series: y")))
    c = load_manifest(put(tmp_path / "c.yaml", GOOD.replace("source_id: s1", "source_id: s9")))
    assert a.digest != b.digest and a.digest == c.digest


def test_personas(tmp_path):
    p = load_personas(put(tmp_path / "p.yaml", "personas:\n- id: hero\n  aliases: [The Hero, ' H ']\nnon_dialogue_speakers: [Sign]\n"))
    assert p.aliases == {"hero": "hero", "the hero": "hero", "h": "hero"} and p.non_dialogue == {"sign"}


@pytest.mark.parametrize("text", ["[]", "personas: []", "personas: [{id: a}, {id: b, aliases: [A]}]", "personas: [{id: a}]\nnon_dialogue_speakers: [A]", "personas: [{id: 3}]", "personas: [{id: a, aliases: ['']}]", "{"])
def test_bad_personas(tmp_path, text):
    with pytest.raises(ConfigError):
        load_personas(put(tmp_path / "p.yaml", text))
