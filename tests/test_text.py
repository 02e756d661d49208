import unicodedata

from pyspark.sql import functions as F

from dialoom.functions import digests, text

ODD = ["", " a b ", "é", "x​y﻿", " A\x1cB　", "one\r\ntwo\x0bthree\n", "\n", "a b\x85c", "Straße", "٠", "tab\tend\n\n"]
ZERO = "​‌‍﻿"


def plain(value):
    return " ".join("".join(c for c in unicodedata.normalize("NFC", value) if c not in ZERO).split())


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalize_matches_plain_python(spark):
    assert column(spark, ODD, text.normalize) == [plain(v) for v in ODD]


def test_lines_match_splitlines(spark):
    assert column(spark, ODD, text.split_lines) == [v.splitlines() for v in ODD]


def test_merge_lines(spark):
    assert column(spark, ["a\n\n b  c \n"], lambda c: text.merge_lines(text.split_lines(c))) == ["a b c"]


def test_speaker_key_folds(spark):
    assert column(spark, ["  STRASSE ", "Straße"], text.speaker_key) == ["strasse", "strasse"]


def test_qualifiers_go_in_order(spark):
    assert column(spark, ["A [x] (y)", "A (y) [x]", "(only)", "A (b (c)", "A"], text.without_qualifier) == ["A", "A (y)", "(only)", "A (b", "A"]


def test_clock(spark):
    assert column(spark, ["00:06", "100:00", "99:99", "01:02:07"], text.clock_seconds) == [6, 6000, 6039, 3727]


def test_versions_change_with_every_part():
    base = digests.dataset_version("p", "c", "m")
    assert base.startswith("ds1-") and len(base) == 20
    assert len({base, digests.dataset_version("q", "c", "m"), digests.dataset_version("p", "d", "m"), digests.dataset_version("p", "c", "n"), digests.dataset_version("p", "c", "m", "a")}) == 5
    assert digests.corpus_version({"a": "1", "b": "2"}) == digests.corpus_version({"b": "2", "a": "1"})
