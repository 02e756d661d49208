"""Every query of the engine against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

from dialoom import corpus_queries as q

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not DATA.exists():
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(frame):
    columns = sorted(frame.columns)
    shown = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(tuple(str(int(v)) if isinstance(v, float) and v == int(v) else str(v) for v in row) for row in shown.values.tolist())


@pytest.mark.parametrize("name", list(q.SQL))
def test_matches_sql(spark, duck, name):
    ours, theirs = q.QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(q.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n not in q.SQL])
def test_gives_rows(spark, duck, name):
    assert q.QUERIES[name](spark, str(DATA)).count() > 0
