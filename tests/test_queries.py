"""Every query with SQL gives what DuckDB gives; the others give rows."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry
from paperloom import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat()[:19] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = core.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
    res = con.execute(core.ORACLES[name])
    have = [d[0] for d in res.description]
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_subject_codes_of_every_row(spark):
    import json

    rows = core.papers(spark, DATA).select("ord", "subject_code").collect()
    assert any((r["subject_code"] or "").startswith("[") for r in rows)
    got = {r["ord"]: r["codes"] for r in core.QUERIES["subject_codes_all"](spark, DATA).collect()}
    for r in rows:
        v = r["subject_code"] or ""
        codes = [x["code"] if isinstance(x, dict) else x for x in json.loads(v)] if v.startswith("[") else v.replace("|", ";").split(";")
        assert got[r["ord"]] == "|".join(sorted({c.strip() for c in codes if c and c.strip()}))
    assert len(got) == len(rows)
