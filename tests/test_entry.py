"""Driver contract and a sample of registered queries against their SQL at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from keelson.sources.tables import TABLES
from tests.conftest import SMALL

SAMPLE = ["AGG7", "SMP1", "AGG12", "AGG14", "AGG18", "WIN1", "WIN4", "FT17", "MOD9", "AGG11", "REG2", "FLT3"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "r2" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    sdf = entry.queries()[key](spark, SMALL)
    cur = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    srows = [tuple(r) for r in sdf.collect()]
    drows = cur.fetchall()
    norm = lambda v: v if not isinstance(v, float) or v != 0 else 0.0
    srows = [tuple(norm(v) for v in r) for r in srows]
    drows = [tuple(norm(v) for v in r) for r in drows]
    assert _norm(srows, sdf.columns) == _norm(drows, dcols)
