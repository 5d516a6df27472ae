"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01), plus a rows-only run of
the queries that have no SQL form."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.fixtures import BASE_TABLES

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:-9] if s.endswith("T00:00:00") else s
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(v)
    except Exception:
        pass
    return v


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(t[i]) for i in order) for t in tuples]
    return sorted(out, key=lambda r: tuple((x is None, f"{x:.6g}" if isinstance(x, float) else str(x)) for x in r))


def _same(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, float):
                if not (x == y or abs(x - y) <= 1e-9 * max(abs(x), abs(y), 1e-12)):
                    return False
            elif x != y:
                return False
    return True


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


#: Those of the optional subpackage have tests of their own.
OWN = [n for n in QUERIES if n.startswith("op") or n == "pipeline"]


@pytest.mark.parametrize("name", sorted(set(ORACLE) - set(OWN)))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _same(_rows(df.columns, srows), _rows(dcols, cur.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - set(OWN)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["date_number", "day", "location"]


def test_every_survey_id_has_a_query():
    ids = (["s%d" % i for i in range(1, 6)] + ["p%d" % i for i in range(1, 8)] + ["f%d" % i for i in range(1, 11)]
           + ["j%d" % i for i in range(1, 13)] + ["a%d" % i for i in range(1, 21)] + ["w%d" % i for i in range(1, 14)]
           + ["o%d" % i for i in range(1, 6)] + ["r%d" % i for i in range(1, 6)] + ["c%d" % i for i in range(1, 20)]
           + ["t%d" % i for i in range(1, 8)] + ["d%d" % i for i in range(1, 29)] + ["m%d" % i for i in range(1, 12)])
    have = {n.split("_")[0] for n in QUERIES}
    assert [i for i in ids if i not in have] == []
