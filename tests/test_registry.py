import duckdb
import pytest

import __spark_entry__ as entry
from sluice.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
# queries with no SQL twin, and why
NO_ORACLE: set[str] = set()


def test_every_query_has_an_oracle():
    # of the library's own queries; the optional corpus operators have tests of their own
    assert set(QUERIES) - set(entry.oracle_sql()) == NO_ORACLE
    assert set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["topic", "n_events"] and sum(r.n_events for r in rows) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_ORACLE))
def test_query_equals_its_oracle(spark, name):
    df = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("events", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(df.columns)
    norm = lambda cols, r: tuple(repr(r[cols.index(c)]) for c in sorted(cols))
    got = sorted(norm(df.columns, tuple(r)) for r in df.collect())
    want = sorted(norm(ocols, r) for r in res.fetchall())
    assert got == want
