"""The driver contract: entry, queries and oracle SQL."""
import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["section", "column_name", "metric", "value"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["audit_missing", "split_stratified", "roc_auc", "drift_ks", "rank_runs"])
def test_query_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "part", "customer", "labels", "documents", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = E.queries()[name](spark, SF)
    cols = sorted(s.columns)
    got = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in cols))
                 for r in s.collect())
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = sorted(tuple(round(v, 6) if isinstance(v, float) else v
                        for v in (dict(zip(names, r))[c] for c in cols)) for r in res.fetchall())
    assert got == want
