import duckdb
import pytest

import __spark_entry__ as entry
from docketlake.plans import registry

CHECKED = ["a1_docket_stats", "a7_docket_weeks", "w1_recent_other", "j1_reconcile", "k7_upsert_stats_full", "m10_crockford_hash", "j12_match_entities", "u1_replace_views"]


def test_every_sql_twin_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert registry.FLAGSHIP in registry.queries()


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql_twin(spark, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir)
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    columns = sorted(got.columns)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    a = sorted((tuple(r) for r in got.select(*columns).collect()), key=str)
    b = sorted(want.select(", ".join(columns)).fetchall(), key=str)
    assert [tuple(map(str, r)) for r in a] == [tuple(map(str, r)) for r in b]
