"""Smoke: entry() and every registered query run on sf0.001; the oracle-backed
ones match DuckDB there (the driver checks sf0.01)."""
import pytest

import __spark_entry__ as E
from checks.compare import _norm, duck
from collections import Counter

FAST = ["W1_position_current", "A1_run_summary", "J1_map_line_codes", "W3_merge_facts", "G15_network_density",
        "T5_sentences", "V1_knn", "I6_plan_runs", "P3_fundamentals", "S9_upsert_ledger", "I1_stream_upsert"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "shares_held" in df.columns


def test_every_query_has_a_name_and_oracle_keys_exist():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, smoke_dir, name):
    sdf = E.queries()[name](spark, smoke_dir)
    srows = Counter(repr(tuple(_norm(x) for x in r)) for r in sdf.collect())
    con = duck(smoke_dir)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    order = [cols.index(c) for c in sdf.columns]
    drows = Counter(repr(tuple(_norm(r[i]) for i in order)) for r in cur.fetchall())
    assert srows == drows
