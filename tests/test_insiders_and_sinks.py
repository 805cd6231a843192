"""Ledger mapping, keyed writes and their invariants."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticklake.operators import insiders as INS
from ticklake.sources import sinks


def test_holding_frame(spark):
    raw = spark.createDataFrame(
        [(1, "3", "Common Stock", "1000", None, "Direct", "2024-01-15", (1,)),
         (1, "3", "Stock Option (derivative)", "500", "500", "Indirect", "2024-01-15", (2,))],
        "filing_id int, form string, security_type string, shares string, underlying_shares string, "
        "ownership_type string, date string, src_order struct<i:int>")
    rows = sorted(INS.ledger_rows(raw).collect(), key=lambda r: r.line_number)
    assert rows[0].transaction_code == "H" and rows[0].ownership == "D"
    assert float(rows[0].shares_owned_following) == 1000 and rows[0].transaction_date == dt.date(2024, 1, 15)
    assert rows[1].is_derivative and float(rows[1].shares_owned_following) == 500


def test_alias_ledger(spark):
    raw = spark.createDataFrame([(1, "2024-02-01", "Common", "P", "10", None, (1,))],
                                "filing_id int, date string, security string, code string, shares string, "
                                "remaining string, src_order struct<i:int>")
    r = INS.ledger_rows_alias(raw, False).first()
    assert r.transaction_code == "P" and float(r.shares) == 10 and r.shares_owned_following is None


def _t(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    source = spark.createDataFrame([(2, "x", 1, 1), (2, "y", 2, 2), (3, "z", 3, 3)], "k int, v string, n int, o int")
    return target, source


def test_upsert_last_wins_and_idempotent(spark):
    target, source = _t(spark)
    once = sinks.upsert(target, source, ["k"], ["v"], order=["o"])
    got = {r.k: (r.v, r.n) for r in once.collect()}
    assert got == {1: ("a", 10), 2: ("y", 20), 3: ("z", 3)}
    twice = sinks.upsert(once, source, ["k"], ["v"], order=["o"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_insert_ignore_first_wins(spark):
    target, source = _t(spark)
    got = {r.k: r.v for r in sinks.insert_ignore(target, source, ["k"], order=["o"]).collect()}
    assert got == {1: "a", 2: "b", 3: "z"}


def test_insert_unique_raises(spark):
    target, source = _t(spark)
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.insert_unique(target, source.drop("o"), ["k"])


def test_update_columns_keep_on_null(spark):
    target, _ = _t(spark)
    src = spark.createDataFrame([(1, None), (2, "B")], "k int, v string")
    kept = {r.k: r.v for r in sinks.update_columns(target, src, "k", ["v"]).collect()}
    assert kept == {1: "a", 2: "B"}
    over = {r.k: r.v for r in sinks.update_columns(target, src, "k", ["v"], keep_on_null=False).collect()}
    assert over == {1: None, 2: "B"}


def test_touch_column(spark):
    target = spark.createDataFrame([(1, "a", None)], "k int, v string, updated_at timestamp")
    src = spark.createDataFrame([(1, "b")], "k int, v string")
    r = sinks.update_columns(target, src, "k", ["v"], touch_col="updated_at", now="2024-01-01 00:00:00").first()
    assert r.updated_at is not None


def test_delete_rules(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, 2)], "cid int, pid int")
    gone = spark.createDataFrame([(1,)], "id int")
    out = sinks.delete_with_rules(parent, "id", gone, {"c": (child, "pid", "CASCADE")})
    assert [r.cid for r in out["c"].collect()] == [11]
    out = sinks.delete_with_rules(parent, "id", gone, {"c": (child, "pid", "SET NULL")})
    assert {r.cid: r.pid for r in out["c"].collect()} == {10: None, 11: 2}
    with pytest.raises(sinks.RestrictViolation):
        sinks.delete_with_rules(parent, "id", gone, {"c": (child, "pid", "RESTRICT")})


def test_dense_ids_deterministic(spark):
    from ticklake.operators.common import dense_ids
    df = spark.range(0, 1000).select(F.format_string("k%04d", (F.col("id") * 7919) % 1000).alias("k"))
    a = {r.k: r.id for r in dense_ids(df, ["k"], 100).collect()}
    assert sorted(a.values()) == list(range(101, 1101))
    assert a["k0000"] == 101 and a["k0999"] == 1100


def test_resolve_insiders(spark):
    dim = spark.createDataFrame([(1, "0001", "Old Name"), (2, None, "No Cik")], "id long, cik string, name string")
    inc = spark.createDataFrame([("0001", "New Name"), (None, "No Cik"), (None, "Fresh"), ("0009", "Nine")],
                                "cik string, name string")
    got = {(r.cik, r.name): r.id for r in INS.resolve_insiders(dim, inc).collect()}
    assert got == {("0001", "New Name"): 1, (None, "No Cik"): 2, ("0009", "Nine"): 3, (None, "Fresh"): 4}
