"""What the ledger queries move: lines as stored, once, and each batch row once."""

import datetime

import pytest
from pyspark.sql import functions as F

from ticklake.operators import insiders
from ticklake.plans.catalog import CATALOG
from ticklake.sources import fixtures as fx
from ticklake.sources import sinks

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


@pytest.fixture(scope="module")
def lines_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("lines"))
    day = datetime.datetime(2024, 1, 1)
    rows = [(k % 7, k, 1, k % 3, float(k), 10.5 * k, 0.1 * (k % 2), 0.1 * (k % 3), "ARN"[k % 3], "OFP"[k % 3] if k % 5 else None,
             day + datetime.timedelta(days=k % 4)) for k in range(60)]
    rows += [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", day), (1, None, 1, None, None, None, None, None, None, "F", None)]
    spark.createDataFrame(rows, LINE).write.parquet(f"{d}/lineitem.parquet")
    return d


def _below_exchange(df):
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in text
    return text[text.index("RepartitionByExpression"):]


def test_lines_move_as_stored(spark, lines_dir):
    assert "transaction_date" not in _below_exchange(fx.insider_transaction_raw(spark, lines_dir))
    assert "ownership_type" not in _below_exchange(insiders.ledger_rows(fx.ownership_rows(spark, lines_dir)))


def test_target_and_batch_share_the_exchange(spark, lines_dir):
    df = CATALOG["S9_upsert_ledger"](spark, lines_dir)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_build_reads_the_lines_once(spark, lines_dir):
    day = datetime.datetime(2024, 1, 1)
    orders = [(k, k % 5, "F" if k % 3 else "O", 1.0, day, "4-X") for k in range(1, 9)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.mode("overwrite").parquet(f"{lines_dir}/orders.parquet")
    spark.createDataFrame([(k, f"c{k}", k, "X", 1.0) for k in range(5)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, "
                          "c_acctbal double").write.mode("overwrite").parquet(f"{lines_dir}/customer.parquet")
    df = CATALOG["C4_ledger"](spark, lines_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [x for x in final.splitlines() if "REPARTITION_BY_COL" in x]
    assert len(moved) == 2 and sum("ReusedExchange" in x for x in moved) == 1


def test_target_and_batch_rows(spark, lines_dir):
    from ticklake.plans.catalog import _ledger_target_source

    raw = fx.insider_transaction_raw(spark, lines_dir)
    target, _ = _ledger_target_source(spark, lines_dir)
    want = raw.where((F.col("rn") == 1) & ~F.col("is_derivative")).drop("rn")
    assert sorted(map(str, target.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("winner", ["last", "first"])
def test_batch_rows_are_sent_once(spark, winner):
    rows = [(1, "a", 1, "x"), (1, "b", None, "y"), (1, "b", 2, "z"), (None, "n", 3, None), (None, None, 4, "w"), (2, None, None, None)]
    src = spark.createDataFrame(rows, "k int, o string, p int, q string")
    got = sinks._batch_rows(src, ["k"], ["o", "p"], winner, ["k", "o", "p", "q"])
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in sinks.dedupe_batch(src, ["k"], ["o", "p"], winner).collect()}
    assert "max_by" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_batch_rows_that_cannot_be_compared(spark):
    src = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('b', 2)) AS t(k, o, m)")
    target = src.where("false").select("k", "m")
    assert [tuple(r) for r in sinks.upsert(target, src, ["k"], order=["o"]).collect()] == [(1, {"b": 2})]
