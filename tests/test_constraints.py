"""Constraints inside the plan that writes."""
import pytest

from ticklake.operators import quality as Q

ROWS = [(1, "a", 3), (2, "b", None), (None, "x", 1), (None, "x", 2)]


def made(spark, extra=()):
    return spark.createDataFrame([*ROWS, *extra], "k int, v string, n int")


def test_good_rows_pass(spark):
    got = Q.enforce(made(spark), {"n_positive": "n > 0"}, ["k"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(ROWS, key=str)


@pytest.mark.parametrize("bad,what", [((3, "c", -1), "rule n_positive violated"), ((1, "again", 5), "duplicate key on")])
def test_the_write_itself_fails(spark, tmp_path, bad, what):
    df = Q.enforce(made(spark, [bad]), {"n_positive": "n > 0"}, ["k"])  # nothing runs yet
    with pytest.raises(Exception, match=what.replace("(", "\\(")):
        df.write.parquet(f"{tmp_path}/t")
    assert not (tmp_path / "t" / "_SUCCESS").exists()
    with pytest.raises(Exception, match=what):
        df.count()


def test_one_job_and_one_shuffle(spark):
    plan = Q.enforce(made(spark), {}, ["k"])._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
