"""Market helpers, calendar and planning verdicts."""
import datetime as dt

from pyspark.sql import functions as F

from ticklake.operators import incremental as INC
from ticklake.operators import market as MK


def test_calendar(spark):
    days = spark.createDataFrame([(dt.date(2024, 6, 8),), (dt.date(2024, 6, 10),), (dt.date(2024, 7, 4),),
                                  (dt.date(2021, 12, 31),), (dt.date(2024, 6, 19),)], "d date")
    got = {r.d: r.is_market_day for r in MK.market_days(days, "d", MK.holiday_dim(spark, 2020, 2025)).collect()}
    assert got == {dt.date(2024, 6, 8): False, dt.date(2024, 6, 10): True, dt.date(2024, 7, 4): False,
                   dt.date(2021, 12, 31): False, dt.date(2024, 6, 19): False}


def test_eligibility(spark):
    df = spark.createDataFrame([(None,), ("EQUITY",), ("ETF",)], "quote_type string")
    assert [r.edgar_eligible for r in INC.edgar_eligible(df).collect()] == [True, True, False]


def test_should_run(spark):
    cands = spark.createDataFrame([("a1", 1), ("a2", 2), ("a3", 2)], "accessionNo string, tickerId int")
    stored = spark.createDataFrame([("a1", True), ("a2", True)], "accessionNo string, completed boolean")
    got = {r.tickerId: r.should_run for r in INC.should_run(cands, stored).collect()}
    assert got == {1: False, 2: True}


def test_fundamentals_defaults(spark):
    info = MK.parse_company_info(spark.createDataFrame(
        [(1, '{"trailingPE": [1, 2], "marketCap": 5, "sector": "Tech", "navPrice": {"a": 1}}'), (2, "{}")],
        "ticker_id int, info string"))
    rows = MK.fundamentals(info, "2024-01-01").collect()
    assert len(rows) == 1  # empty document -> no row
    r = rows[0]
    assert r.trailingPE == 0.0 and r.marketCap == 5 and r.nav_price is None and r.recommendationKey == ""


def test_split_adjust(spark):
    price = spark.createDataFrame([(1, dt.date(2024, 1, 1), 100.0), (1, dt.date(2024, 3, 1), 50.0)],
                                  "tickerId int, date date, close double")
    split = spark.createDataFrame([(1, dt.date(2024, 2, 1), 2.0)], "tickerId int, date date, ratio double")
    got = {r.date: r.adj_close for r in MK.split_adjust(price, split).collect()}
    assert got == {dt.date(2024, 1, 1): 50.0, dt.date(2024, 3, 1): 50.0}


def test_plan_order(spark):
    tickers = spark.createDataFrame([(1, "ETF"), (2, "EQUITY")], "id int, quote_type string")
    checks = spark.createDataFrame([(2, "financials", False)], "ticker_id int, process_name string, has_new_data boolean")
    state = spark.createDataFrame([(2, "press_releases", "running", dt.datetime(2024, 1, 1, 11, 0))],
                                  "ticker_id int, process_name string, status string, last_started_at timestamp_ntz")
    got = {(r.ticker_id, r.process_name): r.verdict
           for r in INC.plan_runs(tickers, checks, state, "2024-01-01 12:00:00").collect()}
    assert got[(1, "financials")] == "skip-ineligible" and got[(1, "stocks")] == "run"
    assert got[(2, "financials")] == "skip-no-new-data" and got[(2, "press_releases")] == "skip-locked"


def _bars(spark):
    """A ticker with most of the bars, sparse ones, and gaps of years."""
    import random
    rng = random.Random(6)
    rows = [(1, dt.date(1995, 1, 2) + dt.timedelta(days=i)) for i in range(6000)]
    rows += [(2, dt.date(1960, 1, 1) + dt.timedelta(days=97 * i)) for i in range(260)]
    rows += [(3, dt.date(2001, 5, 1) + dt.timedelta(days=i + (4000 if i > 150 else 0))) for i in range(300)] + [(4, dt.date(2020, 1, 1))]
    return spark.createDataFrame([(t, d, *sorted(rng.randrange(1, 9999) / 4 for _ in range(3))) for t, d in rows], "tickerId int, date date, low double, close double, high double")


def test_moving_stats_in_blocks_as_whole_tickers(spark):
    from pyspark.sql import Window
    price = _bars(spark)
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    base = Window.partitionBy("tickerId")
    want = price.select("tickerId", "date", F.round(F.avg("close").over(base.orderBy("date").rowsBetween(-49, 0)), 6).alias("a"),
                        F.round(F.avg("close").over(base.orderBy("date").rowsBetween(-199, 0)), 6).alias("b"),
                        F.min("low").over(base.orderBy(day).rangeBetween(-364, 0)).alias("c"), F.max("high").over(base.orderBy(day).rangeBetween(-364, 0)).alias("d"))
    got = MK.moving_stats(price).select("tickerId", "date", "fifty_day_average", "two_hundred_day_average", "fifty_two_week_low", "fifty_two_week_high")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the ticker with nine tenths of the bars is spread
    served = MK._served(price, 199, 364).where("tickerId = 1").select(F.explode("blocks").alias("b")).distinct().count()
    assert served >= 5


def test_split_adjust_in_blocks(spark):
    price = _bars(spark)
    splits = [(1, dt.date(1996, 3, 1) + dt.timedelta(days=700 * i), float(2 + i % 3)) for i in range(8)] + [(2, dt.date(1980, 1, 1), 3.0), (9, dt.date(1980, 1, 1), 3.0)]
    want = {}
    for r in price.collect():
        f = 1.0
        for t, d, ratio in splits:
            if t == r.tickerId and d > r.date:
                f *= ratio
        want[r.tickerId, r.date] = f
    got = MK.split_adjust(price, spark.createDataFrame(splits, "tickerId int, date date, ratio double")).collect()
    assert {(r.tickerId, r.date): r.split_factor for r in got} == want and len(got) == len(want)
