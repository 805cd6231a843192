"""Market data: bars, splits, company info documents, profile and fundamentals,
price cursors, moving statistics, split adjustment, market calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import coerce as C

PRICE_SCHEMA = T.StructType([
    T.StructField("tickerId", T.LongType()), T.StructField("date", T.DateType()),
    T.StructField("open", T.DecimalType(15, 2)), T.StructField("high", T.DecimalType(15, 2)),
    T.StructField("low", T.DecimalType(15, 2)), T.StructField("close", T.DecimalType(15, 2)),
    T.StructField("volume", T.LongType()),
])
SPLIT_SCHEMA = T.StructType([
    T.StructField("tickerId", T.LongType()), T.StructField("date", T.DateType()),
    T.StructField("ratio", T.DecimalType(10, 2)),
])


# ---------------------------------------------------------------------------
# S1-S3 sources
# ---------------------------------------------------------------------------
def clean_prices(bars: DataFrame) -> DataFrame:
    """Daily bars with every NULL-bearing row dropped."""
    return bars.na.drop("any")


def load_prices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Typed read (no schema inference) + ``clean_prices``."""
    r = spark.read.schema(PRICE_SCHEMA)
    df = r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)
    return clean_prices(df)


def load_splits(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Typed read of split events."""
    r = spark.read.schema(SPLIT_SCHEMA)
    return r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)


def parse_company_info(df: DataFrame, col: str = "info") -> DataFrame:
    """S3: company-info JSON text -> VARIANT (``try_parse_json``: bad JSON -> NULL)."""
    return df.withColumn(col, F.try_parse_json(F.col(col)))


def load_company_info(spark: SparkSession, path: str) -> DataFrame:
    """S3: one JSON document per line (``ticker_id`` + ``info`` object) -> VARIANT."""
    raw = spark.read.text(path)
    return raw.select(F.try_parse_json("value").alias("doc")).select(
        F.try_variant_get("doc", "$.ticker_id", "bigint").alias("ticker_id"),
        F.variant_get("doc", "$.info", "variant").alias("info"))


# ---------------------------------------------------------------------------
# P1-P4 profile and fundamentals
# ---------------------------------------------------------------------------
def _is_container(v: Column, key: str) -> Column:
    t = F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
    return t.startswith("ARRAY") | t.startswith("OBJECT")


def scalar_value(v: Column, key: str, typ: str) -> Column:
    """The value of ``key`` when it is a scalar; lists / dicts -> NULL.
    A boolean read as a number is 1/0."""
    path = f"$.{key}"
    if typ == "string":
        return F.when(~_is_container(v, key), F.try_variant_get(v, path, "string"))
    return F.try_variant_get(v, path, typ)


def ticker_profile(info: DataFrame, col: str = "info", keep: tuple[str, ...] = ("ticker_id",)) -> DataFrame:
    """32 renamed company-info keys + ``fund_inception_date``.
    Scalar values as text; list / dict values as their JSON text."""
    v = F.col(col)
    cols = []
    for key, name in schemas.PROFILE_KEYS:
        raw = F.try_variant_get(v, f"$.{key}", "variant")
        cols.append(F.when(_is_container(v, key), F.to_json(raw))
                    .otherwise(F.try_variant_get(v, f"$.{key}", "string")).alias(name))
    epoch = F.try_variant_get(v, "$.fundInceptionDate", "string")
    return info.where(v.isNotNull()).select(*keep, *cols, C.epoch_to_date(epoch).alias("fund_inception_date"))


def fundamentals(info: DataFrame, as_of, col: str = "info", ticker_col: str = "ticker_id",
                 drop_empty: bool = True) -> DataFrame:
    """68 metrics with defaults (0 / 0.0 / '') and 13 fund metrics that stay
    NULL; list / dict values count as missing (P4).  Documents that are NULL or
    empty give no row (``drop_empty``) as in the batch job."""
    v = F.col(col)
    cols = []
    for key, typ, default in schemas.DEFAULT_METRICS:
        cols.append(F.coalesce(scalar_value(v, key, typ), F.lit(default).cast(typ)).alias(key))
    for name, key in schemas.OPTIONAL_METRICS:
        cols.append(scalar_value(v, key, "double").alias(name))
    src = info
    if drop_empty:
        src = src.where(v.isNotNull() & (F.schema_of_variant(v) != "OBJECT<>"))
    return src.select(F.col(ticker_col).alias("tickerId"), F.lit(as_of).cast("date").alias("date"), *cols)


# ---------------------------------------------------------------------------
# A5 / P21 cursors
# ---------------------------------------------------------------------------
def price_cursor(price: DataFrame, expected_date) -> DataFrame:
    """A5: latest stored bar per ticker and whether it reaches ``expected_date``."""
    g = price.groupBy("tickerId").agg(F.max("date").alias("latest_date"))
    return g.withColumn("up_to_date", F.col("latest_date") >= F.lit(expected_date).cast("date"))


def newer_than(rows: DataFrame, stored: DataFrame, key: str = "tickerId", date_col: str = "date") -> DataFrame:
    """Keep incoming rows after the ticker's last stored date (all rows of
    a ticker with nothing stored).  The stored side is reduced to one row per
    ticker before the join."""
    hwm = stored.groupBy(F.col(key).alias("_k")).agg(F.max(date_col).alias("_hwm"))
    j = rows.join(hwm, F.col(key) == F.col("_k"), "left")
    return j.where(F.col("_hwm").isNull() | (F.col(date_col) > F.col("_hwm"))).drop("_k", "_hwm")


# ---------------------------------------------------------------------------
# W7 / J9 derived series
# ---------------------------------------------------------------------------
#: days in a cell, and cells in a block: a ticker's bars are worked on block by block
CELL, BLOCK = 91, 16
#: what a bar of W7 looks back to
BARS, DAYS = 199, 364


def _day(c: str) -> Column:
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def _cell(c: str) -> Column:
    return F.floor(_day(c) / F.lit(CELL)).cast("int")


def _block(cell: Column) -> Column:
    return F.floor(cell / F.lit(BLOCK)).cast("int")


def _served(price: DataFrame, bars: int, days: int) -> DataFrame:
    """(tickerId, cell, blocks): the blocks of about four years that need a
    cell's bars: its own, and later ones that begin within ``days`` days, or of
    whose ``bars`` last bars before the first one some are in the cell.  One row
    a ticker and cell, from a count of the bars."""
    cells = price.groupBy("tickerId", _cell("date").alias("cell")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("tickerId").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("upto", F.sum("n").over(order)).withColumn("block", _block(F.col("cell")))
    begins = cells.groupBy("tickerId", "block").agg(F.min(F.col("upto") - F.col("n")).alias("before"))
    begins = begins.groupBy("tickerId").agg(F.collect_list(F.struct("block", "before")).alias("begins"))  # a row every four years
    near = F.lit(-(-days // CELL))
    needs = F.filter("begins", lambda b: (b["block"] == F.col("block")) | (
        (b["block"] > F.col("block")) & ((F.col("cell") >= b["block"] * BLOCK - near) | (F.col("upto") > b["before"] - bars))))
    return cells.join(begins, "tickerId").select("tickerId", "cell", F.transform(needs, lambda b: b["block"]).alias("blocks"))


def moving_stats(price: DataFrame) -> DataFrame:
    """50 / 200-bar average close and change, 52-week (364-day range) low /
    high and the change from them, per ticker in date order.

    A ticker is many window partitions, one for each block of days; bars that a
    later block looks back to are copied there (about a quarter of a year in
    four), so a ticker that holds half of all bars is spread over tasks."""
    close = F.col("close").cast("double")
    rows = price.select("tickerId", "date", close.alias("close"), F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), _cell("date").alias("cell"))
    dealt = rows.join(_served(price, BARS, DAYS), ["tickerId", "cell"]).select("*", F.explode("blocks").alias("block"))
    parts = Window.partitionBy("tickerId", "block")
    w50 = parts.orderBy("date").rowsBetween(-49, 0)
    w200 = parts.orderBy("date").rowsBetween(-BARS, 0)
    wy = parts.orderBy(_day("date")).rangeBetween(-DAYS, 0)
    out = dealt.select(
        "tickerId", "date", "close", (_block(F.col("cell")) == F.col("block")).alias("_own"),
        F.avg("close").over(w50).alias("_ma50"), F.avg("close").over(w200).alias("_ma200"),
        F.min("low").over(wy).alias("_lo"), F.max("high").over(wy).alias("_hi"),
    ).where("_own")
    r = F.round
    return out.select(
        "tickerId", "date",
        r(F.col("_ma50"), 6).alias("fifty_day_average"),
        r(F.col("close") - F.col("_ma50"), 6).alias("fifty_day_average_change"),
        r(F.col("_ma200"), 6).alias("two_hundred_day_average"),
        r(F.col("close") - F.col("_ma200"), 6).alias("two_hundred_day_average_change"),
        r(F.col("_lo"), 6).alias("fifty_two_week_low"),
        r(F.col("_hi"), 6).alias("fifty_two_week_high"),
        r(F.col("close") - F.col("_lo"), 6).alias("fifty_two_week_low_change"),
        r(F.col("close") - F.col("_hi"), 6).alias("fifty_two_week_high_change"),
    )


def split_adjust(price: DataFrame, split: DataFrame) -> DataFrame:
    """Split factor of each bar = product of the ratios of the ticker's
    later splits (1 when none); adjusted close = close / factor.

    Bars and splits of a ticker and block of days in one descending order with a
    running product of the splits after the day, times the product of all later
    blocks, which is known from the splits alone.  No row per (bar, split), and
    a ticker with half of all bars is many partitions."""
    block = _block(_cell("date")).alias("block")
    splits = split.select("tickerId", "date", F.col("ratio").cast("double").alias("_r"), block)
    rows = price.select("tickerId", "date", F.col("close").cast("double").alias("close"), F.lit(None).cast("double").alias("_r"), block).unionByName(
        splits.withColumn("_split", F.lit(True)), allowMissingColumns=True)
    later = Window.partitionBy("tickerId", "block").orderBy(_day("date").desc()).rangeBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("within", F.coalesce(F.product("_r").over(later), F.lit(1.0))).where(F.col("_split").isNull())
    products = splits.groupBy("tickerId", "block").agg(F.product("_r").alias("p")).groupBy("tickerId").agg(F.collect_list(F.struct("block", "p")).alias("products"))
    after = F.aggregate(F.filter("products", lambda x: x["block"] > F.col("block")), F.lit(1.0), lambda a, x: a * x["p"])
    out = within.join(products, "tickerId", "left").withColumn("split_factor", F.col("within") * F.coalesce(after, F.lit(1.0)))
    return out.select("tickerId", "date", "close", "split_factor", (F.col("close") / F.col("split_factor")).alias("adj_close"))


# ---------------------------------------------------------------------------
# P24 market calendar
# ---------------------------------------------------------------------------
def _nth_weekday(year: Column, month: int, dow: int, n: int) -> Column:
    """n-th weekday (Spark dayofweek: 1 = Sunday) of a month; n = -1 for the last."""
    if n > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        return F.date_add(first, ((F.lit(dow) - F.dayofweek(first) + 7) % 7 + 7 * (n - 1)).cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, ((F.dayofweek(last) - F.lit(dow) + 7) % 7).cast("int"))


def _observed(d: Column) -> Column:
    dow = F.dayofweek(d)
    return F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_add(d, 1)).otherwise(d)


def holiday_dim(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """US federal holidays (observed dates) for the years, built by rule in
    Spark: fixed-date holidays move Saturday -> Friday and Sunday -> Monday;
    Juneteenth from 2021; Martin Luther King Day from 1986.  The next year's
    1 January can be observed on 31 December, so one extra year is generated."""
    years = spark.range(first_year, last_year + 2).select(F.col("id").cast("int").alias("y"))
    y = F.col("y")
    rules = [
        ("new_years_day", _observed(F.make_date(y, F.lit(1), F.lit(1))), None),
        ("martin_luther_king_day", _nth_weekday(y, 1, 2, 3), 1986),
        ("presidents_day", _nth_weekday(y, 2, 2, 3), None),
        ("memorial_day", _nth_weekday(y, 5, 2, -1), None),
        ("juneteenth", _observed(F.make_date(y, F.lit(6), F.lit(19))), 2021),
        ("independence_day", _observed(F.make_date(y, F.lit(7), F.lit(4))), None),
        ("labor_day", _nth_weekday(y, 9, 2, 1), None),
        ("columbus_day", _nth_weekday(y, 10, 2, 2), None),
        ("veterans_day", _observed(F.make_date(y, F.lit(11), F.lit(11))), None),
        ("thanksgiving", _nth_weekday(y, 11, 5, 4), None),
        ("christmas", _observed(F.make_date(y, F.lit(12), F.lit(25))), None),
    ]
    parts = []
    for name, d, since in rules:
        p = years.select(F.lit(name).alias("holiday"), d.alias("date"), y)
        if since is not None:
            p = p.where(y >= since)
        parts.append(p)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.year("date").between(first_year, last_year)).select("holiday", "date")


def market_days(df: DataFrame, col: str, holidays: DataFrame) -> DataFrame:
    """Flag each row's date as a market day (not a weekend, not a federal
    holiday).  The holiday table is bounded by the year range: broadcast."""
    h = holidays.select(F.col("date").alias("_hd")).distinct().withColumn("_hol", F.lit(True))
    j = df.join(F.broadcast(h), F.col(col) == F.col("_hd"), "left")
    dow = F.dayofweek(F.col(col))
    return j.withColumn("is_market_day", ~dow.isin(1, 7) & F.col("_hol").isNull()).drop("_hd", "_hol")
