"""Reference-shaped tables derived from the driver's parquet tables.

Each function maps the TPC-H-like test tables onto one table of the filings and
market-data warehouse (tickers, bars, filings, insider ledger, evaluation runs,
traces, the property graph ...), so every operator runs on data that grows with
the scale factor.  All derivations are plain projections, aggregates and joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .tables import Tables


def _t(spark: SparkSession, d: str) -> Tables:
    return Tables(spark, d)


def ticker(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d).customer
    return c.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("ETF"))
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None).cast("string"))
        .otherwise(F.lit("EQUITY")).alias("quote_type"),
    )


def price(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d).orders
    dec = "decimal(15,2)"
    return (
        o.groupBy(F.col("o_custkey").alias("tickerId"), F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").cast(dec).alias("open"),
            F.max("o_totalprice").cast(dec).alias("high"),
            F.min("o_totalprice").cast(dec).alias("low"),
            F.max_by("o_totalprice", "o_orderkey").cast(dec).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def split(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d).orders
    return (
        o.where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("tickerId"), F.to_date("o_orderdate").alias("date"))
        .agg(F.max(F.lit(2) + F.col("o_orderkey") % 3).cast("decimal(10,2)").alias("ratio"))
    )


def company_info(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d).events
    return e.select(
        (F.col("event_id") % 1000).alias("ticker_id"), "event_id", F.col("props").alias("info")
    )


def company_info_wide(spark: SparkSession, d: str) -> DataFrame:
    """Company-info JSON documents with scalar, list and NULL values.

    ``trailingPE`` <- props.k, ``sector`` <- event_type, ``fundInceptionDate`` <-
    epoch seconds of ts, a list under ``corporateActions``; every 5th event has
    no document at all (NULL), every 7th has ``trailingPE`` as a list.
    """
    e = _t(spark, d).events
    k = F.get_json_object("props", "$.k")
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    body = F.concat(
        F.lit('{"shortName":"Co '), F.col("user_id").cast("string"),
        F.lit('","longName":"Company '), F.col("user_id").cast("string"),
        F.lit('","quoteType":'),
        F.when(F.col("event_type") == "error", F.lit('"ETF"')).otherwise(F.lit('"EQUITY"')),
        F.lit(',"sector":"'), F.col("event_type"),
        F.lit('","trailingPE":'),
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("["), k, F.lit(",1]"))).otherwise(k),
        F.lit(',"fundInceptionDate":'), epoch.cast("string"),
        F.lit(',"marketCap":'), (F.col("value") * 1000).cast("bigint").cast("string"),
        F.lit(',"corporateActions":[{"type":"split"}]'),
        F.lit(',"companyOfficers":{"ceo":"x"}'),
        F.lit("}"),
    )
    return e.select(
        (F.col("event_id") % 1000).alias("ticker_id"),
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("string")).otherwise(body).alias("info"),
    )


def filing(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d)
    docs = t.documents
    done = t.labels.select("doc_id").distinct().withColumn("_done", F.lit(True))
    return (
        docs.join(done, "doc_id", "left")
        .select(
            F.col("doc_id").alias("id"),
            (F.col("doc_id") % 100).alias("tickerId"),
            F.when(F.col("doc_id") % 3 == 0, "8-K").when(F.col("doc_id") % 3 == 1, "10-K")
            .otherwise("10-Q").alias("type"),
            F.concat(F.lit("acc-"), F.col("doc_id").cast("string")).alias("accessionNo"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("filingDate"),
            F.col("_done").isNotNull().alias("completed"),
            F.col("text"),
        )
    )


def attachment(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d).conversations
    return c.select(
        F.col("conv_id").alias("filing_id"),
        F.col("turn").alias("ordinal"),
        F.when(F.col("role") == "assistant", "EX-99.1").when(F.col("role") == "system", "COVER")
        .otherwise("8-K").alias("document_type"),
        "text",
    )


def insider_filing(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d).orders
    pr = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 50).alias("ticker_id"),
        F.col("o_custkey").alias("insider_id"),
        F.concat(F.lit("acc-"), F.col("o_orderkey").cast("string")).alias("accession_no"),
        F.when(pr == "1-URGENT", "3").when(pr == "2-HIGH", "4").when(pr == "3-MEDIUM", "4/A")
        .when(pr == "5-LOW", "5").otherwise("Form 4").alias("form_raw"),
        F.to_date("o_orderdate").alias("filing_date"),
        (F.col("o_orderstatus") == "F").alias("completed"),
    )


def _lines_by_order(spark: SparkSession, d: str) -> DataFrame:
    """The lines, those of an order together.  They move as stored: the text and
    decimal columns made of them are three times as wide.  All tables made of
    lines begin with this one exchange."""
    return _t(spark, d).lineitem.repartition("l_orderkey")


def insider_transaction_raw(spark: SparkSession, d: str) -> DataFrame:
    return _transaction_lines(_lines_by_order(spark, d))


def _transaction_lines(li: DataFrame) -> DataFrame:
    d4 = "decimal(20,4)"
    w = Window.partitionBy("l_orderkey", "l_linestatus", "l_linenumber").orderBy(
        *[F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag")]
    )
    rf = F.col("l_returnflag")
    return li.withColumn("rn", F.row_number().over(w)).select(
        F.when(F.col("l_partkey") % 101 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("insider_filing_id"),
        (F.col("l_linestatus") == "O").alias("is_derivative"),
        F.col("l_linenumber").alias("line_number"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("date")).otherwise(F.to_date("l_shipdate")).alias("transaction_date"),
        F.when(F.col("l_partkey") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("SEC"), (F.col("l_partkey") % 5).cast("string"))).alias("security_title"),
        F.when(rf == "A", "P").when(rf == "R", "S").otherwise("H").alias("transaction_code"),
        F.when(rf == "A", "A").when(rf == "R", "D").alias("acquired_disposed"),
        F.col("l_quantity").cast(d4).alias("shares"),
        F.col("l_extendedprice").cast(d4).alias("price_per_share"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast(d4))
        .otherwise((F.col("l_quantity") * 10).cast(d4)).alias("shares_owned_following"),
        "rn",
    )


def insider_transaction(spark: SparkSession, d: str) -> DataFrame:
    # a line without an order joins no filing; without such lines the exchange is that of the ownership rows of a join
    t = _transaction_lines(_lines_by_order(spark, d).where(F.col("l_orderkey").isNotNull())).where(F.col("rn") == 1).drop("rn")
    f = insider_filing(spark, d).select(
        F.col("id").alias("insider_filing_id"), "ticker_id", "insider_id"
    )
    return t.join(f, "insider_filing_id")


def evaluation_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d).documents
    return docs.select(
        F.col("source").alias("id"),
        F.concat(F.lit("run-"), F.col("source")).alias("run_name"),
        F.lit("baseline").alias("run_type"),
        F.lit("completed").alias("status"),
    ).distinct()


def evaluation_pairs(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d).documents
    n = F.col("n_chars")
    return docs.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("evaluation_run_id"),
        F.concat(F.lit("q"), F.col("doc_id").cast("string")).alias("question_id"),
        (n % 997).alias("control_avg_latency_ms"),
        (n % 1009).alias("experimental_avg_latency_ms"),
        ((n % 101) / F.lit(100.0)).cast("decimal(5,4)").alias("experimental_confidence_score"),
        (n % 13).alias("total_rows_retrieved"),
    )


def judgement_scores(spark: SparkSession, d: str) -> DataFrame:
    """Judge rows per labelled document: the first 1 + quality + toxic judges
    of (factual_grounding, completeness, consistency).  An explode over a fixed
    array, not a join."""
    labels = _t(spark, d).labels
    judges = F.array(*[F.struct(F.lit(j).alias("judge_type"), F.lit(k).alias("k"))
                       for j, k in (("factual_grounding", 1), ("completeness", 2), ("consistency", 3))])
    n = (F.lit(1) + F.col("quality") + F.col("toxic")).cast("int")
    ex = labels.select("doc_id", F.explode(F.slice(judges, 1, F.least(n, F.lit(3)))).alias("j")).select(
        "doc_id", F.col("j.judge_type").alias("judge_type"), F.col("j.k").alias("k"))
    c = (F.col("doc_id") * 7 + F.col("k")) % 101
    x = (F.col("doc_id") * 11 + F.col("k")) % 101
    return ex.select(
        F.col("doc_id").alias("evaluation_pair_id"),
        "judge_type",
        (c / F.lit(100.0)).cast("decimal(5,4)").alias("control_score"),
        (x / F.lit(100.0)).cast("decimal(5,4)").alias("experimental_score"),
        ((x - c) / F.lit(100.0)).cast("decimal(6,4)").alias("improvement_delta"),
        *[F.when(F.col("judge_type") == "consistency", (n % 17) / F.lit(8.0)).cast("decimal(6,4)").alias(f"semantic_entropy_{g}")
          for g, n in (("control", c), ("experimental", x))],
    )


def query_attempts(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d).events
    et = F.col("event_type")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("sub_query_trace_id"),
        F.when(et == "click", "sql").when(et == "view", "vector").otherwise("cypher").alias("query_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("execution_time_ms"),
        F.when((et == "error") | (F.col("event_id") % 7 == 0), F.lit("failed")).alias("error_message"),
        F.col("ts").alias("created_at"),
    )


def execution_traces(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d).events
    return e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("bigint"))
        .when(F.col("event_id") % 97 == 5, -F.col("event_id"))  # a parent that is not there
        .otherwise(F.col("event_id") - 1).alias("parent_trace_id"),
    )


def run_log(spark: SparkSession, d: str) -> DataFrame:
    return run_log_from_events(_t(spark, d).events)


def run_log_from_events(e: DataFrame) -> DataFrame:
    """Run-log view of an events table (works on batch and streaming frames)."""
    m = F.col("event_id") % 4
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("ticker_id"),
        F.when(m == 0, "stocks").when(m == 1, "financials").when(m == 2, "press_releases")
        .otherwise("insider_transactions").alias("process_name"),
        F.when(et == "purchase", "success").when(et == "error", "failed").otherwise("start").alias("action"),
        "ts",
        "event_id",
        F.when(et == "purchase", F.concat(F.lit('{"through": "'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}'))).alias("cursor"),
    )


def vertices(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d)

    def v(df, prefix, key, label, name):
        return df.select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"),
            F.lit(label).alias("label"),
            name.alias("name"),
        )

    seg = t.customer.select("c_mktsegment").distinct()
    base = (
        v(t.supplier, "s", "s_suppkey", "Company", F.col("s_name"))
        .unionByName(v(t.customer, "c", "c_custkey", "Company", F.col("c_name")))
        .unionByName(v(t.part, "p", "p_partkey", "Product", F.col("p_name")))
        .unionByName(v(t.orders, "o", "o_orderkey", "Metric",
                       F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))))
        .unionByName(v(t.nation, "n", "n_nationkey", "Risk", F.col("n_name")))
        .unionByName(v(seg, "g", "c_mktsegment", "Strategy", F.col("c_mktsegment")))
    )
    return base.select(
        "id", "label", "name",
        F.array("label").alias("labels"),
        F.create_map(F.lit("name"), F.col("name")).alias("props"),
    )


def edges(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d)

    def e(df, sp, sk, tp, tk, typ):
        return df.select(
            F.concat(F.lit(sp), sk.cast("string")).alias("src"),
            F.concat(F.lit(tp), tk.cast("string")).alias("dst"),
            F.lit(typ).alias("type"),
        )

    c, o, li, s = t.customer, t.orders, t.lineitem, t.supplier
    parts = [
        e(o, "c", F.col("o_custkey"), "o", F.col("o_orderkey"), "REPORTS"),
        e(s, "s", F.col("s_suppkey"), "n", F.col("s_nationkey"), "FACES"),
        e(c, "c", F.col("c_custkey"), "n", F.col("c_nationkey"), "FACES"),
        e(c, "c", F.col("c_custkey"), "g", F.col("c_mktsegment"), "IMPLEMENTS"),
        e(c.where(F.col("c_mktsegment") != "MACHINERY"), "g", F.col("c_mktsegment"), "n", F.col("c_nationkey"), "MENTIONED_IN"),
        e(li, "s", F.col("l_suppkey"), "p", F.col("l_partkey"), "PRODUCES"),
        e(li, "p", F.col("l_partkey"), "o", F.col("l_orderkey"), "RELATED_TO"),
        e(o.where(F.col("o_orderkey") % 3 == 0), "o", F.col("o_orderkey"), "o", F.col("o_orderkey") + 1, "RELATED_TO"),
        e(o.where(F.col("o_orderkey") % 2 == 0), "o", F.col("o_orderkey"), "s", F.col("o_orderkey") % 10, "MENTIONED_IN"),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.distinct()
    return u.select(
        F.concat_ws(">", "src", "type", "dst").alias("eid"), "src", "dst", "type",
        F.create_map(F.lit("kind"), F.col("type")).alias("props"),
    )


def statement_wide(spark: SparkSession, d: str) -> DataFrame:
    """Wide XBRL statement frames: one row per lineitem row, two period columns.

    Keys of the GAAP map are assigned by ``l_partkey % n``; ``seq`` is the row
    order inside the frame, kept as an orderable struct rather than a global
    row number so that no single-partition window is needed.
    """
    li = _t(spark, d).lineitem
    keys = sorted(schemas.GAAP_MAP, key=lambda r: r[0])
    n = len(keys)
    k = schemas.local_df(spark, [(i, key, stmt) for i, (key, _lc, stmt) in enumerate(keys)],
                         T.StructType([T.StructField("i", T.IntegerType()), T.StructField("key", T.StringType()),
                                       T.StructField("statement", T.StringType())]))
    acc = F.col("l_orderkey") % 500
    lm = F.col("l_linenumber") % 5
    key = F.col("key")
    return li.join(F.broadcast(k), (F.col("l_partkey") % n) == F.col("i")).select(
        F.concat(F.lit("acc-"), acc.cast("string")).alias("filing_accession"),
        (F.col("l_orderkey") % 50).alias("ticker_id"),
        (acc % 4 == 0).alias("is_annual"),
        F.when(F.col("l_suppkey") % 11 == 0, "cashflow").otherwise(F.col("statement")).alias("statement"),
        F.when(lm == 0, F.concat(F.lit("us-gaap:"), key))
        .when(lm == 1, F.concat(F.lit("us-gaap_"), key))
        .when(lm == 2, key)
        .when(lm == 3, F.concat(F.lit("abc_"), key))
        .otherwise(F.concat(F.lit("abc:Unknown"), key)).alias("concept"),
        F.when(F.col("l_quantity") > 25, key).alias("standard_concept"),
        (F.col("l_tax") == 0).alias("is_abstract"),
        F.lit(-6).alias("decimals"),
        F.lit("USD").alias("units"),
        F.lit(0).alias("scale"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
        .otherwise(F.col("l_extendedprice").cast("string")).alias("2023-09-30"),
        F.when(F.col("l_returnflag") == "N", F.lit("n/a"))
        .otherwise((F.col("l_extendedprice") * 2).cast("string")).alias("2024-02-15"),
        F.struct(*[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")]).alias("seq"),
    )


def statement_filing(spark: SparkSession, d: str) -> DataFrame:
    """The filings of the statement frames; their dates do not follow their names."""
    acc = (F.col("l_orderkey") % 500).alias("acc")
    return _t(spark, d).lineitem.select(acc).distinct().select(
        F.concat(F.lit("acc-"), F.col("acc").cast("string")).alias("filing_accession"), (F.col("acc") % 50).alias("ticker_id"),
        (F.col("acc") % 4 == 0).alias("is_annual"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("acc") * 37 % 401).cast("int")).alias("filing_date"))


def ownership_rows(spark: SparkSession, d: str) -> DataFrame:
    """Vendor ownership tables as text columns, one row per lineitem row.

    Filings whose key is a multiple of 4 are Form 3 holdings frames (they carry
    a security type); ``src_order`` is the row order inside a filing's frame.
    """
    li = _lines_by_order(spark, d)
    holding = F.col("l_orderkey") % 4 == 0
    rf = F.col("l_returnflag")
    return li.select(
        F.col("l_orderkey").alias("filing_id"),
        F.when(holding, F.lit("3")).otherwise(F.lit("4")).alias("form"),
        holding.alias("has_security_type"),
        F.when(holding, F.when(F.col("l_linestatus") == "O", F.lit("Stock Option (derivative)"))
               .otherwise(F.lit("Common Stock"))).alias("security_type"),
        F.col("l_quantity").cast("string").alias("shares"),
        F.when(holding & (F.col("l_linestatus") == "O"), (F.col("l_quantity") * 2).cast("string")).alias("underlying_shares"),
        F.when(rf == "R", F.lit("Direct")).when(rf == "A", F.lit("Indirect")).alias("ownership_type"),
        F.when(F.col("l_tax") == 0, F.lit("n/a")).otherwise(F.col("l_shipdate").cast("string")).alias("date"),
        F.when(F.col("l_partkey") % 5 == 0, F.lit(None).cast("string"))
        .when(F.col("l_partkey") % 5 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("SEC"), (F.col("l_partkey") % 5).cast("string"))).alias("security_title"),
        F.when(~holding, F.when(rf == "A", F.lit("P")).when(rf == "R", F.lit("S")).otherwise(F.lit(" M "))).alias("code"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
        .otherwise((F.col("l_quantity") * 10).cast("string")).alias("remaining_shares"),
        F.when(rf == "A", F.lit("Purchase")).when(rf == "R", F.lit("Sale")).otherwise(F.lit("  ")).alias("transaction_type"),
        F.struct(*[F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                      "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")]).alias("src_order"),
    )


def insider_header_raw(spark: SparkSession, d: str) -> DataFrame:
    """Ownership filing headers as delivered: text dates, optional names, owner list."""
    t = _t(spark, d)
    o, c = t.orders, t.customer
    j = o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left")
    pr = F.col("o_orderpriority")
    k = F.col("o_orderkey")
    return j.select(
        k.alias("id"),
        (F.col("o_custkey") % 50).alias("ticker_id"),
        F.concat(F.lit("acc-"), k.cast("string")).alias("accession_no"),
        F.when(pr == "1-URGENT", "Form 3").when(pr == "2-HIGH", " 4 ").when(pr == "3-MEDIUM", "Form 4/A")
        .when(pr == "5-LOW", "5").otherwise(F.lit(None).cast("string")).alias("form_raw"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 11 == 1, F.lit("not a date"))
        .otherwise(F.col("o_orderdate").cast("string")).alias("filing_date_raw"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_add(F.to_date("o_orderdate"), 1).cast("string")).alias("reporting_period_raw"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit("   "))
        .otherwise(F.col("c_name")).alias("insider_name"),
        F.when(k % 7 == 0, F.array().cast("array<struct<name:string>>"))
        .otherwise(F.array(F.struct(F.upper(F.col("c_name")).alias("name")))).alias("owners"),
    )


def insider_dim(spark: SparkSession, d: str) -> DataFrame:
    """Stored insiders: customers of the first ten nations; a cik for most."""
    c = _t(spark, d).customer
    return c.where(F.col("c_nationkey") < 10).select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("cik"),
        F.col("c_name").alias("name"),
    )


def insider_incoming(spark: SparkSession, d: str) -> DataFrame:
    """Owners named on filings: (cik, name, seq) per order; names change over time."""
    t = _t(spark, d)
    o, c = t.orders, t.customer
    j = o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    ck = F.col("o_custkey")
    return j.select(
        F.col("o_orderkey").alias("filing_id"),
        F.when(ck % 4 == 0, F.lit(None).cast("string")).otherwise(F.lpad(ck.cast("string"), 10, "0")).alias("cik"),
        F.when(ck % 4 == 0, F.col("c_name"))
        .otherwise(F.concat(F.col("c_name"), F.lit(" #"), (F.col("o_orderkey") % 3).cast("string"))).alias("name"),
        F.struct(F.to_date("o_orderdate").alias("d"), F.col("o_orderkey").alias("k")).alias("seq"),
    )


FIXTURES = {
    "ticker": ticker,
    "price": price,
    "split": split,
    "company_info": company_info,
    "company_info_wide": company_info_wide,
    "filing": filing,
    "attachment": attachment,
    "insider_filing": insider_filing,
    "insider_transaction_raw": insider_transaction_raw,
    "insider_transaction": insider_transaction,
    "evaluation_runs": evaluation_runs,
    "evaluation_pairs": evaluation_pairs,
    "judgement_scores": judgement_scores,
    "query_attempts": query_attempts,
    "execution_traces": execution_traces,
    "run_log": run_log,
    "vertices": vertices,
    "edges": edges,
    "statement_wide": statement_wide,
    "ownership_rows": ownership_rows,
    "insider_header_raw": insider_header_raw,
    "insider_dim": insider_dim,
    "insider_incoming": insider_incoming,
}


def load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return FIXTURES[name](spark, d)


def filing_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of 10-K / 10-Q filings: line k of the filing text is item 'Item k'."""
    f = filing(spark, d).where(F.col("type").isin("10-K", "10-Q"))
    return f.select(F.col("id").alias("filing_id"), F.posexplode(F.split("text", "\n")).alias("pos", "content")).select(
        "filing_id", F.concat(F.lit("Item "), F.col("pos").cast("string")).alias("item_key"), "content")


FIXTURES["filing_items"] = filing_items
