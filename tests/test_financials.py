"""Concept mapping, statement rows and merge pick on literal frames."""
import datetime as dt

from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.operators import financials as fin
from ticklake.operators import quality


def _norm(spark, s):
    df = spark.createDataFrame([(s,)], "c string")
    return df.select(fin.normalize_name(F.col("c"))).first()[0]


def test_normalize_names(spark):
    assert _norm(spark, "{http://fasb.org/us-gaap/2024}Assets") == "assets"
    assert _norm(spark, "us-gaap:Revenues") == "revenues"
    assert _norm(spark, "us-gaap_Revenues") == "usgaaprevenues"


def _map(spark, rows, overrides=()):
    df = spark.createDataFrame(rows, "concept_s string, std_for_map string, statement string")
    ov = fin.overrides_df(spark, overrides)
    out = fin.map_line_codes(df, schemas.gaap_map_df(spark), ov)
    return {(r.concept_s, r.statement): r.line_code for r in out.collect()}


def test_map_line_codes(spark):
    got = _map(spark, [
        ("us-gaap:Revenues", "Revenues", "income"),
        ("us-gaap:Revenues", "Revenues", "balance"),      # statement differs -> no map
        ("us-gaap_Revenues", None, "income"),              # prefix stripped
        ("aapl_Goodwill", None, "balance"),                # issuer remainder
        ("custom:CustomMetric", None, "income"),           # override (statement ignored)
    ], overrides=[("custom:CustomMetric", "revenue")])
    assert got[("us-gaap:Revenues", "income")] == "revenue"
    assert got[("us-gaap:Revenues", "balance")] is None
    assert got[("us-gaap_Revenues", "income")] == "revenue"
    assert got[("aapl_Goodwill", "balance")] == "goodwill"
    assert got[("custom:CustomMetric", "income")] == "revenue"


def test_statement_to_facts_and_merge(spark):
    frame = spark.createDataFrame(
        [("acc-1", 1, True, "us-gaap:Revenues", "Revenues", False, -6, "USD", 0, "1000000", (1,)),
         ("acc-1", 1, True, "us-gaap:Assets", None, True, -6, "USD", 0, None, (2,))],
        "filing_accession string, ticker_id int, is_annual boolean, concept string, standard_concept string, "
        "is_abstract boolean, decimals int, units string, scale int, `2024-12-31` string, seq struct<r:int>")
    c, u = fin.statement_candidates(frame, "income", F.col("is_annual"), schemas.gaap_map_df(spark))
    rows = c.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.line_code, r.value, r.fiscal_period_end, r.period_type) == ("revenue", 1000000, dt.date(2024, 12, 31),
                                                                           "annual")


def test_merge_anchored_beats_unanchored(spark):
    base = dict(filing_accession="a", ticker_id=1, fiscal_year=2024, fiscal_period_end=dt.date(2024, 12, 31),
                period_type="annual", line_code="operating_income")
    rows = [dict(base, value=100, source_concept="OtherOperatingIncome", anchored=False, seq=(0, 0, 1)),
            dict(base, value=200, source_concept="OperatingIncomeLoss", anchored=True, seq=(0, 0, 2))]
    df = spark.createDataFrame(rows, "filing_accession string, ticker_id int, fiscal_year int, "
                                     "fiscal_period_end date, period_type string, line_code string, value long, "
                                     "source_concept string, anchored boolean, seq struct<s:int,p:int,r:int>")
    out = fin.merge_facts(df).collect()
    assert len(out) == 1 and out[0].value == 200


def test_merge_preferred_name_wins(spark):
    base = dict(filing_accession="a", ticker_id=1, fiscal_year=2024, fiscal_period_end=dt.date(2024, 12, 31),
                period_type="annual", line_code="net_income")
    rows = [dict(base, value=1, source_concept="ProfitLoss", anchored=True, seq=(0, 0, 1)),
            dict(base, value=2, source_concept="us-gaap:NetIncomeLoss", anchored=False, seq=(0, 0, 2))]
    df = spark.createDataFrame(rows, "filing_accession string, ticker_id int, fiscal_year int, "
                                     "fiscal_period_end date, period_type string, line_code string, value long, "
                                     "source_concept string, anchored boolean, seq struct<s:int,p:int,r:int>")
    assert fin.merge_facts(df).first().value == 2


def test_period_columns_and_latest(spark):
    df = spark.createDataFrame([("x", "1", "2", 3)], "concept string, `2024-12-31` string, `bad` string, decimals int")
    assert fin.period_columns(df) == ["2024-12-31"]
    assert fin.latest_column_date(df) == dt.date(2024, 12, 31)


def test_mapping_integrity(spark):
    """Q4: every mapped line code is seeded with the same statement."""
    bad = quality.check_mapping(schemas.gaap_map_df(spark), schemas.financial_line_df(spark))
    assert bad.where(F.col("problem") != "line").count() == 0


def test_rows_are_not_dealt_by_concept(spark, monkeypatch):
    """One concept on most rows: the mapping goes to the rows; a mapping past the limit is joined by key."""
    rows = [("a", 1, "income", "us-gaap:Revenues", None, str(i), i) for i in range(50)] + [("a", 1, "income", "x:Other", None, "5", 99)]
    df = spark.createDataFrame(rows, "filing_accession string, ticker_id int, statement string, concept string, standard_concept string, `2024-03-31` string, seq int")

    def run():
        cands, unmapped = fin.statement_candidates(df, None, F.lit(False), schemas.gaap_map_df(spark))
        return cands, sorted((r.line_code, float(r.value)) for r in cands.collect()), [r.concept for r in unmapped.collect()]

    cands, got, unmapped = run()
    assert "strategy=broadcast" in cands._jdf.queryExecution().optimizedPlan().toString()
    assert got == sorted(("revenue", float(i)) for i in range(50)) and unmapped == ["x:Other"]
    monkeypatch.setattr(fin, "MAX_MAPPED", 0)
    assert run()[1:] == (got, unmapped)
