"""Registered queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Each query reads whole test tables through ``ticklake.sources.fixtures`` and
runs one operator of the library on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import insiders
from ..sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        CATALOG[name] = fn
        return fn
    return deco


@register("W1_position_current")
def q_position_current(spark, d):
    return insiders.position_current(fx.insider_transaction(spark, d), fx.insider_filing(spark, d))


# --- evaluation runs and traces --------------------------------------------
from ..operators import evals, quality  # noqa: E402


@register("A1_run_summary")
def q_run_summary(spark, d):
    return evals.run_summary(fx.evaluation_runs(spark, d), fx.evaluation_pairs(spark, d), fx.judgement_scores(spark, d))


@register("J4_pair_details")
def q_pair_details(spark, d):
    return evals.pair_details(fx.evaluation_runs(spark, d), fx.evaluation_pairs(spark, d), fx.judgement_scores(spark, d))


@register("A3_hallucination_rate")
def q_hallucination_rate(spark, d):
    return evals.hallucination_rate(fx.evaluation_runs(spark, d), fx.evaluation_pairs(spark, d),
                                    fx.judgement_scores(spark, d), 0.6)


@register("A2_success_rates")
def q_success_rates(spark, d):
    return evals.success_rates(fx.query_attempts(spark, d))


@register("P20_sql_attempts")
def q_sql_attempts(spark, d):
    return evals.attempts_view(fx.query_attempts(spark, d), "sql")


@register("P20_vector_attempts")
def q_vector_attempts(spark, d):
    return evals.attempts_view(fx.query_attempts(spark, d), "vector")


@register("G18_trace_tree")
def q_trace_tree(spark, d):
    return evals.trace_tree(spark, fx.execution_traces(spark, d))


# --- data quality -------------------------------------------------------------
INSIDER_FILING_RULES = {
    "form_type_domain": "form_raw IN ('3', '4', '5', '3/A', '4/A', '5/A')",
    "filing_date_present": "filing_date IS NOT NULL",
}
JUDGEMENT_RULES = {
    "control_score_range": "control_score BETWEEN 0 AND 1",
    "experimental_score_range": "experimental_score BETWEEN 0 AND 1",
    "improvement_range": "improvement_delta BETWEEN -1 AND 1",
    "judge_type_domain": "judge_type IN ('factual_grounding', 'completeness', 'consistency')",
}
LEDGER_RULES = {
    "acquired_disposed_domain": "acquired_disposed IN ('A', 'D')",
    "code_length": "length(transaction_code) <= 2",
    "shares_non_negative": "shares >= 0",
}


@register("Q1_rules_insider_filing")
def q_rules_insider_filing(spark, d):
    return quality.check_rules(fx.insider_filing(spark, d), INSIDER_FILING_RULES)


@register("Q1_rules_judgement")
def q_rules_judgement(spark, d):
    return quality.check_rules(fx.judgement_scores(spark, d), JUDGEMENT_RULES)


@register("Q1_rules_ledger")
def q_rules_ledger(spark, d):
    return quality.check_rules(fx.insider_transaction_raw(spark, d), LEDGER_RULES)


@register("Q2_duplicate_ledger_keys")
def q_duplicate_ledger_keys(spark, d):
    from ..sources.tables import read_table
    return quality.duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("Q2_duplicate_judgements")
def q_duplicate_judgements(spark, d):
    from pyspark.sql import functions as F
    s = fx.judgement_scores(spark, d)  # as delivered: every 50th pair is judged again
    again = s.where(F.col("evaluation_pair_id") % 50 == 0)
    return quality.duplicate_keys(s.unionByName(again), ["evaluation_pair_id", "judge_type"])


@register("Q3_orphan_traces")
def q_orphan_traces(spark, d):
    t = fx.execution_traces(spark, d)
    return quality.orphans(t, t, "parent_trace_id", "id")


@register("Q3_orphan_ledger_lines")
def q_orphan_ledger_lines(spark, d):
    return quality.orphans(fx.insider_transaction_raw(spark, d).drop("rn"), fx.insider_filing(spark, d),
                           "insider_filing_id", "id")


# --- insiders ---------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from .. import schemas  # noqa: E402
from ..sources import sinks  # noqa: E402

TODAY = "2025-01-01"


@register("P17_insider_header")
def q_insider_header(spark, d):
    return insiders.insider_header(fx.insider_header_raw(spark, d), TODAY)


@register("P18_ledger_rows")
def q_ledger_rows(spark, d):
    return insiders.ledger_rows(fx.ownership_rows(spark, d))


@register("S11_resolve_insiders")
def q_resolve_insiders(spark, d):
    return insiders.resolve_insiders(fx.insider_dim(spark, d), fx.insider_incoming(spark, d))


@register("J7_code_labels")
def q_code_labels(spark, d):
    led = insiders.with_code_labels(fx.insider_transaction(spark, d), schemas.transaction_code_df(spark))
    return led.select("insider_filing_id", "is_derivative", "line_number", "transaction_code",
                      "code_label", "code_description")


@register("A10_filing_rollup")
def q_filing_rollup(spark, d):
    led = fx.insider_transaction(spark, d).withColumn(
        "line_number", F.col("line_number") * 2 + F.col("is_derivative").cast("int"))
    return insiders.filing_rollup(led, schemas.transaction_code_df(spark))


@register("W5_insider_cursor")
def q_insider_cursor(spark, d):
    return insiders.insider_cursor(fx.insider_filing(spark, d))


@register("W5_filing_cursor")
def q_filing_cursor(spark, d):
    return insiders.filing_cursor(fx.filing(spark, d))


# --- keyed writes -------------------------------------------------------------
LEDGER_KEYS = ["insider_filing_id", "is_derivative", "line_number"]
LEDGER_UPDATE = ["transaction_date", "security_title", "transaction_code", "acquired_disposed", "shares",
                 "price_per_share", "shares_owned_following"]


def _ledger_target_source(spark, d):
    raw = fx.insider_transaction_raw(spark, d)
    # one condition that holds the row number stays above the exchange, which target and source then share
    target = raw.where(F.when(~F.col("is_derivative"), F.col("rn")) == 1).drop("rn")
    source = raw.where((F.col("rn") >= 2) | F.col("is_derivative"))
    return target, source


@register("S8_seed_codes")
def q_seed_codes(spark, d):
    led = fx.insider_transaction(spark, d)
    other = F.concat(F.lit("Other ("), F.col("transaction_code"), F.lit(")"))
    existing = led.select(F.col("transaction_code").alias("code"), other.alias("label"),
                          other.alias("description")).distinct()
    return sinks.seed(existing, schemas.transaction_code_df(spark), ["code"])


@register("S9_upsert_ledger")
def q_upsert_ledger(spark, d):
    target, source = _ledger_target_source(spark, d)
    return sinks.upsert(target, source, LEDGER_KEYS, LEDGER_UPDATE, order=["rn"], winner="last")


@register("S10_insert_ignore_ledger")
def q_insert_ignore_ledger(spark, d):
    target, source = _ledger_target_source(spark, d)
    return sinks.insert_ignore(target, source, LEDGER_KEYS, order=["rn"])


@register("S12_update_ticker")
def q_update_ticker(spark, d):
    from ..sources.tables import read_table
    c = read_table(spark, d, "customer").where(F.col("c_nationkey") < 5)
    src = c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, F.upper("c_name")).alias("name"),
        F.lit("EQUITY").alias("quote_type"),
    )
    return sinks.update_columns(fx.ticker(spark, d), src, "id", ["name", "quote_type"], keep_on_null=True)


@register("S15_delete_cascade")
def q_delete_cascade(spark, d):
    from ..sources.tables import read_table
    gone = read_table(spark, d, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("id"))
    state = sinks.delete_with_rules(
        fx.insider_filing(spark, d), "id", gone,
        {"ledger": (fx.insider_transaction(spark, d), "insider_filing_id", "CASCADE")})
    return state["ledger"].select(*LEDGER_KEYS, "shares")


# --- financial facts ------------------------------------------------------------
from ..functions import coerce as C  # noqa: E402
from ..operators import financials as fin  # noqa: E402

FACT_COLS = ["filing_accession", "ticker_id", "fiscal_year", "fiscal_period_end", "period_type", "quarter",
             "line_code", "value", "decimals", "unit", "scale", "source_concept", "source_standard_concept",
             "anchored"]


def _frames(spark, d):
    """Statement frames in even partitions: the work on each row is heavy, whatever the files' row groups are."""
    return fx.statement_wide(spark, d).hint("rebalance", "filing_accession")


def _facts(spark, d):
    merged, cands, unmapped = fin.financial_facts(_frames(spark, d), schemas.gaap_map_df(spark))
    return merged, cands, unmapped


def fact_table(spark, d):
    """Merged facts of every filing upserted into an empty fact table in
    accession order (a later filing replaces an earlier one on the same grain)."""
    merged, _, _ = _facts(spark, d)
    empty = merged.select(*FACT_COLS).limit(0)
    return sinks.upsert(empty, merged.select(*FACT_COLS), fin.GRAIN, order=["filing_accession"], winner="last")


@register("P10_statement_rows")
def q_statement_rows(spark, d):
    rows = fin.statement_rows(fx.statement_wide(spark, d))
    return rows.select("filing_accession", "ticker_id", "statement", "concept_s", "std_concept")


@register("P9_unpivot_periods")
def q_unpivot_periods(spark, d):
    w = fx.statement_wide(spark, d)
    long = fin.unpivot_periods(w, ["filing_accession", "ticker_id", "concept"])
    return long.select("filing_accession", "ticker_id", "concept", "period",
                       C.extract_numeric(F.col("raw_value")).alias("value"))


@register("J1_map_line_codes")
def q_map_line_codes(spark, d):
    rows = fin.statement_rows(_frames(spark, d)).withColumn(
        "std_for_map", F.coalesce(F.col("std_concept"), fin.infer_standard_concept("concept_s")))
    return fin.map_line_codes(rows, schemas.gaap_map_df(spark))


@register("U1_union_candidates")
def q_union_candidates(spark, d):
    _, cands, _ = _facts(spark, d)
    return cands.drop("seq")


@register("W3_merge_facts")
def q_merge_facts(spark, d):
    merged, _, _ = _facts(spark, d)
    return merged.select(*FACT_COLS)


@register("A6_merge_conflicts")
def q_merge_conflicts(spark, d):
    _, cands, _ = _facts(spark, d)
    return fin.merge_conflicts(cands)


@register("A7_unmapped_concepts")
def q_unmapped_concepts(spark, d):
    _, _, unmapped = _facts(spark, d)
    return fin.unmapped_concepts(unmapped)


@register("C2_financial_facts")
def q_financial_facts(spark, d):
    return fact_table(spark, d)


@register("W4_latest_periods")
def q_latest_periods(spark, d):
    return fin.latest_periods(fact_table(spark, d))


@register("A11_ratios")
def q_ratios(spark, d):
    return fin.ratios(fact_table(spark, d))


@register("J6_facts_by_term")
def q_facts_by_term(spark, d):
    return fin.facts_by_term(fact_table(spark, d), schemas.financial_line_df(spark), "Cash").select(
        "ticker_id", "fiscal_year", "fiscal_period_end", "period_type", "line_code", "value", "display_name")


@register("P12_fiscal_periods")
def q_fiscal_periods(spark, d):
    from ..sources.tables import read_table
    days = read_table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    both = days.withColumn("is_annual", F.lit(True)).unionByName(days.withColumn("is_annual", F.lit(False)))
    a = F.col("is_annual")
    return both.select("d", "is_annual", C.fiscal_period_end(F.col("d"), a).alias("fiscal_period_end"),
                       C.fiscal_quarter(F.col("d"), a).alias("quarter"), F.year("d").alias("fiscal_year"),
                       C.period_type(a).alias("period_type"))


@register("P13_optional_values")
def q_optional_values(spark, d):
    r = fx.ownership_rows(spark, d)
    return r.select("filing_id", C.opt_int(F.col("shares")).alias("shares_int"),
                    C.opt_int(F.col("date")).alias("date_int"), C.opt_str(F.col("code")).alias("code"),
                    C.opt_str(F.col("transaction_type")).alias("kind"), C.to_int(F.col("price")).alias("price_int"))


# --- property graph -----------------------------------------------------------
from ..operators import graph as G  # noqa: E402


def _g(spark, d):
    return fx.vertices(spark, d), fx.edges(spark, d)


@register("G1_top_reporters")
def q_top_reporters(spark, d):
    return G.top_reporters(*_g(spark, d))


@register("G2_risk_networks")
def q_risk_networks(spark, d):
    return G.risk_networks(*_g(spark, d))


@register("G3_metric_chains")
def q_metric_chains(spark, d):
    return G.metric_chains(*_g(spark, d))


@register("G4_frequent_edges")
def q_frequent_edges(spark, d):
    return G.frequent_edges(*_g(spark, d))


@register("G5_ego")
def q_ego(spark, d):
    return G.ego(*_g(spark, d), name="Customer#000000001")


@register("G6_strategy_networks")
def q_strategy_networks(spark, d):
    return G.strategy_networks(*_g(spark, d))


@register("G7_product_metrics")
def q_product_metrics(spark, d):
    return G.product_metrics(*_g(spark, d))


@register("G8_cross_mentions")
def q_cross_mentions(spark, d):
    return G.cross_mentions(*_g(spark, d))


@register("G9_rel_samples")
def q_rel_samples(spark, d):
    return G.rel_samples(*_g(spark, d))


@register("G10_triplet_view")
def q_triplet_view(spark, d):
    return G.triplet_view(*_g(spark, d))


@register("G11_pattern_counts")
def q_pattern_counts(spark, d):
    return G.pattern_counts(*_g(spark, d))


@register("G12_label_properties")
def q_label_properties(spark, d):
    return G.label_properties(fx.vertices(spark, d))


@register("G13_rel_properties")
def q_rel_properties(spark, d):
    return G.rel_properties(fx.edges(spark, d))


@register("G14_schema_overview")
def q_schema_overview(spark, d):
    return G.schema_overview(*_g(spark, d))


@register("G15_network_density")
def q_network_density(spark, d):
    return G.network_density(*_g(spark, d), threshold=20)


@register("G16_important_chains")
def q_important_chains(spark, d):
    return G.important_chains(*_g(spark, d))


@register("G17_meta_graph")
def q_meta_graph(spark, d):
    return G.meta_graph(*_g(spark, d))


@register("L1_top_k_orders")
def q_top_k_orders(spark, d):
    from ..sources.tables import read_table
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return G.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@register("L2_sample_edges")
def q_sample_edges(spark, d):
    return G.sample_k(fx.edges(spark, d).select("eid", "src", "dst", "type"), "eid", 25, seed=7)


@register("L3_first_k_per_label")
def q_first_k_per_label(spark, d):
    return G.first_k(fx.vertices(spark, d).select("id", "label"), ["label"], [F.col("id")], 100)


# --- filing text --------------------------------------------------------------
from ..functions import text as TX  # noqa: E402
from ..operators import text as TO  # noqa: E402


@register("T1_clean_text")
def q_clean_text(spark, d):
    return fx.filing(spark, d).select("id", TX.clean_filing_text(F.col("text")).alias("cleaned"))


@register("T2_extract_title")
def q_extract_title(spark, d):
    return fx.filing(spark, d).select("id", TX.extract_title(F.col("text")).alias("title"))


@register("T4_squash")
def q_squash(spark, d):
    return fx.attachment(spark, d).select("filing_id", "ordinal", TX.squash(F.col("text")).alias("text"))


@register("T5_sentences")
def q_sentences(spark, d):
    f = fx.filing(spark, d)
    return f.select("id", F.posexplode(TX.sentences(F.col("text"))).alias("pos", "sentence")).select(
        "id", (F.col("pos") + 1).alias("sentence_no"), "sentence")


@register("T8_html_to_text")
def q_html_to_text(spark, d):
    from ..sources.tables import read_table
    return read_table(spark, d, "pages").select("page_id", TX.html_to_text(F.col("html")).alias("text"))


@register("S6_pick_attachment")
def q_pick_attachment(spark, d):
    return TO.pick_attachment(fx.attachment(spark, d))


@register("P23_mdna_sections")
def q_mdna_sections(spark, d):
    return TO.mdna_sections(fx.filing(spark, d), fx.filing_items(spark, d), schemas.mdna_rules_df(spark))


@register("T3_markdown")
def q_markdown(spark, d):
    from ..sources.tables import read_table
    # heavy work on each row: ask for even partitions, whatever the files' row groups are
    pages = read_table(spark, d, "pages").select("page_id", "html").hint("rebalance", "page_id")
    return TO.markdown_rows(pages, ["page_id"], TX.html_to_text(F.col("html")), size=F.length("html"))


@register("T6_chunks")
def q_chunks(spark, d):
    texts = fx.filing(spark, d).select("id", "text").hint("rebalance", "id")
    return TO.chunk(texts, "id", "text", n=500, clean=True)


@register("T7_press_release_chunks")
def q_press_release_chunks(spark, d):
    att = TO.pick_attachment(fx.attachment(spark, d))
    return TO.statement_chunks(att, "filing_id", "text", kind="8-K")


@register("T7_mdna_chunks")
def q_mdna_chunks(spark, d):
    sec = TO.mdna_sections(fx.filing(spark, d), fx.filing_items(spark, d), schemas.mdna_rules_df(spark))
    return TO.statement_chunks(sec, "filing_id", "content", kind="MDNA", section_col="section_id",
                               title_col="section_title")


# --- market data ----------------------------------------------------------------
from ..operators import market as MK  # noqa: E402

AS_OF = "2024-02-01"
EXPECTED_BAR = "1998-08-01"
CAL_YEARS = (1990, 2030)


def _info(spark, d):
    return MK.parse_company_info(fx.company_info_wide(spark, d).hint("rebalance", "event_id"))


@register("S1_prices")
def q_prices(spark, d):
    return MK.clean_prices(fx.price(spark, d))


@register("S2_splits")
def q_splits(spark, d):
    return fx.split(spark, d)


@register("P1_ticker_profile")
def q_ticker_profile(spark, d):
    return MK.ticker_profile(_info(spark, d), keep=("ticker_id", "event_id"))


@register("P2_epoch_to_date")
def q_epoch_to_date(spark, d):
    e = fx.company_info_wide(spark, d)
    raw = F.get_json_object("info", "$.fundInceptionDate")
    return e.select("event_id", C.epoch_to_date(raw).alias("d1"),
                    C.epoch_to_date(F.concat(F.lit("x"), raw)).alias("d2"),
                    C.epoch_to_date((F.col("event_id") % 3 - 1).cast("string")).alias("d3"))


@register("P3_fundamentals")
def q_fundamentals(spark, d):
    return MK.fundamentals(_info(spark, d).select("ticker_id", "event_id", "info"), AS_OF).withColumn(
        "event_id", F.lit(None).cast("bigint")).drop("event_id")


@register("A5_price_cursor")
def q_price_cursor(spark, d):
    return MK.price_cursor(fx.price(spark, d), EXPECTED_BAR)


@register("P21_newer_prices")
def q_newer_prices(spark, d):
    p = fx.price(spark, d)
    stored = p.where(F.col("date") < F.lit("1997-01-01").cast("date"))
    return MK.newer_than(p.select("tickerId", "date", "close"), stored)


@register("W7_moving_stats")
def q_moving_stats(spark, d):
    return MK.moving_stats(fx.price(spark, d))


@register("J9_split_adjust")
def q_split_adjust(spark, d):
    return MK.split_adjust(fx.price(spark, d), fx.split(spark, d))


@register("P24_market_days")
def q_market_days(spark, d):
    days = fx.price(spark, d).select("date").distinct()
    return MK.market_days(days, "date", MK.holiday_dim(spark, *CAL_YEARS))


# --- incremental planning -----------------------------------------------------------
from ..operators import incremental as INC  # noqa: E402

FILING_LIMITS = {"8-K": 5, "10-K": 2, "10-Q": 3}
PRESS_LIMITS = {"8-K": 5, "10-K": 2}
NOW = "2024-01-30 12:00:00"


def _requested(spark, d):
    from ..sources.tables import read_table
    o = read_table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("symbol"))


@register("P5_edgar_eligible")
def q_edgar_eligible(spark, d):
    return INC.edgar_eligible(fx.ticker(spark, d)).select("id", "symbol", "quote_type", "edgar_eligible")


@register("P6_active_tickers")
def q_active_tickers(spark, d):
    return INC.active_tickers(fx.ticker(spark, d))


@register("P7_resolve_tickers")
def q_resolve_tickers(spark, d):
    from ..sources.tables import read_table
    o = read_table(spark, d, "orders").join(read_table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey") % 3
    names = o.select(F.when(k == 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
                     .when(k == 1, F.lower("c_name"))
                     .otherwise(F.concat(F.lit("nobody "), F.col("o_custkey").cast("string"))).alias("name"))
    return INC.resolve_tickers(fx.ticker(spark, d), names)


@register("P8_select_tickers")
def q_select_tickers(spark, d):
    return INC.select_tickers(INC.active_tickers(fx.ticker(spark, d)), _requested(spark, d), max_n=100)


@register("U3_missing_tickers")
def q_missing_tickers(spark, d):
    return INC.missing_tickers(INC.active_tickers(fx.ticker(spark, d)), _requested(spark, d))


@register("W2_latest_filings")
def q_latest_filings(spark, d):
    return INC.latest_filings(fx.filing(spark, d).drop("text"), FILING_LIMITS).select(
        "id", "tickerId", "type", "filingDate")


@register("P25_filing_record")
def q_filing_record(spark, d):
    f = fx.filing(spark, d).select("id", "accessionNo", "tickerId", "type",
                                   F.col("filingDate").cast("string").alias("filing_date_raw"))
    return INC.filing_record(f, TODAY)


def _stored_filings(spark, d):
    return fx.filing(spark, d).drop("text").where(F.col("id") % 2 == 0)


@register("J5_pending_filings")
def q_pending_filings(spark, d):
    cands = INC.latest_filings(fx.filing(spark, d).drop("text"), FILING_LIMITS).select("accessionNo", "tickerId", "type")
    return INC.pending_filings(cands, _stored_filings(spark, d))


@register("A4_should_run")
def q_should_run(spark, d):
    cands = INC.latest_filings(fx.filing(spark, d).drop("text"), PRESS_LIMITS).select("accessionNo", "tickerId")
    return INC.should_run(cands, _stored_filings(spark, d))


@register("A8_run_counters")
def q_run_counters(spark, d):
    return INC.run_counters(fx.run_log(spark, d))


@register("A9_run_state")
def q_run_state(spark, d):
    return INC.run_state(fx.run_log(spark, d))


@register("I4_stale_runs")
def q_stale_runs(spark, d):
    return INC.stale_runs(INC.run_state(fx.run_log(spark, d)), NOW)


@register("I5_startable")
def q_startable(spark, d):
    return INC.startable(INC.run_state(fx.run_log(spark, d)), NOW).select("ticker_id", "process_name", "startable")


@register("I6_plan_runs")
def q_plan_runs(spark, d):
    stocks = MK.price_cursor(fx.price(spark, d), EXPECTED_BAR).select(
        F.col("tickerId").alias("ticker_id"), F.lit("stocks").alias("process_name"),
        (~F.col("up_to_date")).alias("has_new_data"))
    cands = INC.latest_filings(fx.filing(spark, d).drop("text"), PRESS_LIMITS).select("accessionNo", "tickerId")
    press = INC.should_run(cands, _stored_filings(spark, d)).select(
        F.col("tickerId").alias("ticker_id"), F.lit("press_releases").alias("process_name"),
        F.col("should_run").alias("has_new_data"))
    checks = stocks.unionByName(press)
    return INC.plan_runs(fx.ticker(spark, d), checks, INC.run_state(fx.run_log(spark, d)), NOW)


@register("I7_new_statements")
def q_new_statements(spark, d):
    f = fx.filing(spark, d).drop("text")
    pointers = f.where(F.col("completed") & (F.col("id") % 3 != 0)).groupBy("tickerId", "type").agg(
        F.max("filingDate").alias("pointer_date"))
    return INC.new_statements(f, pointers)


# --- vectors --------------------------------------------------------------------
from ..operators import vector_index as VIX  # noqa: E402
from ..operators import vectors as VEC  # noqa: E402


def _emb(spark, d):
    from ..sources.tables import read_table
    return read_table(spark, d, "embeddings").select("vec_id", "embedding")


@register("V1_knn")
def q_knn(spark, d):
    e = _emb(spark, d)
    return VEC.knn(e, e, 5, exclude_self=True)


def _vector_index(spark, d):
    from ..session import shared_path
    return VIX.build(_emb(spark, d), shared_path(spark, f"vector-index-{uuid.uuid4().hex}"))


@register("V2_ivf_search")
def q_ivf_search(spark, d):
    return VIX.search(_emb(spark, d), _vector_index(spark, d), 5, exclude_self=True)


@register("V2_index_quality")
def q_index_quality(spark, d):
    """Recall against the exact search, and the shares of all rows that a query
    reads as codes and as vectors, on average."""
    e = _emb(spark, d)
    path, n = _vector_index(spark, d), e.count()
    got = VIX.search(e, path, 5, exclude_self=True).select("query_id", "neighbor_id")
    exact = VEC.knn(e, e, 5, exclude_self=True).select("query_id", "neighbor_id")
    hits = exact.join(got.withColumn("hit", F.lit(1)), ["query_id", "neighbor_id"], "left").groupBy("query_id").agg(F.count("hit").alias("hits"), F.count("*").alias("wanted"))
    read = VIX.search(e, path, 5, exclude_self=True, report=True)
    return hits.join(read, "query_id").agg((F.sum("hits") / F.sum("wanted")).alias("recall"), F.avg(F.col("codes_scored") / n).alias("codes_share"),
                                           F.avg(F.col("vectors_read") / n).alias("vectors_share"))


@register("V3_hash_embed")
def q_hash_embed(spark, d):
    chunks = TO.chunk(fx.filing(spark, d).select("id", "text"), "id", "text", n=500, clean=True)
    return VEC.hash_embed(chunks, ["id", "chunk_number"], "chunk", dims=64)


# --- streaming -------------------------------------------------------------------
from ..streaming import incremental as STR  # noqa: E402


def _events_stream(spark, d):
    return STR.file_stream(spark, d, STR.EVENTS_SCHEMA, glob="events.parquet", max_files=1)


@register("I1_stream_upsert")
def q_stream_upsert(spark, d):
    root = STR.scratch(spark, "upsert")
    t = STR.stream_upsert(_events_stream(spark, d), f"{root}/table", ["user_id", "event_type"], ["ts", "event_id"],
                          f"{root}/_checkpoint")
    return t.select("user_id", "event_type", "ts", "value", "event_id")


@register("I2_stream_once")
def q_stream_once(spark, d):
    root = STR.scratch(spark, "once")
    s = _events_stream(spark, d).withColumn("day", F.to_date("ts"))
    dedup = STR.stream_once(s, ["user_id", "event_type", "day"], "ts", "2 days")

    def batch(df, epoch):
        df.select("user_id", "event_type", "day").write.mode("overwrite").parquet(f"{root}/out/epoch={epoch:010d}")

    STR.run_available(dedup, batch, f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out").drop("epoch")


@register("I2_stream_once_ever")
def q_stream_once_ever(spark, d):
    """The events as a stream of three epochs; keys of every tenth user are known."""
    root = STR.scratch(spark, "once-ever")
    events = spark.read.schema(STR.EVENTS_SCHEMA).parquet(f"{d.rstrip('/')}/events.parquet").select("event_id", "user_id", "event_type")
    events.repartition(3, F.xxhash64("event_id")).write.parquet(f"{root}/src")
    known = events.where(F.col("user_id") % 10 == 0).select("user_id", "event_type").distinct()
    stream = STR.file_stream(spark, f"{root}/src", events.schema, max_files=1)
    return STR.stream_once_ever(stream, ["user_id", "event_type"], f"{root}/out", f"{root}/_checkpoint", known)


@register("I3_stream_newer")
def q_stream_newer(spark, d):
    from ..sources import bucketed
    from ..sources.tables import read_table
    root = STR.scratch(spark, "newer")
    stored = read_table(spark, d, "events").where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    marks = stored.groupBy("user_id").agg(F.max("ts").alias("_hwm"))
    bucketed.upsert(f"{root}/cursor", marks, ["user_id"], 0)
    out = STR.stream_newer(_events_stream(spark, d), f"{root}/cursor", f"{root}/out", "user_id", "ts",
                           f"{root}/_checkpoint")
    return out.select("event_id", "user_id", "ts")


@register("I4_stream_run_state")
def q_stream_run_state(spark, d):
    root = STR.scratch(spark, "state")
    log = fx.run_log_from_events(_events_stream(spark, d))
    return STR.stream_run_state(log, f"{root}/table", f"{root}/_checkpoint")


# --- composite jobs -------------------------------------------------------------
from . import jobs as JOBS  # noqa: E402


def _market(spark, d):
    p, s = fx.price(spark, d), fx.split(spark, d)
    old = F.col("date") < F.lit("1997-01-01").cast("date")
    stored_splits = s.where(old).withColumn("ratio", (F.col("ratio") + 1).cast("decimal(10,2)"))
    return JOBS.market_build(p.where(old), p, stored_splits, s, fx.ticker(spark, d), _info(spark, d), AS_OF)


for _table in ("price", "split", "fundamentals", "ticker"):
    register(f"C1_{_table}")(lambda spark, d, t=_table: _market(spark, d)[t])
register("C1_market_build")(lambda spark, d: _market(spark, d)["ticker"])


def _filing_text(spark, d):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("filingId", T.LongType()), T.StructField("section", T.StringType()),
                           T.StructField("title", T.StringType()), T.StructField("content", T.StringType()),
                           T.StructField("raw_content", T.StringType()), T.StructField("markdown_content", T.StringType()),
                           T.StructField("word_count", T.IntegerType()), T.StructField("chunk_number", T.IntegerType())])
    empty = spark.createDataFrame([], schema)
    out = JOBS.filing_text_build(fx.filing(spark, d), _stored_filings(spark, d), fx.attachment(spark, d),
                                 fx.filing_items(spark, d), empty, FILING_LIMITS)
    return out


register("C3_filing_text_build")(lambda spark, d: _filing_text(spark, d)["statements"])
register("C3_filing")(lambda spark, d: _filing_text(spark, d)["filing"])


def _insiders(spark, d):
    f = fx.insider_filing(spark, d)
    stored = f.where(F.col("id") % 2 == 0).select(
        "id", "ticker_id", "insider_id", "accession_no", C.form_type("form_raw").alias("form_type"),
        C.is_amendment(C.form_type("form_raw")).alias("is_amendment"), "filing_date", F.lit(None).cast("date").alias("reporting_period"),
        F.lit(None).cast("string").alias("insider_name"), "completed")
    ledger = fx.insider_transaction(spark, d).join(stored.select(F.col("id").alias("insider_filing_id")), "insider_filing_id")
    return JOBS.insider_build(stored, ledger, fx.insider_header_raw(spark, d), fx.ownership_rows(spark, d),
                              fx.insider_dim(spark, d), fx.insider_incoming(spark, d), TODAY)


for _name, _table in (("C4_filing", "insider_filing"), ("C4_ledger", "ledger"), ("C4_rollup", "rollup"), ("C4_position", "position")):
    register(_name)(lambda spark, d, t=_table: _insiders(spark, d)[t])
register("C4_insider_build")(lambda spark, d: _insiders(spark, d)["rollup"])


@register("C2_financial_build")
def q_financial_build(spark, d):
    """Two annual and three quarterly filings a ticker, by filing date; every third fact is stored already."""
    merged, _, _ = _facts(spark, d)
    stored = sinks.upsert(merged.select(*FACT_COLS).limit(0), merged.select(*FACT_COLS), fin.GRAIN, order=["filing_accession"], winner="last")
    stored = stored.where(F.length("line_code") % 3 == 0)
    return JOBS.financial_build(fx.statement_wide(spark, d), fx.statement_filing(spark, d), stored, schemas.gaap_map_df(spark), 2, 3)


@register("C2_pointers")
def q_period_pointers(spark, d):
    """The latest period pointers of each ticker, written to its row."""
    latest = fin.latest_periods(fact_table(spark, d)).withColumnRenamed("ticker_id", "id")
    cols = [c for c in latest.columns if c != "id"]
    types = dict(latest.dtypes)
    t = fx.ticker(spark, d).select("id", "symbol", *[F.lit(None).cast(types[c]).alias(c) for c in cols])
    return sinks.update_columns(t, latest, "id", cols)


@register("C5_daily_plan")
def q_daily_plan(spark, d):
    plan = q_plan_runs(spark, d)
    return plan.groupBy("process_name", "verdict").agg(F.count(F.lit(1)).alias("n"))


# --- loaders and single operators on derived inputs -------------------------------
from ..sources import loaders  # noqa: E402


@register("S4_statement_rows")
def q_statement_rows(spark, d):
    """Order lines as statement frames in JSON lines: the frames of a month have
    that month's end as their only period column."""
    from ..sources.tables import read_table
    li = read_table(spark, d, "lineitem")
    month = F.date_format(F.last_day("l_shipdate"), "yyyy-MM-dd")
    body = F.to_json(F.map_concat(
        F.create_map(F.lit("statement"), F.lit("income"), F.lit("filing_accession"), F.concat(F.lit("acc-"), F.col("l_orderkey").cast("string")),
                     F.lit("concept"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")), F.lit("label"), F.col("l_returnflag")),
        F.create_map(month, F.col("l_extendedprice").cast("decimal(15,2)").cast("string"))))
    path = STR.scratch(spark, "frames")
    li.select(body.alias("value"), month.alias("month")).write.partitionBy("month").text(path)
    return loaders.load_statement_rows(spark, path)


@register("S5_filing_index")
def q_filing_index(spark, d):
    path = STR.scratch(spark, "filings")
    f = fx.filing(spark, d).select(F.col("accessionNo").alias("accession_no"), F.col("type").alias("form"), F.col("filingDate").cast("date").alias("filing_date"),
                                   F.col("tickerId").cast("string").alias("ticker"))
    f.write.option("header", True).csv(path)
    return loaders.load_filings(spark, path, "csv")


@register("S7_overrides")
def q_overrides(spark, d):
    """An overrides document per supplier nation, read back as rules."""
    from ..sources.tables import read_table
    path = STR.scratch(spark, "overrides")
    n = read_table(spark, d, "nation")
    one = F.struct(F.concat(F.lit(" Custom:"), F.col("n_name")).alias("concept"), F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.lit("line_"), F.col("n_regionkey").cast("string"))).alias("line_code"))
    n.groupBy().agg(F.sort_array(F.collect_list(one)).alias("overrides")).coalesce(1).write.json(path)
    return fin.load_overrides(spark, path)


@register("S13_insert_unique")
def q_insert_unique(spark, d):
    f = fx.filing(spark, d).drop("text")
    return sinks.insert_unique(f.where(F.col("id") % 2 == 0), f.where(F.col("id") % 2 == 1), ["id"])


@register("S14_touched")
def q_touched(spark, d):
    """Upsert and update that stamp the rows they change."""
    t = fx.ticker(spark, d).select("id", "name", F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    given = t.where(F.col("id") % 7 == 0).select("id", F.upper("name").alias("name"))
    once = sinks.upsert(t, given, ["id"], ["name"], order=["name"], touch_col="updated_at", now="2024-05-01 00:00:00")
    return sinks.update_columns(once, t.where(F.col("id") % 14 == 0).select("id", F.lower("name").alias("name")), "id", ["name"],
                                touch_col="updated_at", now="2024-06-01 00:00:00")


@register("P19_ledger_rows_alias")
def q_ledger_rows_alias(spark, d):
    """Ownership tables under attribute names, of which some exist."""
    raw = fx.ownership_rows(spark, d).select(
        "filing_id", "src_order", F.col("date").alias("transaction_date"), F.col("security_title").alias("security"), F.lit("Stock").alias("security_title"),
        "code", "transaction_type", F.col("shares").cast("double").alias("shares_numeric"), F.col("price").alias("price_per_share"),
        F.col("ownership_type").alias("ownership"), F.col("remaining_shares").alias("remaining"), F.col("shares").alias("shares_owned_following"))
    return insiders.ledger_rows_alias(raw, False)


@register("P22_latest_column_date")
def q_latest_column_date(spark, d):
    """A frame with a column for each month of the order lines; its newest column."""
    from ..sources.tables import read_table
    li = read_table(spark, d, "lineitem").select((F.col("l_orderkey") % 10).alias("concept"), F.date_format(F.last_day("l_shipdate"), "yyyy-MM-dd").alias("period"), "l_quantity")
    frame = li.groupBy("concept").pivot("period").agg(F.sum("l_quantity"))
    return spark.range(1).select(F.lit(fin.latest_column_date(frame)).alias("latest"))


@register("Q4_check_mapping")
def q_check_mapping(spark, d):
    """The rules that the statement frames use, against lines of which some miss."""
    used = fx.statement_wide(spark, d).select(F.col("standard_concept").alias("key")).distinct()
    gaap = schemas.gaap_map_df(spark).join(used, "key", "left_semi")
    lines = schemas.financial_line_df(spark).select("line_code", "statement").where(F.length("line_code") % 5 != 0)
    return quality.check_mapping(gaap, lines)


def _annotations(spark, d):
    """Annotations derived from the labels; some ratings are out of range."""
    from ..sources.tables import read_table
    n = F.col("doc_id")
    return read_table(spark, d, "labels").select(
        n.alias("evaluation_pair_id"), (n % 3).alias("annotator_user_id"),
        F.when(F.col("toxic") == 1, "none").when(F.col("quality") == 1, "experimental").otherwise("tie").alias("preferred_response"),
        (n % 6).alias("factual_accuracy_rating"), (n % 5 + 1).alias("relevance_rating"), F.when(n % 2 == 0, n % 7).alias("completeness_rating"))


@register("Q1_rules_run_state")
def q_rules_run_state(spark, d):
    return quality.check_rules(INC.run_state(fx.run_log(spark, d)), quality.CONSTRAINTS["process_run_state"][0])


@register("Q1_rules_facts")
def q_rules_facts(spark, d):
    return quality.check_rules(fact_table(spark, d), quality.CONSTRAINTS["financial_fact"][0])


@register("Q1_rules_annotations")
def q_rules_annotations(spark, d):
    return quality.check_rules(_annotations(spark, d), quality.CONSTRAINTS["human_annotations"][0])


@register("S13_enforced_run_state")
def q_enforced_run_state(spark, d):
    """S13 in the plan: the run state with its constraints enforced on the way."""
    return quality.enforce(INC.run_state(fx.run_log(spark, d)), *quality.CONSTRAINTS["process_run_state"])
