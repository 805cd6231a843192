"""Incremental-load planning as table jobs: eligibility, ticker selection,
newest filings, completion checks, run state folded from a run log, and the
per ticker x process run plan (one plan over all tickers, not one worker per
ticker)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce as C
from .common import latest_by, top_k_per_group

PROCESSES = ("stocks", "financials", "press_releases", "insider_transactions")


def edgar_eligible(tickers: DataFrame, col: str = "quote_type") -> DataFrame:
    """P5: filings exist only for equities: quote type NULL or 'EQUITY'."""
    return tickers.withColumn("edgar_eligible", F.col(col).isNull() | (F.col(col) == "EQUITY"))


def active_tickers(tickers: DataFrame) -> DataFrame:
    """Active tickers, symbol upper-cased (sorted by symbol on output)."""
    return tickers.where(F.col("is_active")).select("id", F.upper("symbol").alias("symbol"), "name")


def resolve_tickers(tickers: DataFrame, names: DataFrame, name_col: str = "name") -> DataFrame:
    """P7 (batch form): each requested name -> ticker id, case-blind, a symbol
    match before a company-name match; unmatched names get NULL.  Two equi-joins
    (no OR join condition) and a min-by rank."""
    n = names.select(F.col(name_col).alias("requested")).distinct().withColumn("_u", F.upper(F.trim("requested")))
    by_sym = n.join(tickers.select(F.upper("symbol").alias("_u"), F.col("id").alias("ticker_id")), "_u") \
        .withColumn("_rank", F.lit(0))
    by_name = n.join(tickers.select(F.upper("name").alias("_u"), F.col("id").alias("ticker_id")), "_u") \
        .withColumn("_rank", F.lit(1))
    hits = by_sym.unionByName(by_name).groupBy("requested").agg(
        F.min_by("ticker_id", F.struct("_rank", "ticker_id")).alias("ticker_id"))
    return n.select("requested").join(hits, "requested", "left")


def select_tickers(active: DataFrame, requested: DataFrame, max_n: int | None = None) -> DataFrame:
    """Requested symbols that are active, sorted by symbol, at most ``max_n``."""
    req = requested.select(F.upper(F.trim("symbol")).alias("symbol")).distinct()
    ok = active.join(req, "symbol", "left_semi")
    return ok.orderBy("symbol").limit(max_n) if max_n else ok


def missing_tickers(active: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested symbols that are not active (set difference)."""
    req = requested.select(F.upper(F.trim("symbol")).alias("symbol")).distinct()
    return req.join(active.select("symbol"), "symbol", "left_anti")


def latest_filings(filing: DataFrame, limits: Mapping[str, int], ticker: str = "tickerId", form: str = "type",
                   date_col: str = "filingDate", id_col: str = "id") -> DataFrame:
    """Newest N filings per (ticker, form), N per form.  Forms without a
    limit are dropped.  WindowGroupLimit keeps each partition's top N first."""
    f = filing.where(F.col(form).isin(*limits.keys()))
    top = top_k_per_group(f, [ticker, form], [F.col(date_col).desc(), F.col(id_col).desc()],
                          max(limits.values()), rank_col="_rn")
    lim = F.lit(None).cast("int")
    for k, n in limits.items():
        lim = F.when(F.col(form) == k, F.lit(n)).otherwise(lim)
    return top.where(F.col("_rn") <= lim).drop("_rn")


def filing_record(raw: DataFrame, today, date_col: str = "filing_date_raw") -> DataFrame:
    """P25: filing row to store: date from text / timestamp / date, its year,
    download date = today, completed = false."""
    d = C.to_date10(F.col(date_col))
    return raw.withColumn("filing_date", d).withColumn("year", F.year(d)).withColumn(
        "download_date", F.lit(today).cast("date")).withColumn("completed", F.lit(False)).drop(date_col)


def pending_filings(candidates: DataFrame, stored: DataFrame, key: str = "accessionNo") -> DataFrame:
    """Candidates not yet completed; an existing incomplete filing keeps
    its id (``existing_id``), a new one has NULL."""
    done = stored.where(F.col("completed")).select(key)
    todo = candidates.join(done, key, "left_anti")
    ids = stored.where(~F.col("completed")).select(key, F.col("id").alias("existing_id"))
    return todo.join(ids, key, "left")


def should_run(candidates: DataFrame, stored: DataFrame, key: str = "accessionNo",
               ticker: str = "tickerId") -> DataFrame:
    """A4: per ticker the candidate count, how many are already completed, and
    the verdict: run when there are candidates and not all are completed."""
    done = stored.where(F.col("completed")).select(key).distinct().withColumn("_done", F.lit(True))
    j = candidates.join(done, key, "left")
    g = j.groupBy(ticker).agg(F.count(F.lit(1)).alias("n_candidates"),
                              F.count_if(F.col("_done").isNotNull()).alias("n_completed"))
    return g.withColumn("should_run", (F.col("n_candidates") > 0) & (F.col("n_completed") < F.col("n_candidates")))


def run_counters(run_log: DataFrame) -> DataFrame:
    """Per process the number of starts, successes and failures."""
    a = F.col("action")
    return run_log.groupBy("process_name").agg(
        F.count_if(a == "start").alias("n_start"), F.count_if(a == "success").alias("n_success"),
        F.count_if(a == "failed").alias("n_failed"), F.count(F.lit(1)).alias("n_events"))


def run_state(run_log: DataFrame, ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Current run state per (ticker, process) folded from an append-only
    log: status of the last event (start -> running), attempts, last start /
    success / failure time, the cursor of the last success, and the last error text
    (at most 5000 chars)."""
    a = F.col("action")
    status = F.when(a == "start", "running").when(a == "success", "success").when(a == "failed", "failed") \
        .otherwise("idle")
    has_err = "error" in run_log.columns
    aggs = [
        F.max_by(status, F.struct(F.col(ts), F.col(seq))).alias("status"),
        F.count_if(a == "start").alias("attempts"),
        F.max(F.when(a == "start", F.col(ts))).alias("last_started_at"),
        F.max(F.when(a == "success", F.col(ts))).alias("last_completed_at"),
        F.max(F.when(a == "failed", F.col(ts))).alias("last_failed_at"),
    ]
    if "cursor" in run_log.columns:
        aggs.append(F.max_by(F.when(a == "success", F.coalesce(F.col("cursor"), F.lit("{}"))),
                             F.when(a == "success", F.struct(F.col(ts), F.col(seq)))).alias("last_success_cursor"))
    if has_err:
        aggs.append(F.substring(F.max_by(F.when(a == "failed", F.col("error")),
                                         F.when(a == "failed", F.struct(F.col(ts), F.col(seq)))), 1, 5000)
                    .alias("last_error"))
    return run_log.groupBy("ticker_id", "process_name").agg(*aggs)


def stale_runs(state: DataFrame, now, minutes: int = 90) -> DataFrame:
    """I4: runs still marked running whose start is older than ``minutes``."""
    limit = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return state.where((F.col("status") == "running") & (F.col("last_started_at") < limit))


def startable(state: DataFrame, now, minutes: int = 90) -> DataFrame:
    """May a run start: not running, never started, or running but stale."""
    limit = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    ok = (F.col("status") != "running") | F.col("last_started_at").isNull() | (F.col("last_started_at") < limit)
    return state.withColumn("startable", ok)


def plan_runs(tickers: DataFrame, checks: DataFrame, state: DataFrame, now, force: bool = False,
              minutes: int = 90) -> DataFrame:
    """Verdict per ticker x process, in the source system's order:
    ineligible (filing processes need an equity) -> no new data (unless
    ``force``; a missing check fails open) -> locked (a fresh running run) -> run.

    ``checks``: (ticker_id, process_name, has_new_data)."""
    t = edgar_eligible(tickers).select(F.col("id").alias("ticker_id"), "edgar_eligible")
    grid = t.withColumn("process_name", F.explode(F.array(*[F.lit(p) for p in PROCESSES])))
    st = startable(state, now, minutes).select("ticker_id", "process_name", "startable")
    j = grid.join(checks, ["ticker_id", "process_name"], "left").join(st, ["ticker_id", "process_name"], "left")
    eligible = (F.col("process_name") == "stocks") | F.col("edgar_eligible")
    has_new = F.coalesce(F.col("has_new_data"), F.lit(True))
    verdict = (
        F.when(~eligible, "skip-ineligible")
        .when(F.lit(not force) & ~has_new, "skip-no-new-data")
        .when(~F.coalesce(F.col("startable"), F.lit(True)), "skip-locked")
        .otherwise("run")
    )
    return j.select("ticker_id", "process_name", verdict.alias("verdict"))


def new_statements(filing: DataFrame, pointers: DataFrame, forms=("10-K", "10-Q")) -> DataFrame:
    """Per ticker and form the latest filing when it is newer than the
    stored pointer (or nothing is stored), with the advanced pointer (filing
    date, fiscal year, quarter for 10-Q)."""
    latest = latest_by(filing.where(F.col("type").isin(*forms)), ["tickerId", "type"],
                       [F.col("filingDate"), F.col("id")], ["id", "accessionNo", "filingDate"])
    j = latest.join(pointers, ["tickerId", "type"], "left")
    new = j.where(F.col("pointer_date").isNull() | (F.col("filingDate") > F.col("pointer_date")))
    return new.select("tickerId", "type", "id", "accessionNo", F.col("filingDate").alias("new_pointer_date"),
                      F.year("filingDate").alias("new_pointer_year"),
                      F.when(F.col("type") == "10-Q", F.quarter("filingDate")).alias("new_pointer_quarter"))
