"""User-level build jobs (one plan over all tickers / filings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as TX
from ..operators import financials as fin
from ..operators import incremental as INC
from ..operators import insiders as INS
from ..operators import market as MK
from ..operators import text as TO
from ..operators.common import latest_by
from ..session import cut_lineage
from ..sources import sinks

STATEMENT_KEYS = ["filingId", "section", "chunk_number"]
STATEMENT_UPDATE = ["content", "raw_content", "markdown_content", "word_count"]


def market_build(price_store: DataFrame, bars: DataFrame, split_store: DataFrame, splits: DataFrame,
                 ticker: DataFrame, info: DataFrame, as_of) -> dict[str, DataFrame]:
    """Bars and splits upserted (new bars only), fundamentals as of a date,
    all ticker profile columns updated from the newest document (NULL never
    overwrites a stored value).  A day's bar and split are unique per ticker;
    of repeated ones the highest close, or ratio, wins."""
    new_bars = MK.newer_than(MK.clean_prices(bars), price_store)
    price = sinks.upsert(price_store, new_bars, ["tickerId", "date"], order=["close", "open", "high", "low", "volume"])
    split = sinks.upsert(split_store, splits, ["tickerId", "date"], order=["ratio"])
    fund = MK.fundamentals(info, as_of)
    keep = ("ticker_id", "event_id") if "event_id" in info.columns else ("ticker_id",)
    prof = MK.ticker_profile(info, keep=keep).withColumnRenamed("ticker_id", "id")
    if "event_id" in prof.columns:  # newest document per ticker
        prof = latest_by(prof, ["id"], [F.col("event_id")])
    cols = [c for c in prof.columns if c not in ("id", "event_id")]
    types = dict(prof.dtypes)
    wide = ticker.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in cols if c not in ticker.columns])
    tick = sinks.update_columns(wide, prof, "id", cols, keep_on_null=True)
    return {"price": price, "split": split, "fundamentals": fund, "ticker": tick}


def financial_build(frames: DataFrame, filings: DataFrame, stored: DataFrame, gaap: DataFrame, annual: int = 5, quarterly: int = 20) -> DataFrame:
    """The newest ``annual`` annual and ``quarterly`` quarterly filings of
    each ticker (by filing date, then accession) are merged and upserted into
    ``stored``.  Filings are written newest first, and each write replaces the
    one before, so where two give a fact the oldest filing's value stands.
    ``filings`` are (filing_accession, ticker_id, is_annual, filing_date)."""
    newest = Window.partitionBy("ticker_id", "is_annual").orderBy(F.col("filing_date").desc(), F.col("filing_accession").desc())
    limit = F.when(F.col("is_annual"), F.lit(annual)).otherwise(F.lit(quarterly))
    chosen = filings.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= max(annual, quarterly)).where(F.col("_n") <= limit).drop("_n")
    merged, _, _ = fin.financial_facts(frames.join(chosen.select("filing_accession"), "filing_accession", "left_semi"), gaap)
    dated = merged.join(chosen.select("filing_accession", "filing_date"), "filing_accession")
    batch = dated.select(*stored.columns, "filing_date")
    return sinks.upsert(stored, batch, fin.GRAIN, order=["filing_date", "filing_accession"], winner="first")


def filing_text_build(filing: DataFrame, stored_filing: DataFrame, attachments: DataFrame, items: DataFrame,
                      statements: DataFrame, limits: dict[str, int]) -> dict[str, DataFrame]:
    """Newest filings per form -> not yet completed -> 8-K attachment text
    or MD&A sections -> chunk rows upserted into ``statements`` (the stored
    title is kept) -> filings that stored something are marked completed."""
    cands = INC.latest_filings(filing.drop("text"), limits)
    todo = INC.pending_filings(cands, stored_filing)
    eight_k = todo.where(F.col("type") == "8-K").select(F.col("id").alias("filing_id"))
    att = TO.pick_attachment(attachments.join(eight_k, "filing_id", "left_semi"))
    pr = TO.statement_chunks(att, "filing_id", "text", kind="8-K")
    periodic = todo.where(F.col("type").isin("10-K", "10-Q")).select("id", "type")
    sec = TO.mdna_sections(periodic, items, schemas.mdna_rules_df(filing.sparkSession))
    md = TO.statement_chunks(sec, "filing_id", "content", kind="MDNA", section_col="section_id",
                             title_col="section_title")
    new_rows = pr.unionByName(md)
    new_rows = cut_lineage(new_rows)  # read by both tables
    st = sinks.upsert(statements, new_rows, STATEMENT_KEYS, STATEMENT_UPDATE, order=["title", "raw_content"], winner="first")
    stored_any = new_rows.select(F.col("filingId").alias("id")).distinct().withColumn("completed", F.lit(True))
    seen = sinks.insert_ignore(stored_filing, todo.select(*[c for c in stored_filing.columns if c in todo.columns])
                               .withColumn("completed", F.lit(False)), ["accessionNo"], order=["id"])
    fil = sinks.update_columns(seen, stored_any, "id", ["completed"], keep_on_null=True)
    return {"statements": st, "filing": fil}


FILING_COLUMNS = ["id", "ticker_id", "insider_id", "accession_no", "form_type", "is_amendment", "filing_date",
                  "reporting_period", "insider_name", "completed"]
LEDGER_COLUMNS = ["insider_filing_id", "is_derivative", "line_number", "transaction_date", "security_title",
                  "transaction_code", "acquired_disposed", "shares", "price_per_share", "shares_owned_following",
                  "ticker_id", "insider_id"]


def insider_build(stored_filing: DataFrame, stored_ledger: DataFrame, header_raw: DataFrame, ownership_rows: DataFrame,
                  insider_dim: DataFrame, incoming: DataFrame, today) -> dict[str, DataFrame]:
    """C4: filings that are not completed yet get their header, ticker and
    insider (created where new), their ledger lines are upserted, and they are
    marked completed; then the per-filing rollup and the current positions."""
    spark = header_raw.sparkSession
    done = stored_filing.where(F.col("completed")).select("accession_no")
    todo = header_raw.join(done, "accession_no", "left_anti")
    insiders = INS.resolve_insiders(insider_dim, incoming)
    links = INS.filing_insiders(incoming, insiders).withColumnRenamed("filing_id", "id")
    head = INS.insider_header(todo, today).join(todo.select("id", "ticker_id"), "id").join(links, "id", "left")
    head = cut_lineage(head.withColumn("completed", F.lit(True)).select(*FILING_COLUMNS))
    filing = sinks.upsert(stored_filing.select(*FILING_COLUMNS), head, ["accession_no"],
                          [c for c in FILING_COLUMNS if c not in ("id", "accession_no")], order=["id"])
    keys = head.select(F.col("id").alias("insider_filing_id"), "ticker_id", "insider_id")
    lines = INS.with_direction(INS.ledger_rows(ownership_rows)).join(keys, "insider_filing_id").select(*LEDGER_COLUMNS)
    ledger = sinks.upsert(stored_ledger.select(*LEDGER_COLUMNS), lines, LEDGER_COLUMNS[:3], order=LEDGER_COLUMNS[3:10])
    rollup = INS.filing_rollup(lines, schemas.transaction_code_df(spark))
    return {"insider_filing": filing, "insider": insiders, "ledger": ledger, "rollup": rollup,
            "position": INS.position_current(ledger, filing)}


def text_of_pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", TX.html_to_text(F.col("html")).alias("text"))
