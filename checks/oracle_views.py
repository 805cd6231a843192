"""DuckDB SQL for the reference-shaped test tables (see FIXTURES.md).

These are written independently of the Spark code in ``ticklake.sources.fixtures``
and are used only by the oracle queries: ``with_views(sql, ...)`` prepends the
needed views as CTEs so that each oracle string runs on the pre-registered base
tables alone.
"""

from __future__ import annotations

from ticklake import schemas

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _v(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = (sql, deps)


_v("ticker", """
SELECT c_custkey AS id, 'C' || c_custkey AS symbol, c_name AS name, c_acctbal >= 0 AS is_active,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'ETF' WHEN 'FURNITURE' THEN NULL ELSE 'EQUITY' END AS quote_type
FROM customer""")

_v("price", """
SELECT o_custkey AS tickerId, CAST(o_orderdate AS DATE) AS date,
       CAST(min_by(o_totalprice, o_orderkey) AS DECIMAL(15,2)) AS open, CAST(max(o_totalprice) AS DECIMAL(15,2)) AS high,
       CAST(min(o_totalprice) AS DECIMAL(15,2)) AS low, CAST(max_by(o_totalprice, o_orderkey) AS DECIMAL(15,2)) AS close,
       count(*) AS volume
FROM orders GROUP BY 1, 2""")

_v("split", """
SELECT o_custkey AS tickerId, CAST(o_orderdate AS DATE) AS date, CAST(max(2 + o_orderkey % 3) AS DECIMAL(10,2)) AS ratio
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2""")

_v("company_info", "SELECT event_id % 1000 AS ticker_id, event_id, props AS info FROM events")

_v("company_info_wide", """
SELECT event_id % 1000 AS ticker_id, event_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE
    '{"shortName":"Co ' || user_id || '","longName":"Company ' || user_id || '","quoteType":'
    || CASE WHEN event_type = 'error' THEN '"ETF"' ELSE '"EQUITY"' END
    || ',"sector":"' || event_type || '","trailingPE":'
    || CASE WHEN event_id % 7 = 0 THEN '[' || json_extract_string(props, '$.k') || ',1]' ELSE json_extract_string(props, '$.k') END
    || ',"fundInceptionDate":' || CAST(floor(epoch(ts)) AS BIGINT)
    || ',"marketCap":' || CAST(trunc(value * 1000) AS BIGINT)
    || ',"corporateActions":[{"type":"split"}]' || ',"companyOfficers":{"ceo":"x"}' || '}'
  END AS info
FROM events""")

_v("filing", """
SELECT d.doc_id AS id, d.doc_id % 100 AS tickerId,
       CASE d.doc_id % 3 WHEN 0 THEN '8-K' WHEN 1 THEN '10-K' ELSE '10-Q' END AS type,
       'acc-' || d.doc_id AS accessionNo, DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS filingDate,
       l.doc_id IS NOT NULL AS completed, d.text AS text
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")

_v("attachment", """
SELECT conv_id AS filing_id, turn AS ordinal,
       CASE role WHEN 'assistant' THEN 'EX-99.1' WHEN 'system' THEN 'COVER' ELSE '8-K' END AS document_type, text
FROM conversations""")

_v("insider_filing", """
SELECT o_orderkey AS id, o_custkey % 50 AS ticker_id, o_custkey AS insider_id, 'acc-' || o_orderkey AS accession_no,
       CASE o_orderpriority WHEN '1-URGENT' THEN '3' WHEN '2-HIGH' THEN '4' WHEN '3-MEDIUM' THEN '4/A'
            WHEN '5-LOW' THEN '5' ELSE 'Form 4' END AS form_raw,
       CAST(o_orderdate AS DATE) AS filing_date, o_orderstatus = 'F' AS completed
FROM orders""")

_v("insider_transaction_raw", """
SELECT CASE WHEN l_partkey % 101 = 0 THEN -l_orderkey ELSE l_orderkey END AS insider_filing_id, l_linestatus = 'O' AS is_derivative, l_linenumber AS line_number,
       CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS transaction_date,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'SEC' || (l_partkey % 5) END AS security_title,
       CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE 'H' END AS transaction_code,
       CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'D' END AS acquired_disposed,
       CAST(l_quantity AS DECIMAL(20,4)) AS shares, CAST(l_extendedprice AS DECIMAL(20,4)) AS price_per_share,
       CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_quantity * 10 AS DECIMAL(20,4)) END AS shares_owned_following,
       row_number() OVER (PARTITION BY l_orderkey, l_linestatus, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
           l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC) AS rn
FROM lineitem""")

_v("insider_transaction", """
SELECT t.* EXCLUDE (rn), f.ticker_id, f.insider_id
FROM insider_transaction_raw t JOIN insider_filing f ON f.id = t.insider_filing_id WHERE rn = 1""",
   ("insider_transaction_raw", "insider_filing"))

_v("evaluation_runs", """
SELECT DISTINCT source AS id, 'run-' || source AS run_name, 'baseline' AS run_type, 'completed' AS status FROM documents""")

_v("evaluation_pairs", """
SELECT doc_id AS id, source AS evaluation_run_id, 'q' || doc_id AS question_id, n_chars % 997 AS control_avg_latency_ms,
       n_chars % 1009 AS experimental_avg_latency_ms,
       CAST((n_chars % 101) / 100.0 AS DECIMAL(5,4)) AS experimental_confidence_score,
       n_chars % 13 AS total_rows_retrieved
FROM documents""")

_v("judgement_scores", """
SELECT l.doc_id AS evaluation_pair_id, j.judge_type,
       CAST(((l.doc_id * 7 + j.k) % 101) / 100.0 AS DECIMAL(5,4)) AS control_score,
       CAST(((l.doc_id * 11 + j.k) % 101) / 100.0 AS DECIMAL(5,4)) AS experimental_score,
       CAST((((l.doc_id * 11 + j.k) % 101) - ((l.doc_id * 7 + j.k) % 101)) / 100.0 AS DECIMAL(6,4)) AS improvement_delta,
       CASE j.judge_type WHEN 'consistency' THEN CAST(((l.doc_id * 7 + j.k) % 101 % 17) / 8.0 AS DECIMAL(6,4)) END AS semantic_entropy_control,
       CASE j.judge_type WHEN 'consistency' THEN CAST(((l.doc_id * 11 + j.k) % 101 % 17) / 8.0 AS DECIMAL(6,4)) END AS semantic_entropy_experimental
FROM labels l JOIN (VALUES ('factual_grounding', 1), ('completeness', 2), ('consistency', 3)) j(judge_type, k)
  ON j.k <= 1 + l.quality + l.toxic""")

_v("query_attempts", """
SELECT event_id AS id, user_id AS sub_query_trace_id,
       CASE event_type WHEN 'click' THEN 'sql' WHEN 'view' THEN 'vector' ELSE 'cypher' END AS query_type,
       CAST(round(value * 100) AS BIGINT) AS execution_time_ms,
       CASE WHEN event_type = 'error' OR event_id % 7 = 0 THEN 'failed' END AS error_message, ts AS created_at
FROM events""")

_v("execution_traces", """
SELECT event_id AS id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 97 = 5 THEN -event_id ELSE event_id - 1 END AS parent_trace_id FROM events""")

_v("run_log", """
SELECT user_id AS ticker_id,
       CASE event_id % 4 WHEN 0 THEN 'stocks' WHEN 1 THEN 'financials' WHEN 2 THEN 'press_releases' ELSE 'insider_transactions' END AS process_name,
       CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'start' END AS action, ts, event_id,
       CASE event_type WHEN 'purchase' THEN '{"through": "' || strftime(ts, '%Y-%m-%d') || '"}' END AS cursor
FROM events""")

_v("vertices", """
SELECT id, label, name, [label] AS labels, MAP {'name': name} AS props FROM (
  SELECT 's' || s_suppkey AS id, 'Company' AS label, s_name AS name FROM supplier
  UNION ALL SELECT 'c' || c_custkey, 'Company', c_name FROM customer
  UNION ALL SELECT 'p' || p_partkey, 'Product', p_name FROM part
  UNION ALL SELECT 'o' || o_orderkey, 'Metric', 'order ' || o_orderkey FROM orders
  UNION ALL SELECT 'n' || n_nationkey, 'Risk', n_name FROM nation
  UNION ALL SELECT DISTINCT 'g' || c_mktsegment, 'Strategy', c_mktsegment FROM customer)""")

_v("edges", """
SELECT src || '>' || type || '>' || dst AS eid, src, dst, type, MAP {'kind': type} AS props
FROM (SELECT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst, 'REPORTS' AS type FROM orders
  UNION SELECT 's' || s_suppkey, 'n' || s_nationkey, 'FACES' FROM supplier
  UNION SELECT 'c' || c_custkey, 'n' || c_nationkey, 'FACES' FROM customer
  UNION SELECT 'c' || c_custkey, 'g' || c_mktsegment, 'IMPLEMENTS' FROM customer
  UNION SELECT 'g' || c_mktsegment, 'n' || c_nationkey, 'MENTIONED_IN' FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION SELECT 's' || l_suppkey, 'p' || l_partkey, 'PRODUCES' FROM lineitem
  UNION SELECT 'p' || l_partkey, 'o' || l_orderkey, 'RELATED_TO' FROM lineitem
  UNION SELECT 'o' || o_orderkey, 'o' || (o_orderkey + 1), 'RELATED_TO' FROM orders WHERE o_orderkey % 3 = 0
  UNION SELECT 'o' || o_orderkey, 's' || (o_orderkey % 10), 'MENTIONED_IN' FROM orders WHERE o_orderkey % 2 = 0)""")


def _values(rows, cols) -> str:
    def lit(x):
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "TRUE" if x else "FALSE"
        if isinstance(x, (int, float)):
            return repr(x)
        if isinstance(x, (list, tuple)):
            return "[" + ", ".join(lit(i) for i in x) + "]"
        return "'" + str(x).replace("'", "''") + "'"

    body = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES\n  {body}) AS v({', '.join(cols)})"


_v("gaap_map", _values(schemas.GAAP_MAP, ["key", "line_code", "statement"]))
_v("financial_line", _values([r for r in schemas.FINANCIAL_LINES],
                             ["line_code", "statement", "display_name", "synonyms", "us_gaap_tag", "sort_order"]))
_v("transaction_code", _values(schemas.TRANSACTION_CODES, ["code", "label", "description"]))
_v("merge_preferred", _values([(lc, n, i) for lc, ns in schemas.MERGE_PREFERRED.items() for i, n in enumerate(ns)],
                              ["line_code", "pref_name", "pref_idx"]))

_v("statement_wide", """
WITH k AS (SELECT row_number() OVER (ORDER BY key) - 1 AS i, key, statement, count(*) OVER () AS n FROM gaap_map)
SELECT 'acc-' || (l.l_orderkey % 500) AS filing_accession, l.l_orderkey % 50 AS ticker_id,
       (l.l_orderkey % 500) % 4 = 0 AS is_annual,
       CASE WHEN l.l_suppkey % 11 = 0 THEN 'cashflow' ELSE k.statement END AS statement,
       CASE l.l_linenumber % 5 WHEN 0 THEN 'us-gaap:' || k.key WHEN 1 THEN 'us-gaap_' || k.key WHEN 2 THEN k.key
            WHEN 3 THEN 'abc_' || k.key ELSE 'abc:Unknown' || k.key END AS concept,
       CASE WHEN l.l_quantity > 25 THEN k.key END AS standard_concept,
       l.l_tax = 0 AS is_abstract, -6 AS decimals, 'USD' AS units, 0 AS scale,
       CASE WHEN l.l_discount = 0 THEN NULL ELSE CAST(l.l_extendedprice AS VARCHAR) END AS "2023-09-30",
       CASE WHEN l.l_returnflag = 'N' THEN 'n/a' ELSE CAST(l.l_extendedprice * 2 AS VARCHAR) END AS "2024-02-15",
       row_number() OVER (ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
                          l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_shipdate) AS seq
FROM lineitem l JOIN k ON k.i = l.l_partkey % k.n""", ("gaap_map",))


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named views (and their dependencies)."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0].strip()}\n)" for n in _order(names))
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"

_v("ownership_rows", """
SELECT l_orderkey AS filing_id, CASE WHEN l_orderkey % 4 = 0 THEN '3' ELSE '4' END AS form,
  l_orderkey % 4 = 0 AS has_security_type,
  CASE WHEN l_orderkey % 4 = 0 THEN CASE WHEN l_linestatus = 'O' THEN 'Stock Option (derivative)' ELSE 'Common Stock' END END AS security_type,
  CAST(l_quantity AS VARCHAR) AS shares,
  CASE WHEN l_orderkey % 4 = 0 AND l_linestatus = 'O' THEN CAST(l_quantity * 2 AS VARCHAR) END AS underlying_shares,
  CASE l_returnflag WHEN 'R' THEN 'Direct' WHEN 'A' THEN 'Indirect' END AS ownership_type,
  CASE WHEN l_tax = 0 THEN 'n/a' ELSE CAST(l_shipdate AS VARCHAR) END AS date,
  CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN '' ELSE 'SEC' || (l_partkey % 5) END AS security_title,
  CASE WHEN NOT (l_orderkey % 4 = 0) THEN CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE ' M ' END END AS code,
  CAST(l_extendedprice AS VARCHAR) AS price,
  CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_quantity * 10 AS VARCHAR) END AS remaining_shares,
  CASE l_returnflag WHEN 'A' THEN 'Purchase' WHEN 'R' THEN 'Sale' ELSE '  ' END AS transaction_type,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                     l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS src_pos
FROM lineitem""")

_v("insider_header_raw", """
SELECT o_orderkey AS id, o_custkey % 50 AS ticker_id, 'acc-' || o_orderkey AS accession_no,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Form 3' WHEN '2-HIGH' THEN ' 4 ' WHEN '3-MEDIUM' THEN 'Form 4/A'
       WHEN '5-LOW' THEN '5' END AS form_raw,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN 'not a date' ELSE CAST(o_orderdate AS VARCHAR) END
    AS filing_date_raw,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) END AS reporting_period_raw,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '   ' ELSE c_name END AS insider_name,
  CASE WHEN o_orderkey % 7 = 0 THEN [] ELSE [{'name': upper(c_name)}] END AS owners
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")

_v("insider_dim", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik,
       c_name AS name
FROM customer WHERE c_nationkey < 10""")

_v("insider_incoming", """
SELECT o_orderkey AS filing_id, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS cik,
       CASE WHEN o_custkey % 4 = 0 THEN c_name ELSE c_name || ' #' || (o_orderkey % 3) END AS name,
       CAST(o_orderdate AS DATE) AS seq_d, o_orderkey AS seq_k
FROM orders JOIN customer ON c_custkey = o_custkey""")

_v("statement_filing", """
SELECT DISTINCT 'acc-' || (l_orderkey % 500) AS filing_accession, l_orderkey % 500 % 50 AS ticker_id, l_orderkey % 500 % 4 = 0 AS is_annual,
       DATE '2020-01-01' + CAST(l_orderkey % 500 * 37 % 401 AS INTEGER) AS filing_date
FROM lineitem""")
