"""Independent DuckDB SQL for every registered query (see ``__spark_entry__``)."""

from __future__ import annotations

from .oracle_views import with_views as W

ORACLE: dict[str, str] = {}


def sql(name: str, text: str, *views: str) -> None:
    ORACLE[name] = W(text, *views)


sql("W1_position_current", """
WITH held AS (
  SELECT line.*, coalesce(line.security_title, '') AS title_key FROM insider_transaction line
  WHERE shares_owned_following IS NOT NULL AND insider_filing_id IN (SELECT id FROM insider_filing WHERE completed))
SELECT ticker_id, insider_id, security_title, is_derivative, shares_owned_following AS shares_held,
       transaction_date AS as_of_date, insider_filing_id
FROM held
QUALIFY row_number() OVER (PARTITION BY ticker_id, insider_id, title_key, is_derivative
                           ORDER BY transaction_date DESC NULLS LAST, insider_filing_id DESC, line_number DESC) = 1
""", "insider_transaction", "insider_filing")


def _avg6(x):
    return f"round(CAST(avg({x}) AS DOUBLE), 6)"


_KINDS = ("factual_grounding", "completeness", "consistency")
_MEASURES = {"control": "control_score", "experimental": "experimental_score", "improvement": "improvement_delta"}
_judge_avgs = ", ".join(
    f"round(CAST(avg({col}) FILTER (WHERE judge_type = '{kind}') AS DOUBLE), 6) AS avg_{measure}_{kind}"
    for kind in _KINDS for measure, col in _MEASURES.items())

sql("A1_run_summary", f"""
WITH judged AS (
  SELECT run.*, pair.id AS pair_id, pair.control_avg_latency_ms AS c_ms, pair.experimental_avg_latency_ms AS e_ms,
         pair.experimental_confidence_score AS confidence, pair.total_rows_retrieved AS n_rows, score.* EXCLUDE (evaluation_pair_id)
  FROM evaluation_runs run LEFT JOIN evaluation_pairs pair ON pair.evaluation_run_id = run.id
  LEFT JOIN judgement_scores score ON score.evaluation_pair_id = pair.id)
SELECT id, run_name, run_type, status, count(DISTINCT pair_id) AS completed_pairs, {_judge_avgs},
       CAST(round(avg(c_ms)) AS INTEGER) AS avg_control_latency_ms, CAST(round(avg(e_ms)) AS INTEGER) AS avg_experimental_latency_ms,
       {_avg6('confidence')} AS avg_experimental_confidence, sum(n_rows) AS total_rows_retrieved
FROM judged GROUP BY ALL
""", "evaluation_runs", "evaluation_pairs", "judgement_scores")

_PREFIX = dict(zip(_KINDS, ("fg", "completeness", "consistency"), strict=True))
_pair_scores = ", ".join(
    f"max({col}) FILTER (WHERE judge_type = '{kind}') AS {_PREFIX[kind]}_{measure if measure == 'improvement' else measure + '_score'}"
    for kind in _KINDS for measure, col in _MEASURES.items())
_pair_names = ", ".join(f"{p}_{m}" for p in _PREFIX.values() for m in ("control_score", "experimental_score", "improvement"))
_entropy = ("semantic_entropy_control", "semantic_entropy_experimental")
_pair_scores += "".join(f", max({c}) FILTER (WHERE judge_type = 'consistency') AS {c}" for c in _entropy)
_pair_names += "".join(f", {c}" for c in _entropy)

sql("J4_pair_details", f"""
WITH per_pair AS (SELECT evaluation_pair_id AS id, {_pair_scores} FROM judgement_scores GROUP BY evaluation_pair_id)
SELECT pair.id, evaluation_run_id, run_name, question_id, experimental_confidence_score, total_rows_retrieved, {_pair_names}
FROM evaluation_pairs pair JOIN (SELECT id AS evaluation_run_id, run_name FROM evaluation_runs) USING (evaluation_run_id)
LEFT JOIN per_pair USING (id)
""", "evaluation_runs", "evaluation_pairs", "judgement_scores")

sql("A3_hallucination_rate", """
WITH g(group_name) AS (VALUES ('control'), ('experimental')),
tot AS (SELECT evaluation_run_id AS run_id, count(*) AS n FROM evaluation_pairs GROUP BY 1),
low AS (
  SELECT ep.evaluation_run_id AS run_id,
         count(*) FILTER (WHERE js.control_score < 0.6) AS c,
         count(*) FILTER (WHERE js.experimental_score < 0.6) AS e
  FROM evaluation_pairs ep JOIN judgement_scores js ON ep.id = js.evaluation_pair_id
  WHERE js.judge_type = 'factual_grounding' GROUP BY 1)
SELECT er.id AS run_id, g.group_name,
       CAST(CASE WHEN coalesce(tot.n, 0) = 0 THEN 0.0
            ELSE round(coalesce(CASE g.group_name WHEN 'control' THEN low.c ELSE low.e END, 0) / tot.n, 4) END AS DOUBLE)
         AS hallucination_rate
FROM evaluation_runs er CROSS JOIN g LEFT JOIN tot ON tot.run_id = er.id LEFT JOIN low ON low.run_id = er.id
""", "evaluation_runs", "evaluation_pairs", "judgement_scores")

sql("A2_success_rates", """
SELECT query_type, n AS total_attempts, good AS successful_attempts, CAST(round(100.0 * good / n, 2) AS DOUBLE) AS success_rate_percent,
       mean_ms AS avg_execution_time_ms
FROM (SELECT query_type, count(*) AS n, count(*) FILTER (WHERE error_message IS NULL) AS good, round(avg(execution_time_ms), 6) AS mean_ms
      FROM query_attempts GROUP BY ALL)
""", "query_attempts")

sql("P20_sql_attempts", """
SELECT id, sub_query_trace_id, execution_time_ms, error_message, created_at FROM query_attempts WHERE query_type = 'sql'
""", "query_attempts")

sql("P20_vector_attempts", """
SELECT id, sub_query_trace_id, execution_time_ms, error_message, created_at FROM query_attempts WHERE query_type = 'vector'
""", "query_attempts")

ORACLE["G18_trace_tree"] = W("""
WITH RECURSIVE tree(id, root_id, depth) AS (
  SELECT id, id, 0 FROM execution_traces WHERE parent_trace_id IS NULL
  UNION ALL
  SELECT t.id, r.root_id, r.depth + 1 FROM execution_traces t JOIN tree r ON t.parent_trace_id = r.id)
SELECT id, root_id, depth FROM tree
""", "execution_traces")

sql("Q1_rules_insider_filing", """
SELECT * FROM (VALUES
  ('form_type_domain', (SELECT count(*) FROM insider_filing WHERE NOT (form_raw IN ('3', '4', '5', '3/A', '4/A', '5/A')))),
  ('filing_date_present', (SELECT count(*) FROM insider_filing WHERE NOT (filing_date IS NOT NULL)))
) v(rule, violations)
""", "insider_filing")

sql("Q1_rules_judgement", """
SELECT * FROM (VALUES
  ('control_score_range', (SELECT count(*) FROM judgement_scores WHERE NOT (control_score BETWEEN 0 AND 1))),
  ('experimental_score_range', (SELECT count(*) FROM judgement_scores WHERE NOT (experimental_score BETWEEN 0 AND 1))),
  ('improvement_range', (SELECT count(*) FROM judgement_scores WHERE NOT (improvement_delta BETWEEN -1 AND 1))),
  ('judge_type_domain', (SELECT count(*) FROM judgement_scores
      WHERE NOT (judge_type IN ('factual_grounding', 'completeness', 'consistency'))))
) v(rule, violations)
""", "judgement_scores")

sql("Q1_rules_ledger", """
SELECT * FROM (VALUES
  ('acquired_disposed_domain', (SELECT count(*) FROM insider_transaction_raw WHERE NOT (acquired_disposed IN ('A', 'D')))),
  ('code_length', (SELECT count(*) FROM insider_transaction_raw WHERE NOT (length(transaction_code) <= 2))),
  ('shares_non_negative', (SELECT count(*) FROM insider_transaction_raw WHERE NOT (shares >= 0)))
) v(rule, violations)
""", "insider_transaction_raw")

sql("Q2_duplicate_ledger_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
""")

sql("Q2_duplicate_judgements", """
SELECT evaluation_pair_id, judge_type, count(*) AS n
FROM (SELECT * FROM judgement_scores UNION ALL SELECT * FROM judgement_scores WHERE evaluation_pair_id % 50 = 0)
WHERE evaluation_pair_id IS NOT NULL AND judge_type IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
""", "judgement_scores")

sql("Q3_orphan_traces", """
SELECT c.* FROM execution_traces c
WHERE c.parent_trace_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM execution_traces p WHERE p.id = c.parent_trace_id)
""", "execution_traces")

sql("Q3_orphan_ledger_lines", """
SELECT c.* EXCLUDE (rn) FROM insider_transaction_raw c
WHERE c.insider_filing_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM insider_filing p WHERE p.id = c.insider_filing_id)
""", "insider_transaction_raw", "insider_filing")


def date10(x):
    return (f"CASE WHEN regexp_full_match(substr({x}, 1, 10), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN CAST(try_strptime(substr({x}, 1, 10), '%Y-%m-%d') AS DATE) END")


sql("P17_insider_header", f"""
SELECT id, accession_no, form_type, ends_with(form_type, '/A') AS is_amendment,
       coalesce({date10('filing_date_raw')}, {date10('reporting_period_raw')}, DATE '2025-01-01') AS filing_date,
       {date10('reporting_period_raw')} AS reporting_period,
       coalesce(nullif(trim(insider_name), ''), nullif(trim(owners[1].name), ''), 'Unknown Insider') AS insider_name
FROM (SELECT *, CASE WHEN form_raw IS NULL OR form_raw = '' THEN '' ELSE trim(replace(form_raw, 'Form', '')) END AS form_type
      FROM insider_header_raw)
""", "insider_header_raw")

sql("P18_ledger_rows", f"""
SELECT filing_id AS insider_filing_id, src_pos AS line_number,
  {date10('date')} AS transaction_date,
  nullif(trim(coalesce(nullif(security_title, ''), CASE WHEN NOT has_security_type THEN 'Common Stock' END,
                       nullif(transaction_type, ''))), '') AS security_title,
  coalesce(nullif(trim(code), ''), CASE WHEN has_security_type THEN 'H' END) AS transaction_code,
  nullif(trim(transaction_type), '') AS transaction_label,
  TRY_CAST(trim(shares) AS DECIMAL(20,4)) AS shares,
  TRY_CAST(trim(price) AS DECIMAL(20,4)) AS price_per_share,
  CASE ownership_type WHEN 'Direct' THEN 'D' WHEN 'Indirect' THEN 'I' END AS ownership,
  CASE WHEN has_security_type THEN
         CASE WHEN coalesce(contains(lower(nullif(trim(security_type), '')), 'derivative'), false)
              THEN TRY_CAST(trim(underlying_shares) AS DECIMAL(20,4)) ELSE TRY_CAST(trim(shares) AS DECIMAL(20,4)) END
       ELSE TRY_CAST(trim(remaining_shares) AS DECIMAL(20,4)) END AS shares_owned_following,
  coalesce(contains(lower(nullif(trim(security_type), '')), 'derivative'), false) AS is_derivative,
  TRY_CAST(trim(underlying_shares) AS DECIMAL(20,4)) AS underlying_shares,
  coalesce(nullif(trim(form), ''), '') AS form_label
FROM ownership_rows
""", "ownership_rows")

sql("S11_resolve_insiders", """
WITH inc AS (
  SELECT CASE WHEN cik IS NOT NULL THEN 'c:' || cik ELSE 'n:' || name END AS nk, cik, name, seq_d, seq_k
  FROM insider_incoming WHERE cik IS NOT NULL OR name IS NOT NULL),
inc1 AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY nk ORDER BY seq_d DESC, seq_k DESC) = 1),
cur AS (SELECT *, CASE WHEN cik IS NOT NULL THEN 'c:' || cik ELSE 'n:' || name END AS nk FROM insider_dim),
kept AS (
  SELECT cur.id, cur.cik, coalesce(u.name, cur.name) AS name FROM cur
  LEFT JOIN (SELECT nk, name FROM inc1 WHERE cik IS NOT NULL) u ON u.nk = cur.nk),
fresh AS (
  SELECT (SELECT coalesce(max(id), 0) FROM insider_dim) + row_number() OVER (ORDER BY nk) AS id, cik, name
  FROM inc1 WHERE nk NOT IN (SELECT nk FROM cur))
SELECT * FROM kept UNION ALL SELECT * FROM fresh
""", "insider_incoming", "insider_dim")

sql("J7_code_labels", """
WITH seen AS (SELECT DISTINCT transaction_code AS code FROM insider_transaction WHERE transaction_code IS NOT NULL),
allc AS (
  SELECT code, label, description FROM transaction_code
  UNION ALL
  SELECT code, 'Other (' || code || ')', 'Other (' || code || ')' FROM seen
  WHERE code NOT IN (SELECT code FROM transaction_code))
SELECT t.insider_filing_id, t.is_derivative, t.line_number, t.transaction_code, c.label AS code_label,
       c.description AS code_description
FROM insider_transaction t LEFT JOIN allc c ON c.code = t.transaction_code
""", "insider_transaction", "transaction_code")

sql("A10_filing_rollup", """
WITH l AS (
  SELECT *, line_number * 2 + CAST(is_derivative AS INTEGER) AS ln,
         CASE acquired_disposed WHEN 'A' THEN 1 WHEN 'D' THEN -1 ELSE 0 END AS sgn
  FROM insider_transaction),
a AS (
  SELECT insider_filing_id, CAST(sum(shares * sgn) AS DECIMAL(20,4)) AS net_change,
         round(sum(CAST(shares AS DOUBLE) * CAST(price_per_share AS DOUBLE) * sgn), 2) AS net_value,
         arg_max(shares_owned_following, CASE WHEN shares_owned_following IS NOT NULL THEN ln END) AS remaining_shares,
         count(DISTINCT transaction_code) AS nc, min(transaction_code) AS code
  FROM l GROUP BY 1)
SELECT insider_filing_id, net_change, net_value, remaining_shares,
       CASE WHEN nc > 1 THEN 'Mixed' WHEN nc = 1 THEN coalesce(c.label, 'Other (' || a.code || ')') END AS primary_activity
FROM a LEFT JOIN transaction_code c ON c.code = a.code
""", "insider_transaction", "transaction_code")

sql("W5_insider_cursor", """
SELECT ticker_id, accession_no AS latest_completed_accession, filing_date AS latest_completed_filing_date
FROM insider_filing WHERE completed
QUALIFY row_number() OVER (PARTITION BY ticker_id ORDER BY filing_date DESC, id DESC) = 1
""", "insider_filing")

sql("W5_filing_cursor", """
SELECT tickerId, accessionNo AS latest_completed_accession, filingDate AS latest_completed_filing_date
FROM filing WHERE completed AND type IN ('8-K', '10-K')
QUALIFY row_number() OVER (PARTITION BY tickerId ORDER BY filingDate DESC, id DESC) = 1
""", "filing")

sql("S8_seed_codes", """
WITH existing AS (
  SELECT DISTINCT transaction_code AS code, 'Other (' || transaction_code || ')' AS label,
         'Other (' || transaction_code || ')' AS description FROM insider_transaction)
SELECT * FROM existing
UNION ALL SELECT * FROM transaction_code WHERE code NOT IN (SELECT code FROM existing WHERE code IS NOT NULL)
""", "insider_transaction", "transaction_code")

_LEDGER_TS = """
target AS (SELECT * EXCLUDE (rn) FROM insider_transaction_raw WHERE rn = 1 AND NOT is_derivative),
source AS (SELECT * FROM insider_transaction_raw WHERE rn >= 2 OR is_derivative)"""

sql("S9_upsert_ledger", f"""
WITH {_LEDGER_TS},
s AS (SELECT * FROM source QUALIFY row_number() OVER (PARTITION BY insider_filing_id, is_derivative, line_number
                                                     ORDER BY rn DESC) = 1)
SELECT coalesce(t.insider_filing_id, s.insider_filing_id) AS insider_filing_id,
       coalesce(t.is_derivative, s.is_derivative) AS is_derivative,
       coalesce(t.line_number, s.line_number) AS line_number,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.transaction_date ELSE t.transaction_date END AS transaction_date,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.security_title ELSE t.security_title END AS security_title,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.transaction_code ELSE t.transaction_code END AS transaction_code,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.acquired_disposed ELSE t.acquired_disposed END AS acquired_disposed,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.shares ELSE t.shares END AS shares,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.price_per_share ELSE t.price_per_share END AS price_per_share,
       CASE WHEN s.insider_filing_id IS NOT NULL THEN s.shares_owned_following ELSE t.shares_owned_following END
         AS shares_owned_following
FROM target t FULL JOIN s USING (insider_filing_id, is_derivative, line_number)
""", "insider_transaction_raw")

sql("S10_insert_ignore_ledger", f"""
WITH {_LEDGER_TS},
s AS (SELECT * EXCLUDE (rn) FROM source QUALIFY row_number() OVER (PARTITION BY insider_filing_id, is_derivative, line_number
                                                     ORDER BY rn ASC) = 1)
SELECT * FROM target
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.insider_filing_id = s.insider_filing_id
  AND t.is_derivative = s.is_derivative AND t.line_number = s.line_number)
""", "insider_transaction_raw")

sql("S12_update_ticker", """
WITH src AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) END AS name, 'EQUITY' AS quote_type
             FROM customer WHERE c_nationkey < 5)
SELECT t.id, t.symbol,
       CASE WHEN s.id IS NOT NULL THEN coalesce(s.name, t.name) ELSE t.name END AS name,
       t.is_active,
       CASE WHEN s.id IS NOT NULL THEN coalesce(s.quote_type, t.quote_type) ELSE t.quote_type END AS quote_type
FROM ticker t LEFT JOIN src s ON s.id = t.id
""", "ticker")

sql("S15_delete_cascade", """
SELECT insider_filing_id, is_derivative, line_number, shares FROM insider_transaction
WHERE insider_filing_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""", "insider_transaction")


# --- financial facts ----------------------------------------------------------
from ticklake import schemas as _S  # noqa: E402


def num(x):
    d = f"TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)"
    return f"(CASE WHEN isfinite({d}) THEN TRY_CAST(trunc({d}) AS BIGINT) END)"


def optint(x):
    d = f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE)"
    return f"(CASE WHEN isnan({d}) THEN NULL ELSE TRY_CAST(trunc({d}) AS BIGINT) END)"


def norm(x):
    s = f"trim({x})"
    local = (f"CASE WHEN contains({s}, '}}') THEN regexp_extract({s}, '[^}}]*$') "
             f"WHEN contains({s}, ':') THEN regexp_extract({s}, '[^:]*$') ELSE {s} END")
    return f"lower(regexp_replace({local}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def infer(x):
    s = f"trim({x})"
    parts = [f"WHEN {s} IS NULL OR {s} = '' THEN NULL",
             f"WHEN contains({s}, '}}') THEN nullif(trim(regexp_extract({s}, '[^}}]*$')), '')",
             f"WHEN contains({s}, ':') THEN nullif(trim(regexp_extract({s}, '[^:]*$')), '')"]
    for p in _S.ANCHOR_PREFIXES:
        parts.append(f"WHEN starts_with(lower({s}), '{p}') THEN nullif(trim(substr({s}, {len(p) + 1})), '')")
    return "(CASE " + " ".join(parts) + " END)"


def lkey(n, i):
    if i == 0:
        return n
    p = _S.TAXONOMY_PREFIXES[i - 1]
    return f"(CASE WHEN starts_with({n}, '{p}') AND length({n}) > {len(p)} THEN substr({n}, {len(p) + 1}) END)"


def issuer_rest(x):
    s = f"trim({x})"
    pre = f"split_part({s}, '_', 1)"
    rest = f"trim(substr({s}, length({pre}) + 2))"
    pl = f"lower(replace({pre}, '-', ''))"
    blocked = ", ".join(f"'{b}'" for b in _S.ISSUER_BLOCKED)
    ok = (f"contains({s}, '_') AND length({pre}) BETWEEN 2 AND 5 "
          f"AND regexp_full_match(replace({pre}, '-', ''), '[\\p{{L}}\\p{{N}}]+') AND {pl} NOT IN ({blocked}) "
          f"AND NOT starts_with({pl}, 'usgaap') AND NOT starts_with({pl}, 'ifrs') AND {rest} <> ''")
    return f"(CASE WHEN {ok} THEN {rest} END)"


def pref_idx(line_code, n):
    keys = "list_value(" + ", ".join(lkey(n, i) for i in range(len(_S.TAXONOMY_PREFIXES) + 1)) + ")"
    whens = []
    for lc, prefs in _S.MERGE_PREFERRED.items():
        inner = " ".join(f"WHEN list_contains({keys}, '{p}') THEN {i}" for i, p in enumerate(prefs))
        whens.append(f"WHEN {line_code} = '{lc}' THEN (CASE {inner} END)")
    return "(CASE " + " ".join(whens) + " END)"


def _cand_sql():
    parts = []
    raws = {0: "std_for_map", 1: "concept_s", 2: issuer_rest("concept_s")}
    for g, r in raws.items():
        n = norm(r)
        for i in range(len(_S.TAXONOMY_PREFIXES) + 1):
            parts.append(f"SELECT concept_s, std_for_map, statement, {lkey(n, i)} AS key, {g * 100 + 3 + 2 * i} AS rank "
                         f"FROM keys WHERE {r} IS NOT NULL AND trim({r}) <> ''")
    return "\nUNION ALL ".join(parts)


_P0, _P1 = '"2023-09-30"', '"2024-02-15"'
FIN_CTES = f"""
rows AS (
  SELECT filing_accession, ticker_id, is_annual, statement, decimals, units, scale, {_P0} AS p0, {_P1} AS p1, seq,
         trim(concept) AS concept_s, nullif(trim(standard_concept), '') AS std_concept,
         CASE statement WHEN 'balance' THEN 0 WHEN 'income' THEN 1 ELSE 2 END AS srank
  FROM statement_wide
  WHERE (NOT coalesce(is_abstract, false) OR {num(_P0)} IS NOT NULL OR {num(_P1)} IS NOT NULL)
    AND concept IS NOT NULL AND trim(concept) <> ''),
rows2 AS (SELECT *, coalesce(std_concept, {infer('concept_s')}) AS std_for_map FROM rows),
keys AS (SELECT DISTINCT concept_s, std_for_map, statement FROM rows2),
cand AS ({_cand_sql()}),
best AS (SELECT c.concept_s, c.std_for_map, c.statement, arg_min(g.line_code, c.rank) AS line_code
         FROM cand c JOIN gaap_map g ON g.key = c.key AND g.statement = c.statement GROUP BY ALL),
mapped_keys AS (
  SELECT k.concept_s, k.std_for_map, k.statement, b.line_code FROM keys k LEFT JOIN best b
  ON k.concept_s = b.concept_s AND k.std_for_map IS NOT DISTINCT FROM b.std_for_map AND k.statement = b.statement),
rows3 AS (
  SELECT r.*, m.line_code FROM rows2 r LEFT JOIN mapped_keys m
  ON r.concept_s = m.concept_s AND r.std_for_map IS NOT DISTINCT FROM m.std_for_map AND r.statement = m.statement),
long AS (
  SELECT *, 0 AS pidx, DATE '2023-09-30' AS pdate, p0 AS raw_value FROM rows3 WHERE line_code IS NOT NULL
  UNION ALL SELECT *, 1 AS pidx, DATE '2024-02-15' AS pdate, p1 AS raw_value FROM rows3 WHERE line_code IS NOT NULL),
cands AS (
  SELECT filing_accession, ticker_id, year(pdate) AS fiscal_year,
         CASE WHEN is_annual THEN make_date(year(pdate), 12, 31)
              ELSE last_day(CAST(date_trunc('quarter', pdate) AS DATE) + INTERVAL 2 MONTH) END AS fiscal_period_end,
         CASE WHEN is_annual THEN 'annual' ELSE 'quarterly' END AS period_type,
         CASE WHEN is_annual THEN NULL ELSE quarter(pdate) END AS quarter,
         line_code, {num('raw_value')} AS value, {optint('decimals')} AS decimals, nullif(trim(units), '') AS unit,
         {optint('scale')} AS scale, concept_s AS source_concept, std_for_map AS source_standard_concept,
         (std_for_map IS NOT NULL AND trim(std_for_map) <> '') AS anchored, srank, pidx, seq
  FROM long WHERE {num('raw_value')} IS NOT NULL),
merged AS (
  SELECT * FROM cands QUALIFY row_number() OVER (
    PARTITION BY filing_accession, ticker_id, fiscal_year, fiscal_period_end, period_type, line_code
    ORDER BY coalesce({pref_idx('line_code', norm('source_concept'))}, 1048576),
             CASE WHEN {pref_idx('line_code', norm('source_concept'))} IS NOT NULL THEN 0 WHEN anchored THEN 0 ELSE 1 END,
             CASE WHEN {pref_idx('line_code', norm('source_concept'))} IS NOT NULL THEN '' ELSE {norm('source_concept')} END,
             srank, pidx, seq) = 1),
facts AS (
  SELECT * FROM merged QUALIFY row_number() OVER (
    PARTITION BY ticker_id, fiscal_year, fiscal_period_end, period_type, line_code ORDER BY filing_accession DESC) = 1)
"""
FACT_SEL = ("filing_accession, ticker_id, fiscal_year, fiscal_period_end, period_type, quarter, line_code, value, "
            "decimals, unit, scale, source_concept, source_standard_concept, anchored")


def fin_sql(name, body, *views):
    ORACLE[name] = W("WITH " + FIN_CTES.strip() + "\n" + body, "statement_wide", "gaap_map", *views)


fin_sql("P10_statement_rows", "SELECT filing_accession, ticker_id, statement, concept_s, std_concept FROM rows")
ORACLE["P9_unpivot_periods"] = W(f"""
SELECT filing_accession, ticker_id, concept, '2023-09-30' AS period, {num(_P0)} AS value FROM statement_wide
UNION ALL SELECT filing_accession, ticker_id, concept, '2024-02-15' AS period, {num(_P1)} AS value FROM statement_wide
""", "statement_wide")
fin_sql("J1_map_line_codes", "SELECT * FROM mapped_keys")
fin_sql("U1_union_candidates", f"SELECT {FACT_SEL} FROM cands")
fin_sql("W3_merge_facts", f"SELECT {FACT_SEL} FROM merged")
fin_sql("C2_financial_facts", f"SELECT {FACT_SEL} FROM facts")
fin_sql("C2_financial_build", f"""
, chosen AS (
  SELECT *, row_number() OVER (PARTITION BY ticker_id, is_annual ORDER BY filing_date DESC, filing_accession DESC) AS n FROM statement_filing
), oldest AS (
  SELECT merged.* FROM merged JOIN chosen USING (filing_accession) WHERE n <= CASE WHEN is_annual THEN 2 ELSE 3 END
  QUALIFY row_number() OVER (PARTITION BY merged.ticker_id, fiscal_year, fiscal_period_end, period_type, line_code ORDER BY filing_date, filing_accession) = 1
)
SELECT {FACT_SEL} FROM oldest
UNION ALL
SELECT {FACT_SEL} FROM facts f WHERE length(line_code) % 3 = 0 AND NOT EXISTS (
  SELECT 1 FROM oldest o WHERE o.ticker_id = f.ticker_id AND o.fiscal_year = f.fiscal_year AND o.fiscal_period_end = f.fiscal_period_end
  AND o.period_type = f.period_type AND o.line_code = f.line_code)""".replace("\n, chosen AS", ", chosen AS", 1), "statement_filing")
fin_sql("A6_merge_conflicts", """
SELECT filing_accession, ticker_id, fiscal_year, fiscal_period_end, period_type, line_code,
       count(DISTINCT value) AS n_values, min(value) AS min_value, max(value) AS max_value,
       array_to_string(list_sort(list(DISTINCT value))[1:10], ',') AS "values"
FROM cands GROUP BY ALL HAVING count(DISTINCT value) > 1""")
fin_sql("A7_unmapped_concepts", """
, u AS (SELECT DISTINCT statement, concept_s AS concept, std_concept AS standard_concept FROM rows3 WHERE line_code IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY statement ORDER BY concept ASC NULLS FIRST,
                                   standard_concept ASC NULLS FIRST) AS rn FROM u)
SELECT statement, count(*) AS unmapped_count,
       string_agg(CASE WHEN rn <= 25 THEN concept || '|' || coalesce(standard_concept, '') END, ';' ORDER BY rn) AS sample
FROM r GROUP BY statement""".replace("\n, u AS", "SELECT * FROM (WITH u AS", 1) if False else """
SELECT statement, count(*) AS unmapped_count,
       string_agg(CASE WHEN rn <= 25 THEN concept || '|' || coalesce(standard_concept, '') END, ';' ORDER BY rn) AS sample
FROM (SELECT *, row_number() OVER (PARTITION BY statement ORDER BY concept ASC NULLS FIRST,
                                   standard_concept ASC NULLS FIRST) AS rn
      FROM (SELECT DISTINCT statement, concept_s AS concept, std_concept AS standard_concept
            FROM rows3 WHERE line_code IS NULL))
GROUP BY statement""")
fin_sql("W4_latest_periods", """
SELECT ticker_id,
  max(CASE WHEN period_type = 'annual' THEN fiscal_period_end END) AS latest_annual_end,
  arg_max(fiscal_year, CASE WHEN period_type = 'annual' THEN fiscal_period_end END) AS latest_annual_year,
  max(CASE WHEN period_type = 'quarterly' THEN fiscal_period_end END) AS latest_quarter_end,
  arg_max(quarter, CASE WHEN period_type = 'quarterly' THEN fiscal_period_end END) AS latest_quarter,
  arg_max(fiscal_year, CASE WHEN period_type = 'quarterly' THEN fiscal_period_end END) AS latest_quarter_year
FROM facts GROUP BY ticker_id""")
_RL = ("current_assets", "current_liabilities", "inventory", "total_liabilities", "stockholders_equity",
       "net_income", "total_assets", "revenue", "gross_profit", "operating_income", "cashflow_operating", "capex")
_piv = ", ".join(f"max(CASE WHEN line_code = '{lc}' THEN CAST(value AS DOUBLE) END) AS {lc}" for lc in _RL)
_inlist = ", ".join(f"'{x}'" for x in _RL)


def _div(a, b):
    return f"round(({a}) / nullif({b}, 0.0), 6)"


fin_sql("A11_ratios", f"""
SELECT ticker_id, fiscal_year, fiscal_period_end, period_type,
  {_div('current_assets', 'current_liabilities')} AS current_ratio,
  {_div('current_assets - inventory', 'current_liabilities')} AS quick_ratio,
  {_div('total_liabilities', 'stockholders_equity')} AS debt_to_equity,
  {_div('net_income', 'total_assets')} AS return_on_assets,
  {_div('net_income', 'stockholders_equity')} AS return_on_equity,
  {_div('gross_profit', 'revenue')} AS gross_margin,
  {_div('operating_income', 'revenue')} AS operating_margin,
  {_div('net_income', 'revenue')} AS net_margin,
  cashflow_operating - capex AS free_cash_flow
FROM (SELECT ticker_id, fiscal_year, fiscal_period_end, period_type, {_piv}
      FROM facts WHERE line_code IN ({_inlist}) GROUP BY ALL)""")
fin_sql("J6_facts_by_term", """
SELECT f.ticker_id, f.fiscal_year, f.fiscal_period_end, f.period_type, f.line_code, f.value, l.display_name
FROM facts f JOIN financial_line l ON l.line_code = f.line_code WHERE list_contains(l.synonyms, lower('Cash'))""",
        "financial_line")

sql("P12_fiscal_periods", """
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
b AS (SELECT d, true AS is_annual FROM days UNION ALL SELECT d, false FROM days)
SELECT d, is_annual,
  CASE WHEN is_annual THEN make_date(year(d), 12, 31) ELSE last_day(CAST(date_trunc('quarter', d) AS DATE) + INTERVAL 2 MONTH) END
    AS fiscal_period_end,
  CASE WHEN is_annual THEN NULL ELSE quarter(d) END AS quarter, year(d) AS fiscal_year,
  CASE WHEN is_annual THEN 'annual' ELSE 'quarterly' END AS period_type
FROM b""")

sql("P13_optional_values", f"""
SELECT filing_id, {optint('shares')} AS shares_int, {optint('date')} AS date_int, nullif(trim(code), '') AS code,
       nullif(trim(transaction_type), '') AS kind,
       TRY_CAST(trunc(TRY_CAST(trim(price) AS DECIMAL(38,10))) AS BIGINT) AS price_int
FROM ownership_rows""", "ownership_rows")


# --- property graph -----------------------------------------------------------
def gsql(name, text):
    ORACLE[name] = W(text, "vertices", "edges")


def _hop(a, r, b, la=None, types=None, lb=None):
    cond_a = f" AND {a}.label = '{la}'" if la else ""
    cond_b = f" AND {b}.label = '{lb}'" if lb else ""
    where = f" AND {r}.type IN ({', '.join(repr(t) for t in types)})" if types else ""
    return (f"edges {r} JOIN vertices {a} ON {a}.id = {r}.src{cond_a} "
            f"JOIN vertices {b} ON {b}.id = {r}.dst{cond_b}{where}")


gsql("G1_top_reporters", f"""
WITH h AS (SELECT c.id AS c_id, c.name AS c_name, r.eid AS r_eid, m.id AS m_id, m.name AS m_name
           FROM {_hop('c', 'r', 'm', 'Company', ['REPORTS'], 'Metric')}),
top AS (SELECT c_id, count(r_eid) AS report_count FROM h GROUP BY c_id ORDER BY report_count DESC, c_id LIMIT 5)
SELECT h.c_id, c_name, r_eid, m_id, m_name, report_count FROM h JOIN top USING (c_id)
ORDER BY report_count DESC, c_id, r_eid LIMIT 50""")

gsql("G2_risk_networks", f"""
WITH f AS (SELECT c.id AS c_id, r.eid AS r_eid FROM {_hop('c', 'r', 'k', 'Company', ['FACES'], 'Risk')}),
top AS (SELECT c_id, count(r_eid) AS risk_count FROM f GROUP BY c_id ORDER BY risk_count DESC, c_id LIMIT 3),
h AS (SELECT c.id AS c_id, c.name AS c_name, r.eid AS r_eid, r.type AS r_type, x.id AS x_id, x.label AS x_label
      FROM {_hop('c', 'r', 'x', 'Company', ['FACES', 'IMPLEMENTS', 'PRODUCES'], None)})
SELECT h.c_id, c_name, r_eid, r_type, x_id, x_label, risk_count FROM h JOIN top USING (c_id)
ORDER BY risk_count DESC, c_id, r_eid LIMIT 40""")

_TWO = """edges r1 JOIN vertices a ON a.id = r1.src {la} JOIN vertices b ON b.id = r1.dst {lb}
  JOIN edges r2 ON r2.src = b.id AND r2.eid <> r1.eid {t2} JOIN vertices c ON c.id = r2.dst {lc}
  WHERE TRUE {t1}"""


def _two(la=None, t1=None, lb=None, t2=None, lc=None):
    def lab(x, l):
        return f"AND {x}.label = '{l}'" if l else ""

    def typ(r, t):
        return f"AND {r}.type IN ({', '.join(repr(x) for x in t)})" if t else ""
    return _TWO.format(la=lab("a", la), lb=lab("b", lb), lc=lab("c", lc), t1=typ("r1", t1), t2=typ("r2", t2))


gsql("G3_metric_chains", f"""
WITH p AS (SELECT a.id AS a_id, r1.eid AS r1_eid, b.id AS b_id, r2.eid AS r2_eid, c.id AS c_id
           FROM {_two('Company', ['REPORTS'], 'Metric', ['RELATED_TO'], 'Metric')}
           ORDER BY a_id, r1_eid, r2_eid LIMIT 20)
SELECT DISTINCT node_id, rel_id FROM (
  SELECT a_id AS node_id, r1_eid AS rel_id FROM p UNION ALL SELECT a_id, r2_eid FROM p
  UNION ALL SELECT b_id, r1_eid FROM p UNION ALL SELECT b_id, r2_eid FROM p
  UNION ALL SELECT c_id, r1_eid FROM p UNION ALL SELECT c_id, r2_eid FROM p)""")

gsql("G4_frequent_edges", f"""
SELECT c.id AS c_id, m.id AS m_id, r.eid AS r_eid, count(*) AS freq
FROM {_hop('c', 'r', 'm', 'Company', ['REPORTS'], 'Metric')}
GROUP BY c.id, m.id, r.eid ORDER BY freq DESC, c_id, m_id, r_eid LIMIT 30""")

gsql("G5_ego", f"""
SELECT c.id AS c_id, r.eid AS r_eid, r.type AS r_type, x.id AS x_id, x.label AS x_label
FROM {_hop('c', 'r', 'x', 'Company', None, None)} WHERE c.name = 'Customer#000000001'
ORDER BY c_id, r_eid LIMIT 50""")

gsql("G6_strategy_networks", """
SELECT c.id AS c_id, r1.eid AS r1_eid, s.id AS s_id, r2.eid AS r2_eid, t.id AS t_id
FROM edges r1 JOIN vertices c ON c.id = r1.src AND c.label = 'Company'
JOIN vertices s ON s.id = r1.dst AND s.label = 'Strategy'
LEFT JOIN edges r2 ON r2.src = s.id AND r2.type = 'MENTIONED_IN' AND r2.eid <> r1.eid
LEFT JOIN vertices t ON t.id = r2.dst
WHERE r1.type = 'IMPLEMENTS'
ORDER BY c_id, r1_eid, r2_eid NULLS FIRST LIMIT 30""")

gsql("G7_product_metrics", f"""
SELECT a.id AS c_id, r1.eid AS r1_eid, b.id AS p_id, r2.eid AS r2_eid, c.id AS m_id
FROM {_two('Company', ['PRODUCES'], 'Product', ['RELATED_TO'], 'Metric')}
ORDER BY c_id, r1_eid, r2_eid LIMIT 25""")

gsql("G8_cross_mentions", f"""
SELECT a.id AS c1_id, r1.eid AS r1_eid, b.id AS m_id, r2.eid AS r2_eid, c.id AS c2_id
FROM {_two('Company', ['REPORTS'], 'Metric', ['MENTIONED_IN'], 'Company')} AND a.id <> c.id
ORDER BY c1_id, r1_eid, r2_eid LIMIT 20""")


def _keys(p, n):
    return f"array_to_string(list_slice(list_sort(map_keys({p})), 1, {n}), ',')"


_H = """h AS (SELECT a.id AS a_id, a.label AS a_label, a.props AS a_props, r.eid AS r_eid, r.type AS r_type,
              r.props AS r_props, b.id AS b_id, b.label AS b_label, b.props AS b_props
       FROM edges r JOIN vertices a ON a.id = r.src JOIN vertices b ON b.id = r.dst)"""

gsql("G9_rel_samples", f"""
WITH {_H},
labels AS (SELECT r_type AS rel_type, array_to_string(list_sort(list(DISTINCT a_label)), ',') AS source_labels,
                  array_to_string(list_sort(list(DISTINCT b_label)), ',') AS target_labels FROM h GROUP BY r_type),
ex AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY r_type ORDER BY r_eid) <= 3),
exs AS (SELECT r_type AS rel_type,
               string_agg(concat_ws('|', a_label, {_keys('a_props', 3)}, r_type, {_keys('r_props', 3)}, b_label,
                                    {_keys('b_props', 3)}), ';' ORDER BY r_eid) AS sample_triplets
        FROM ex GROUP BY r_type)
SELECT * FROM labels JOIN exs USING (rel_type) ORDER BY rel_type LIMIT 20""")

gsql("G11_pattern_counts", """
SELECT sl || ' -[:' || type || ']-> ' || tl AS pattern, count(*) AS frequency
FROM edges e JOIN (SELECT id, unnest(labels) AS sl FROM vertices) a ON a.id = e.src
JOIN (SELECT id, unnest(labels) AS tl FROM vertices) b ON b.id = e.dst
GROUP BY sl, type, tl""")

gsql("G12_label_properties", """
WITH x AS (SELECT id, props, unnest(labels) AS node_type FROM vertices),
f AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY node_type ORDER BY id) <= 100),
k AS (SELECT node_type, unnest(map_keys(props)) AS p FROM f)
SELECT node_type, array_to_string(list_sort(list(DISTINCT p)), ',') AS properties FROM k GROUP BY node_type""")

gsql("G13_rel_properties", """
WITH f AS (SELECT * FROM edges QUALIFY row_number() OVER (PARTITION BY type ORDER BY eid) <= 100),
k AS (SELECT type AS relationship_type, unnest(map_keys(props)) AS p FROM f)
SELECT relationship_type, array_to_string(list_sort(list(DISTINCT p)), ',') AS properties FROM k
GROUP BY relationship_type""")

gsql("G14_schema_overview", f"""
WITH {_H}
SELECT a_label AS source_type, r_type AS relationship_type, b_label AS target_type, count(*) AS count,
       min({_keys('a_props', 5)}) AS sample_source_properties, min({_keys('r_props', 5)}) AS sample_rel_properties,
       min({_keys('b_props', 5)}) AS sample_target_properties
FROM h GROUP BY ALL ORDER BY count DESC, source_type, relationship_type, target_type LIMIT 20""")

gsql("G15_network_density", f"""
WITH rep AS (SELECT c.id AS c_id, count(r.eid) AS metric_count FROM {_hop('c', 'r', 'm', 'Company', ['REPORTS'], 'Metric')}
             GROUP BY c.id HAVING count(r.eid) > 20),
und AS (SELECT src AS a, dst AS b, eid FROM edges UNION ALL SELECT dst, src, eid FROM edges),
n1 AS (SELECT rep.c_id AS hub, u.b AS x, u.eid AS e1 FROM rep JOIN und u ON u.a = rep.c_id),
n2 AS (SELECT n1.hub, u.b AS y FROM n1 JOIN und u ON u.a = n1.x AND u.eid <> n1.e1),
conn AS (SELECT hub, x AS node FROM n1 UNION SELECT hub, y FROM n2)
SELECT conn.hub, hv.name AS central_company, rep.metric_count,
       array_to_string(list_sort(list(DISTINCT nv.label)), ',') AS connected_types,
       count(DISTINCT conn.node) AS network_size
FROM conn JOIN vertices nv ON nv.id = conn.node JOIN rep ON rep.c_id = conn.hub JOIN vertices hv ON hv.id = conn.hub
GROUP BY conn.hub, hv.name, rep.metric_count""")

gsql("G16_important_chains", f"""
WITH p AS (SELECT a.id AS a_id, a.name AS a_name, a.label AS a_label, r1.eid AS r1_eid, r1.type AS r1_type,
                  b.name AS b_name, b.label AS b_label, r2.eid AS r2_eid, r2.type AS r2_type, c.name AS c_name,
                  c.label AS c_label
           FROM {_two('Company', None, None, None, None)}),
s AS (SELECT *, CASE r1_type WHEN 'REPORTS' THEN 100 WHEN 'FACES' THEN 80 WHEN 'PRODUCES' THEN 70
                             WHEN 'IMPLEMENTS' THEN 60 ELSE 40 END
              + CASE r2_type WHEN 'RELATED_TO' THEN 50 WHEN 'MENTIONED_IN' THEN 40 WHEN 'IMPACTS' THEN 60
                             ELSE 30 END AS importance_score FROM p)
SELECT a_name AS start_entity, a_label AS start_type, r1_type AS first_relationship, b_name AS middle_entity,
       b_label AS middle_type, r2_type AS second_relationship, c_name AS end_entity, c_label AS end_type,
       importance_score,
       a_name || ' -[' || r1_type || ']-> ' || b_name || ' -[' || r2_type || ']-> ' || c_name AS full_chain
FROM s ORDER BY importance_score DESC, a_id, r1_eid, r2_eid LIMIT 25""")

gsql("G17_meta_graph", """
SELECT DISTINCT a.label AS source_label, r.type AS rel_type, b.label AS target_label
FROM edges r JOIN vertices a ON a.id = r.src JOIN vertices b ON b.id = r.dst""")

sql("L1_top_k_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")

gsql("L3_first_k_per_label", """
SELECT id, label FROM vertices QUALIFY row_number() OVER (PARTITION BY label ORDER BY id) <= 100""")


# --- filing text ----------------------------------------------------------------
from ticklake.functions import text as _TX  # noqa: E402

_WS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
_WSR = f"[{_WS}]+"


def squash(x):
    return f"trim(regexp_replace({x}, '{_WSR}', ' ', 'g'))"


def strip_ws(x):
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def clean(x):
    s = squash(f"coalesce({x}, '')")
    s = f"regexp_replace({s}, '<[^>]+>', ' ', 'g')"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_{_WS}.,!?\\-]', ' ', 'g')"
    return squash(s)


sql("T1_clean_text", f"SELECT id, {clean('text')} AS cleaned FROM filing", "filing")

_bp = " AND ".join(f"NOT contains(lower(x), '{p}')" for p in _S.TITLE_BOILERPLATE)
sql("T2_extract_title", f"""
SELECT id, coalesce(left(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {strip_ws('x')}),
                                     lambda x: length(x) > 20 AND {_bp})[1], 200), 'Press Release') AS title
FROM filing""", "filing")

sql("T4_squash", f"SELECT filing_id, ordinal, {squash('text')} AS text FROM attachment", "attachment")

sql("T5_sentences", f"""
WITH s AS (
  SELECT id, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?]){_WSR}([A-Z])',
             '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: {strip_ws('x')}), lambda x: x <> '') AS l
  FROM filing)
SELECT id, unnest(generate_series(1, len(l))) AS sentence_no, unnest(l) AS sentence FROM s WHERE len(l) > 0""",
    "filing")


def _unescape(x):
    s = x  # the references that the test pages hold; &amp; last
    for ent, code in (("&lt;", 60), ("&gt;", 62), ("&quot;", 34), ("&apos;", 39), ("&nbsp;", 160), ("&copy;", 169), ("&middot;", 183)):
        s = f"replace({s}, '{ent}', chr({code}))"
    return f"replace({s}, '&amp;', '&')"


_blocks = "|".join(_TX.BLOCK_TAGS)
_h = "html"
_h = f"regexp_replace({_h}, '(?is)<script\\b.*?</script\\s*>', ' ', 'g')"
_h = f"regexp_replace({_h}, '(?is)<style\\b.*?</style\\s*>', ' ', 'g')"
_h = f"regexp_replace({_h}, '(?s)<!--.*?-->', ' ', 'g')"
_h = f"regexp_replace({_h}, '(?i)</?({_blocks})\\b[^>]*>', chr(10) || chr(10), 'g')"
_h = f"regexp_replace({_h}, '<[^>]*>', '', 'g')"
_h = _unescape(_h)
_h = f"regexp_replace({_h}, '[ \\t\\x0B\\f\\r\\x{{A0}}]+', ' ', 'g')"
_h = f"regexp_replace({_h}, ' ?\\n ?', chr(10), 'g')"
_h = f"regexp_replace({_h}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
_h = f"trim({_h}, ' ' || chr(10))"
sql("T8_html_to_text", f"SELECT page_id, {_h} AS text FROM pages")

sql("S6_pick_attachment", """
SELECT filing_id, ordinal, document_type, text FROM attachment
QUALIFY row_number() OVER (PARTITION BY filing_id ORDER BY NOT coalesce(contains(document_type, 'EX-99'), false),
                           ordinal) = 1""", "attachment")

_rules = ", ".join(f"('{f}', '{sid}', '{t.replace(chr(39), chr(39) * 2)}', {i}, '{c}')"
                   for f, sid, t, cands in _S.MDNA_SECTIONS for i, c in enumerate(cands))
_SECTIONS = f"""
WITH r AS (SELECT form, section_id, section_title, cand_pos, regexp_replace(lower(cand), '[^a-z0-9]', '', 'g') AS k
           FROM (VALUES {_rules}) v(form, section_id, section_title, cand_pos, cand)),
f AS (SELECT id, type, string_split(text, chr(10)) AS l FROM filing WHERE type IN ('10-K', '10-Q')),
items AS (SELECT id AS filing_id, 'Item ' || (generate_subscripts(l, 1) - 1) AS item_key, unnest(l) AS content FROM f),
it AS (SELECT filing_id, regexp_replace(lower(item_key), '[^a-z0-9]', '', 'g') AS k, content FROM items
       WHERE content IS NOT NULL AND content <> '')
SELECT fl.id AS filing_id, fl.type AS form, r.section_id, r.section_title, arg_min(it.content, r.cand_pos) AS content
FROM filing fl JOIN r ON r.form = fl.type JOIN it ON it.filing_id = fl.id AND it.k = r.k
GROUP BY ALL"""
sql("P23_mdna_sections", _SECTIONS, "filing")


# markdown: rows (k, x) -> (k, markdown)
_NOT_WS = f"[^{_WS}]"


def markdown(src):
    spaced = f"regexp_replace({strip_ws(f"regexp_replace(p, '{_WSR}', ' ', 'g')")}, '([.,!?:;])([^{_WS}\\p{{Nd}}])', '\\1 \\2', 'g')"
    lines = "string_split(p, chr(10))"
    bullet = strip_ws(f"regexp_replace(z, '^[{_WS}]*[•\\-\\*][{_WS}]*', '- ')")
    return f"""(
WITH texts AS (
  SELECT k, list_filter(list_transform(regexp_split_to_array({_unescape("coalesce(x, '')")}, '\\n[{_WS}]*\\n'), lambda z: {strip_ws('z')}), lambda z: z <> '') AS l FROM {src}
), paras AS (
  SELECT k, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS p FROM texts
), kinds AS (
  SELECT *, regexp_matches(p, '(\\|.*\\|)|({_NOT_WS}+[{_WS}]{{2,}}{_NOT_WS}+[{_WS}]{{2,}}{_NOT_WS}+)') AS t, {spaced} AS pc FROM paras
), formed AS (
  SELECT k, i, t, lag(t, 1, false) OVER (PARTITION BY k ORDER BY i) AS within,
    CASE WHEN contains(p, '|') THEN p ELSE '| ' || array_to_string(regexp_split_to_array(p, '[{_WS}]{{2,}}'), ' | ') || ' |' END AS line,
    CASE WHEN regexp_matches(p, '^[{_WS}]*\\d+\\.[{_WS}]') THEN array_to_string(list_transform({lines}, lambda z: {strip_ws('z')}), chr(10))
         WHEN regexp_matches(p, '^[{_WS}]*[•\\-\\*][{_WS}]') THEN array_to_string(list_transform({lines}, lambda z: {bullet}), chr(10))
         WHEN upper(pc) = pc AND lower(pc) <> pc THEN '## ' || pc
         WHEN length(pc) < 80 AND ends_with(pc, ':') THEN '### ' || pc
         WHEN regexp_matches(pc, '^[A-Z][a-z]+[{_WS}]+\\p{{Nd}}+(\\.|:)') THEN '### ' || pc ELSE pc END AS plain
  FROM kinds
), joined AS (
  SELECT k, string_agg(CASE WHEN NOT t THEN chr(10) || chr(10) || plain WHEN within THEN chr(10) || line
    ELSE chr(10) || chr(10) || line || chr(10) || '| ' || array_to_string(list_transform(range(length(line) - length(replace(line, '|', '')) - 1), lambda z: '---'), ' | ') || ' |'
    END, '' ORDER BY i) AS md FROM formed GROUP BY k
)
SELECT texts.k, coalesce(substr(md, 3), '') AS markdown FROM texts LEFT JOIN joined ON joined.k = texts.k)"""


sql("T3_markdown", f"SELECT k AS page_id, markdown FROM {markdown(f'(SELECT page_id AS k, {_h} AS x FROM pages)')}")


def chunks(src, n=500, overlap=50):
    """Rows (k, x) -> (k, c, chunk): a step of the recursion closes a chunk, at
    the first sentence that the buffer cannot take."""
    cut = f"string_split(regexp_replace({squash("coalesce(x, '')")}, '([.!?]){_WSR}([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    return f"""(
WITH RECURSIVE sents AS (
  SELECT k, list_filter(list_transform({cut}, lambda z: {strip_ws('z')}), lambda z: z <> '') AS l FROM {src}
), sizes AS (
  SELECT k, unnest(range(1, len(l) + 1)) AS j, unnest(list_transform(l, lambda z: len(string_split(z, ' ')))) AS n FROM sents
), cums AS (
  SELECT k, j, n, sum(n) OVER (PARTITION BY k ORDER BY j)::BIGINT AS total FROM sizes
), steps AS (
  SELECT DISTINCT k, 0 AS c, NULL::BIGINT AS a, NULL::BIGINT AS b, 0::BIGINT AS s, 1::BIGINT AS j FROM cums
  UNION ALL
  SELECT steps.k, steps.c + 1, steps.s, arg_min(cums.total - cums.n, cums.j), greatest(arg_min(cums.total - cums.n, cums.j) - {overlap}, steps.s), min(cums.j)
  FROM steps JOIN cums ON cums.k = steps.k AND cums.j > steps.j AND cums.total - steps.s > {n} GROUP BY steps.k, steps.c, steps.s
), ranges AS (
  SELECT k, c, a, b FROM steps WHERE c > 0
  UNION ALL SELECT k, max(c) + 1, arg_max(s, c), (SELECT max(total) FROM cums WHERE cums.k = steps.k) FROM steps GROUP BY k
)
SELECT ranges.k, c, array_to_string(string_split(array_to_string(l, ' '), ' ')[a + 1:b], ' ') AS chunk FROM ranges JOIN sents ON sents.k = ranges.k)"""


sql("T6_chunks", f"SELECT k AS id, c::INTEGER AS chunk_number, chunk FROM {chunks(f'(SELECT id AS k, {clean("text")} AS x FROM filing)')}", "filing")


def _count_words(x):
    return f"CASE WHEN {squash(x)} = '' THEN 0 ELSE len(string_split({squash(x)}, ' ')) END"


def _statements(src, label, title, words_of):
    """Rows (k, x) of raw texts -> rows of the statements table."""
    return f"""(
WITH whole AS (SELECT k, {clean('x')} AS x FROM {src}),
cut AS (SELECT struct_pack(k := k, c := c) AS k, chunk AS x FROM {chunks("(SELECT * FROM whole WHERE x <> '')")}),
md AS {markdown('cut')}
SELECT cut.k.k.id AS filingId, {label} || '_chunk_' || cut.k.c AS section, {title} AS title, {clean('cut.x')} AS content, cut.x AS raw_content,
       md.markdown AS markdown_content, ({_count_words(words_of)})::INTEGER AS word_count, cut.k.c::INTEGER AS chunk_number
FROM cut JOIN md ON md.k = cut.k JOIN whole ON whole.k = cut.k.k)"""


_title = (f"coalesce(left(list_filter(list_transform(string_split(whole.x, chr(10)), lambda x: {strip_ws('x')}), "
          f"lambda x: length(x) > 20 AND {_bp})[1], 200), 'Press Release')")


def _press(where="true"):
    src = f"(SELECT struct_pack(id := filing_id) AS k, text AS x FROM ({_ATTACHMENT}) WHERE {where})"
    return _statements(src, "'8-K PR'", _title, clean("cut.x"))


def _mdna(where="true"):
    src = f"(SELECT struct_pack(id := filing_id, section := section_id, title := section_title) AS k, content AS x FROM ({_SECTIONS}) WHERE {where})"
    return _statements(src, "cut.k.k.section", "cut.k.k.title", "cut.x")


_ATTACHMENT = """SELECT filing_id, ordinal, document_type, text FROM attachment
QUALIFY row_number() OVER (PARTITION BY filing_id ORDER BY NOT coalesce(contains(document_type, 'EX-99'), false), ordinal) = 1"""
sql("T7_press_release_chunks", f"SELECT * FROM {_press()}", "attachment")
sql("T7_mdna_chunks", f"SELECT * FROM {_mdna()}", "filing")


# --- market data ----------------------------------------------------------------
def _jkey(k):
    return f"'$.{k}'"


def _container(k):
    return f"coalesce(json_type(info, {_jkey(k)}) IN ('ARRAY', 'OBJECT'), false)"


_prof = ",\n  ".join(
    f"CASE WHEN {_container(k)} THEN CAST(json_extract(info, {_jkey(k)}) AS VARCHAR) "
    f"ELSE json_extract_string(info, {_jkey(k)}) END AS {n}" for k, n in _S.PROFILE_KEYS)


def _epoch(x):
    return f"(CASE WHEN TRY_CAST({x} AS BIGINT) > 0 THEN CAST(to_timestamp(TRY_CAST({x} AS BIGINT)) AS DATE) END)"


sql("P1_ticker_profile", f"""
SELECT ticker_id, event_id,
  {_prof},
  {_epoch("json_extract_string(info, '$.fundInceptionDate')")} AS fund_inception_date
FROM company_info_wide WHERE info IS NOT NULL""", "company_info_wide")

sql("P2_epoch_to_date", f"""
SELECT event_id, {_epoch("json_extract_string(info, '$.fundInceptionDate')")} AS d1,
       {_epoch("'x' || json_extract_string(info, '$.fundInceptionDate')")} AS d2,
       {_epoch("CAST(event_id % 3 - 1 AS VARCHAR)")} AS d3
FROM company_info_wide""", "company_info_wide")


def _metric(k, typ, default):
    val = f"TRY_CAST(json_extract_string(info, {_jkey(k)}) AS {'VARCHAR' if typ == 'string' else typ.upper()})"
    lit = "''" if typ == "string" else (f"CAST({default} AS {typ.upper()})")
    return f"coalesce(CASE WHEN NOT {_container(k)} THEN {val} END, {lit}) AS {k}"


_mets = ",\n  ".join(_metric(k, t, dflt) for k, t, dflt in _S.DEFAULT_METRICS)
_opts = ",\n  ".join(f"CASE WHEN NOT {_container(k)} THEN TRY_CAST(json_extract_string(info, {_jkey(k)}) AS DOUBLE) END AS {n}"
                     for n, k in _S.OPTIONAL_METRICS)
sql("P3_fundamentals", f"""
SELECT ticker_id AS tickerId, DATE '2024-02-01' AS date,
  {_mets},
  {_opts}
FROM company_info_wide WHERE info IS NOT NULL AND info <> '{{}}'""", "company_info_wide")

sql("S1_prices", "SELECT * FROM price WHERE tickerId IS NOT NULL AND date IS NOT NULL AND open IS NOT NULL AND "
    "high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL", "price")
sql("S2_splits", "SELECT * FROM split", "split")
sql("A5_price_cursor", """
SELECT tickerId, max(date) AS latest_date, max(date) >= DATE '1998-08-01' AS up_to_date FROM price GROUP BY tickerId""",
    "price")
sql("P21_newer_prices", """
WITH hwm AS (SELECT tickerId, max(date) AS m FROM price WHERE date < DATE '1997-01-01' GROUP BY tickerId)
SELECT p.tickerId, p.date, p.close FROM price p LEFT JOIN hwm h ON h.tickerId = p.tickerId
WHERE h.m IS NULL OR p.date > h.m""", "price")

_w = "PARTITION BY tickerId ORDER BY date"
sql("W7_moving_stats", f"""
WITH s AS (
  SELECT tickerId, date, CAST(close AS DOUBLE) AS c,
    avg(CAST(close AS DOUBLE)) OVER ({_w} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS ma50,
    avg(CAST(close AS DOUBLE)) OVER ({_w} ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS ma200,
    min(CAST(low AS DOUBLE)) OVER ({_w} RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW) AS lo,
    max(CAST(high AS DOUBLE)) OVER ({_w} RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW) AS hi
  FROM price)
SELECT tickerId, date, round(ma50, 6) AS fifty_day_average, round(c - ma50, 6) AS fifty_day_average_change,
       round(ma200, 6) AS two_hundred_day_average, round(c - ma200, 6) AS two_hundred_day_average_change,
       round(lo, 6) AS fifty_two_week_low, round(hi, 6) AS fifty_two_week_high,
       round(c - lo, 6) AS fifty_two_week_low_change, round(c - hi, 6) AS fifty_two_week_high_change
FROM s""", "price")

sql("J9_split_adjust", """
SELECT p.tickerId, p.date, CAST(p.close AS DOUBLE) AS close,
       product(coalesce(CAST(s.ratio AS DOUBLE), 1.0)) AS split_factor,
       CAST(p.close AS DOUBLE) / product(coalesce(CAST(s.ratio AS DOUBLE), 1.0)) AS adj_close
FROM price p LEFT JOIN split s ON s.tickerId = p.tickerId AND s.date > p.date
GROUP BY p.tickerId, p.date, p.close""", "price", "split")


def _dow(d):  # Spark numbering: 1 = Sunday
    return f"(dayofweek({d}) + 1)"


def _nth(m, dow, n):
    if n > 0:
        f = f"make_date(y, {m}, 1)"
        return f"({f} + CAST(({dow} - {_dow(f)} + 7) % 7 + {7 * (n - 1)} AS INTEGER))"
    last = f"last_day(make_date(y, {m}, 1))"
    return f"({last} - CAST(({_dow(last)} - {dow} + 7) % 7 AS INTEGER))"


def _obs(d):
    return f"(CASE {_dow(d)} WHEN 7 THEN {d} - 1 WHEN 1 THEN {d} + 1 ELSE {d} END)"


_hol = " UNION ALL ".join([
    f"SELECT {_obs('make_date(y, 1, 1)')} AS d FROM yrs",
    f"SELECT {_nth(1, 2, 3)} FROM yrs WHERE y >= 1986",
    f"SELECT {_nth(2, 2, 3)} FROM yrs",
    f"SELECT {_nth(5, 2, -1)} FROM yrs",
    f"SELECT {_obs('make_date(y, 6, 19)')} FROM yrs WHERE y >= 2021",
    f"SELECT {_obs('make_date(y, 7, 4)')} FROM yrs",
    f"SELECT {_nth(9, 2, 1)} FROM yrs",
    f"SELECT {_nth(10, 2, 2)} FROM yrs",
    f"SELECT {_obs('make_date(y, 11, 11)')} FROM yrs",
    f"SELECT {_nth(11, 5, 4)} FROM yrs",
    f"SELECT {_obs('make_date(y, 12, 25)')} FROM yrs",
])
sql("P24_market_days", f"""
WITH yrs AS (SELECT CAST(generate_series AS INTEGER) AS y FROM generate_series(1990, 2031)),
hol AS (SELECT DISTINCT CAST(d AS DATE) AS d FROM ({_hol}) WHERE year(d) BETWEEN 1990 AND 2030),
days AS (SELECT DISTINCT date FROM price)
SELECT days.date, dayofweek(days.date) NOT IN (0, 6) AND hol.d IS NULL AS is_market_day
FROM days LEFT JOIN hol ON hol.d = days.date""", "price")


# --- incremental planning -----------------------------------------------------------
sql("P5_edgar_eligible", "SELECT id, symbol, quote_type, quote_type IS NULL OR quote_type = 'EQUITY' AS edgar_eligible "
    "FROM ticker", "ticker")
sql("P6_active_tickers", "SELECT id, upper(symbol) AS symbol, name FROM ticker WHERE is_active", "ticker")
sql("P7_resolve_tickers", """
WITH n AS (SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN 'c' || o_custkey WHEN 1 THEN lower(c_name)
                                ELSE 'nobody ' || o_custkey END AS requested
           FROM orders JOIN customer ON o_custkey = c_custkey),
h AS (SELECT n.requested, t.id, 0 AS r FROM n JOIN ticker t ON upper(t.symbol) = upper(trim(n.requested))
      UNION ALL SELECT n.requested, t.id, 1 FROM n JOIN ticker t ON upper(t.name) = upper(trim(n.requested))),
b AS (SELECT requested, arg_min(id, r * 1000000000000 + id) AS ticker_id FROM h GROUP BY requested)
SELECT n.requested, b.ticker_id FROM n LEFT JOIN b USING (requested)""", "ticker")
_REQ = "(SELECT DISTINCT upper(trim('c' || o_custkey)) AS symbol FROM orders WHERE o_orderpriority = '1-URGENT')"
sql("P8_select_tickers", f"""
SELECT id, upper(symbol) AS symbol, name FROM ticker WHERE is_active AND upper(symbol) IN {_REQ}
ORDER BY symbol LIMIT 100""", "ticker")
sql("U3_missing_tickers", f"""
SELECT symbol FROM {_REQ} r WHERE symbol NOT IN (SELECT upper(symbol) FROM ticker WHERE is_active)""", "ticker")


def _latest(limits):
    cases = " ".join(f"WHEN '{k}' THEN {n}" for k, n in limits.items())
    forms = ", ".join(f"'{k}'" for k in limits)
    return f"""(SELECT * FROM filing WHERE type IN ({forms})
  QUALIFY row_number() OVER (PARTITION BY tickerId, type ORDER BY filingDate DESC, id DESC) <= CASE type {cases} END)"""


sql("W2_latest_filings", f"SELECT id, tickerId, type, filingDate FROM {_latest({'8-K': 5, '10-K': 2, '10-Q': 3})}",
    "filing")
sql("P25_filing_record", """
SELECT id, accessionNo, tickerId, type, filingDate AS filing_date, year(filingDate) AS year,
       DATE '2025-01-01' AS download_date, false AS completed FROM filing""", "filing")
_STORED = "(SELECT * EXCLUDE (text) FROM filing WHERE id % 2 = 0)"
sql("J5_pending_filings", f"""
WITH c AS (SELECT accessionNo, tickerId, type FROM {_latest({'8-K': 5, '10-K': 2, '10-Q': 3})}),
s AS {_STORED}
SELECT c.accessionNo, c.tickerId, c.type, i.id AS existing_id FROM c
LEFT JOIN (SELECT accessionNo, id FROM s WHERE NOT completed) i ON i.accessionNo = c.accessionNo
WHERE c.accessionNo NOT IN (SELECT accessionNo FROM s WHERE completed)""", "filing")
_TODO = f"""(SELECT c.id, c.accessionNo, c.type FROM {_latest({'8-K': 5, '10-K': 2, '10-Q': 3})} c
WHERE c.accessionNo NOT IN (SELECT accessionNo FROM {_STORED} WHERE completed))"""
_STATEMENTS = f"""SELECT * FROM {_press(f"filing_id IN (SELECT id FROM {_TODO} WHERE type = '8-K')")}
UNION ALL SELECT * FROM {_mdna(f"filing_id IN (SELECT id FROM {_TODO} WHERE type IN ('10-K', '10-Q'))")}"""
sql("C3_filing_text_build", _STATEMENTS, "filing", "attachment")
sql("C3_filing", f"""
WITH made AS (SELECT DISTINCT filingId FROM ({_STATEMENTS}))
SELECT * EXCLUDE (text) REPLACE ((id IN (SELECT filingId FROM made) OR (id % 2 = 0 AND completed)) AS completed) FROM filing
WHERE id % 2 = 0 OR (id IN (SELECT id FROM {_TODO}) AND accessionNo NOT IN (SELECT accessionNo FROM {_STORED}))""", "filing", "attachment")
_SHOULD = f"""(SELECT c.tickerId, count(*) AS n_candidates, count(d.accessionNo) AS n_completed,
       count(*) > 0 AND count(d.accessionNo) < count(*) AS should_run
FROM (SELECT accessionNo, tickerId FROM {_latest({'8-K': 5, '10-K': 2})}) c
LEFT JOIN (SELECT DISTINCT accessionNo FROM {_STORED} WHERE completed) d ON d.accessionNo = c.accessionNo
GROUP BY c.tickerId)"""
sql("A4_should_run", f"SELECT * FROM {_SHOULD}", "filing")
sql("A8_run_counters", """
SELECT process_name, count(*) FILTER (WHERE action = 'start') AS n_start, count(*) FILTER (WHERE action = 'success') AS n_success,
       count(*) FILTER (WHERE action = 'failed') AS n_failed, count(*) AS n_events FROM run_log GROUP BY process_name""",
    "run_log")
_STATE = """(SELECT ticker_id, process_name,
  arg_max(CASE action WHEN 'start' THEN 'running' WHEN 'success' THEN 'success' WHEN 'failed' THEN 'failed' ELSE 'idle' END,
          (ts, event_id)) AS status,
  count(*) FILTER (WHERE action = 'start') AS attempts,
  max(CASE WHEN action = 'start' THEN ts END) AS last_started_at,
  max(CASE WHEN action = 'success' THEN ts END) AS last_completed_at,
  max(CASE WHEN action = 'failed' THEN ts END) AS last_failed_at,
  arg_max(cursor, (ts, event_id)) FILTER (WHERE action = 'success') AS last_success_cursor
FROM run_log GROUP BY ticker_id, process_name)"""
sql("A9_run_state", f"SELECT * FROM {_STATE}", "run_log")
_LIM = "TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 90 MINUTE"
sql("I4_stale_runs", f"SELECT * FROM {_STATE} WHERE status = 'running' AND last_started_at < {_LIM}", "run_log")
sql("I5_startable", f"""
SELECT ticker_id, process_name, status <> 'running' OR last_started_at IS NULL OR last_started_at < {_LIM} AS startable
FROM {_STATE}""", "run_log")
sql("I6_plan_runs", f"""
WITH grid AS (SELECT t.id AS ticker_id, t.quote_type IS NULL OR t.quote_type = 'EQUITY' AS el, p.process_name
              FROM ticker t, (VALUES ('stocks'), ('financials'), ('press_releases'), ('insider_transactions')) p(process_name)),
checks AS (
  SELECT tickerId AS ticker_id, 'stocks' AS process_name, NOT (max(date) >= DATE '1998-08-01') AS has_new_data
  FROM price GROUP BY tickerId
  UNION ALL SELECT tickerId, 'press_releases', should_run FROM {_SHOULD}),
st AS (SELECT ticker_id, process_name,
              status <> 'running' OR last_started_at IS NULL OR last_started_at < {_LIM} AS startable FROM {_STATE})
SELECT g.ticker_id, g.process_name,
  CASE WHEN NOT (g.process_name = 'stocks' OR g.el) THEN 'skip-ineligible'
       WHEN NOT coalesce(c.has_new_data, true) THEN 'skip-no-new-data'
       WHEN NOT coalesce(st.startable, true) THEN 'skip-locked' ELSE 'run' END AS verdict
FROM grid g LEFT JOIN checks c USING (ticker_id, process_name) LEFT JOIN st USING (ticker_id, process_name)""",
    "ticker", "price", "filing", "run_log")
sql("I7_new_statements", """
WITH f AS (SELECT * EXCLUDE (text) FROM filing),
p AS (SELECT tickerId, type, max(filingDate) AS pointer_date FROM f WHERE completed AND id % 3 <> 0 GROUP BY ALL),
l AS (SELECT * FROM f WHERE type IN ('10-K', '10-Q')
      QUALIFY row_number() OVER (PARTITION BY tickerId, type ORDER BY filingDate DESC, id DESC) = 1)
SELECT l.tickerId, l.type, l.id, l.accessionNo, l.filingDate AS new_pointer_date, year(l.filingDate) AS new_pointer_year,
       CASE WHEN l.type = '10-Q' THEN quarter(l.filingDate) END AS new_pointer_quarter
FROM l LEFT JOIN p USING (tickerId, type) WHERE p.pointer_date IS NULL OR l.filingDate > p.pointer_date""", "filing")


# --- vectors --------------------------------------------------------------------
sql("V1_knn", """
WITH n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
                  sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS nrm
           FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, list_dot_product(a.v, b.v) / (a.nrm * b.nrm) AS score
      FROM n a JOIN n b ON a.vec_id <> b.vec_id WHERE a.nrm > 0 AND b.nrm > 0)
SELECT query_id, rank, neighbor_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM s)
WHERE rank <= 5""")


ORACLE["V2_ivf_search"] = ORACLE["V1_knn"]  # without nprobe the index search is exact


# --- streaming -------------------------------------------------------------------
sql("I1_stream_upsert", """
SELECT user_id, event_type, ts, value, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
sql("I2_stream_once", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
sql("I2_stream_once_ever", "SELECT DISTINCT user_id, event_type FROM events WHERE user_id % 10 <> 0 OR user_id IS NULL")
sql("I3_stream_newer", """
WITH m AS (SELECT user_id, max(ts) AS hwm FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_id)
SELECT e.event_id, e.user_id, e.ts FROM events e LEFT JOIN m USING (user_id) WHERE m.hwm IS NULL OR e.ts > m.hwm""")
ORACLE["I4_stream_run_state"] = ORACLE["A9_run_state"]

ORACLE["C5_daily_plan"] = f"SELECT process_name, verdict, count(*) AS n FROM ({ORACLE['I6_plan_runs']}) GROUP BY ALL"

# --- composite jobs, one query per table they write -----------------------------
sql("C1_price", """
WITH old AS (SELECT * FROM price WHERE date < DATE '1997-01-01'),
mark AS (SELECT tickerId, max(date) AS d FROM old GROUP BY 1)
SELECT * FROM old UNION ALL
SELECT p.* FROM price p LEFT JOIN mark USING (tickerId) WHERE mark.d IS NULL OR p.date > mark.d
""", "price")
sql("C1_split", "SELECT * FROM split", "split")
ORACLE["C1_fundamentals"] = ORACLE["P3_fundamentals"]
ORACLE["C1_ticker"] = W(f"""
WITH prof AS (SELECT * FROM ({ORACLE['P1_ticker_profile']}) QUALIFY row_number() OVER (PARTITION BY ticker_id ORDER BY event_id DESC) = 1)
SELECT t.id, t.symbol, t.is_active, coalesce(prof.name, t.name) AS name, coalesce(prof.quote_type, t.quote_type) AS quote_type,
       prof.* EXCLUDE (ticker_id, event_id, name, quote_type)
FROM ticker t LEFT JOIN prof ON prof.ticker_id = t.id
""", "ticker")
ORACLE["C1_market_build"] = ORACLE["C1_ticker"]

_INSIDERS = f"""
WITH stored AS (SELECT * FROM insider_filing WHERE id % 2 = 0),
head AS (SELECT p.*, h.ticker_id FROM ({ORACLE['P17_insider_header']}) p JOIN insider_header_raw h USING (id)
         WHERE p.accession_no NOT IN (SELECT accession_no FROM stored WHERE completed)),
dim AS ({ORACLE['S11_resolve_insiders']}),
link AS (SELECT filing_id, dim.id AS insider_id FROM insider_incoming i
         JOIN dim ON CASE WHEN i.cik IS NULL THEN dim.cik IS NULL AND dim.name = i.name ELSE dim.cik = i.cik END),
fil AS (
  SELECT h.id, h.ticker_id, link.insider_id, accession_no, form_type, is_amendment, filing_date, reporting_period, insider_name, true AS completed
  FROM head h LEFT JOIN link ON link.filing_id = h.id
  UNION ALL
  SELECT id, ticker_id, insider_id, accession_no, trim(replace(form_raw, 'Form', '')), ends_with(form_raw, '/A'), filing_date, NULL, NULL, completed
  FROM stored WHERE completed),
lines AS (
  SELECT insider_filing_id, is_derivative, line_number, transaction_date, security_title, transaction_code,
         CASE transaction_code WHEN 'P' THEN 'A' WHEN 'S' THEN 'D' END AS acquired_disposed, shares, price_per_share, shares_owned_following,
         head.ticker_id, link.insider_id
  FROM ({ORACLE['P18_ledger_rows']}) l JOIN head ON head.id = insider_filing_id LEFT JOIN link ON link.filing_id = head.id),
ledger AS (
  SELECT * FROM lines UNION ALL
  SELECT insider_filing_id, is_derivative, line_number, transaction_date, security_title, transaction_code, acquired_disposed, shares,
         price_per_share, shares_owned_following, t.ticker_id, t.insider_id
  FROM insider_transaction t JOIN stored ON stored.id = t.insider_filing_id
  WHERE (insider_filing_id, is_derivative, line_number) NOT IN (SELECT (insider_filing_id, is_derivative, line_number) FROM lines))
"""
_USED = ("insider_filing", "insider_header_raw", "insider_incoming", "insider_transaction", "transaction_code")
for _name, _body in {
    "C4_filing": "SELECT * FROM fil",
    "C4_ledger": "SELECT * FROM ledger",
    "C4_rollup": """SELECT insider_filing_id, net_change, net_value, remaining_shares,
       CASE WHEN nc > 1 THEN 'Mixed' WHEN nc = 1 THEN coalesce(c.label, 'Other (' || a.code || ')') END AS primary_activity
FROM (SELECT insider_filing_id, CAST(sum(shares * sgn) AS DECIMAL(20,4)) AS net_change,
             CAST(sum(CAST(shares * price_per_share AS DECIMAL(38,4)) * sgn) AS DECIMAL(20,2)) AS net_value,
             arg_max(shares_owned_following, CASE WHEN shares_owned_following IS NOT NULL THEN line_number END) AS remaining_shares,
             count(DISTINCT transaction_code) AS nc, min(transaction_code) AS code
      FROM (SELECT *, CASE acquired_disposed WHEN 'A' THEN 1 WHEN 'D' THEN -1 ELSE 0 END AS sgn FROM lines) GROUP BY 1) a
LEFT JOIN transaction_code c ON c.code = a.code""",
    "C4_position": """SELECT ticker_id, insider_id, security_title, is_derivative, shares_owned_following AS shares_held, transaction_date AS as_of_date, insider_filing_id
FROM ledger WHERE shares_owned_following IS NOT NULL AND insider_filing_id IN (SELECT id FROM fil WHERE completed)
QUALIFY row_number() OVER (PARTITION BY ticker_id, insider_id, coalesce(security_title, ''), is_derivative
                           ORDER BY transaction_date DESC NULLS LAST, insider_filing_id DESC, line_number DESC) = 1""",
}.items():
    ORACLE[_name] = W(_INSIDERS + _body, *_USED)
ORACLE["C4_insider_build"] = ORACLE["C4_rollup"]
ORACLE["C2_pointers"] = W(f"""
SELECT t.id, t.symbol, p.* EXCLUDE (ticker_id) FROM ticker t LEFT JOIN ({ORACLE['W4_latest_periods']}) p ON p.ticker_id = t.id
""", "ticker")


# --- loaders and single operators on derived inputs -------------------------------
sql("S4_statement_rows", """
SELECT 'income' AS statement, 'acc-' || l_orderkey AS filing_accession, 'c' || l_linenumber AS concept, CAST(last_day(l_shipdate) AS DATE) AS period,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS value FROM lineitem""")
sql("S5_filing_index", """
SELECT accessionNo AS accession_no, type AS form, CAST(filingDate AS DATE) AS filing_date, CAST(tickerId AS VARCHAR) AS ticker FROM filing""", "filing")
sql("S7_overrides", """
WITH ok AS (SELECT n_name, 'line_' || n_regionkey AS line_code FROM nation WHERE n_nationkey % 3 <> 0)
SELECT 'Custom:' || n_name AS key, line_code FROM ok
UNION ALL SELECT lower(regexp_replace(n_name, '[^\\p{L}\\p{N}]', '', 'g')), line_code FROM ok""")
sql("S13_insert_unique", "SELECT * EXCLUDE (text) FROM filing", "filing")
sql("S14_touched", """
SELECT id, CASE WHEN id % 14 = 0 THEN lower(name) WHEN id % 7 = 0 THEN upper(name) ELSE name END AS name,
       CASE WHEN id % 14 = 0 THEN TIMESTAMP '2024-06-01 00:00:00' WHEN id % 7 = 0 THEN TIMESTAMP '2024-05-01 00:00:00' END AS updated_at FROM ticker""", "ticker")
sql("P19_ledger_rows_alias", f"""
SELECT filing_id AS insider_filing_id, src_pos AS line_number, {date10('date')} AS transaction_date,
  nullif(trim(coalesce(security_title, 'Stock')), '') AS security_title, nullif(trim(code), '') AS transaction_code,
  nullif(trim(transaction_type), '') AS transaction_label, CAST(NULL AS VARCHAR) AS transaction_description, CAST(NULL AS VARCHAR) AS acquired_disposed,
  CAST(CAST(shares AS DOUBLE) AS DECIMAL(20,4)) AS shares, TRY_CAST(trim(price) AS DECIMAL(20,4)) AS price_per_share,
  CAST(NULL AS DECIMAL(20,4)) AS transaction_value, nullif(trim(ownership_type), '') AS ownership, CAST(NULL AS VARCHAR) AS ownership_nature,
  TRY_CAST(trim(coalesce(remaining_shares, shares)) AS DECIMAL(20,4)) AS shares_owned_following, CAST(NULL AS DECIMAL(20,4)) AS exercise_price,
  CAST(NULL AS DATE) AS expiration_date, CAST(NULL AS VARCHAR) AS underlying_security_title, CAST(NULL AS DECIMAL(20,4)) AS underlying_shares,
  CAST(NULL AS VARCHAR) AS is_10b5_1, CAST(NULL AS VARCHAR) AS footnotes, false AS is_derivative
FROM ownership_rows""", "ownership_rows")
sql("P22_latest_column_date", "SELECT CAST(max(last_day(l_shipdate)) AS DATE) AS latest FROM lineitem")
_lines = ", ".join(f"('{r[0]}', '{r[1]}')" for r in _S.FINANCIAL_LINES)
sql("Q4_check_mapping", f"""
WITH g AS (SELECT DISTINCT line_code, statement AS map_statement FROM gaap_map WHERE key IN (SELECT standard_concept FROM statement_wide)),
l AS (SELECT line_code, line_statement FROM (VALUES {_lines}) v(line_code, line_statement) WHERE length(line_code) % 5 <> 0)
SELECT line_code, map_statement, line_statement,
       CASE WHEN line_statement IS NULL THEN 'map' WHEN map_statement IS NULL THEN 'line' ELSE 'statement' END AS problem
FROM g FULL JOIN l USING (line_code) WHERE line_statement IS NULL OR map_statement IS NULL OR line_statement <> map_statement""", "gaap_map", "statement_wide")
gsql("L2_sample_edges", "SELECT eid, src, dst, type FROM edges ORDER BY md5('7:' || eid), eid LIMIT 25")


def _two(p):
    return f"array_to_string(list_transform(list_slice(list_sort(map_keys({p})), 1, 2), lambda x: x || ': ' || {p}[x]), ',')"


gsql("G10_triplet_view", f"""
WITH {_H}
SELECT a_label AS source_node_type, {_two('a_props')} AS source_sample_props, r_type AS relationship_type, {_two('r_props')} AS rel_sample_props,
       b_label AS target_node_type, {_two('b_props')} AS target_sample_props FROM h ORDER BY md5('42:' || r_eid), r_eid LIMIT 25""")
sql("V3_hash_embed", f"""
WITH c AS (SELECT k AS id, c::INTEGER AS chunk_number, chunk FROM {chunks(f'(SELECT id AS k, {clean("text")} AS x FROM filing)')}),
t AS (SELECT id, chunk_number, unnest(string_split({squash('lower(chunk)')}, ' ')) AS t FROM c WHERE {squash('chunk')} <> ''),
n AS (SELECT id, chunk_number, ('0x' || substr(md5('42:' || t), 1, 8))::BIGINT % 64 AS i, count(*)::DOUBLE AS n FROM t GROUP BY ALL),
m AS (SELECT id, chunk_number, map(list(i), list(n)) AS m, sqrt(sum(n * n)) AS size FROM n GROUP BY ALL)
SELECT id, chunk_number, list_transform(range(64), lambda d: (coalesce(m[d], 0.0) / size)::FLOAT) AS embedding FROM m""", "filing")


def _rules(table, rules, *views, src=None):
    rows = ", ".join(f"('{n}', (SELECT count(*) FROM {src or table} WHERE NOT ({r})))" for n, r in rules)
    return f"SELECT * FROM (VALUES {rows}) v(rule, violations)"


sql("Q1_rules_run_state", _rules("s", (
    ("ticker_present", "ticker_id IS NOT NULL"), ("process_name_domain", "process_name IN ('stocks', 'financials', 'press_releases', 'insider_transactions')"),
    ("process_status_domain", "status IN ('idle', 'running', 'success', 'failed')"), ("attempts_present", "attempts IS NOT NULL")), src=_STATE), "run_log")
fin_sql("Q1_rules_facts", _rules("facts", (
    ("fiscal_year_present", "fiscal_year IS NOT NULL"), ("period_end_present", "fiscal_period_end IS NOT NULL"),
    ("period_type_domain", "period_type IN ('annual', 'quarterly')"), ("quarter_range", "quarter IS NULL OR quarter BETWEEN 1 AND 4"),
    ("value_present", "value IS NOT NULL"), ("source_concept_present", "source_concept IS NOT NULL"))))
sql("Q1_rules_annotations", """
WITH a AS (SELECT CASE WHEN toxic = 1 THEN 'none' WHEN quality = 1 THEN 'experimental' ELSE 'tie' END AS preferred, doc_id % 6 AS factual,
                  doc_id % 5 + 1 AS relevance, CASE WHEN doc_id % 2 = 0 THEN doc_id % 7 END AS complete FROM labels)
SELECT 'preferred_response_domain' AS rule, count(*) FILTER (WHERE preferred = 'none') AS violations FROM a
UNION ALL SELECT 'factual_accuracy_range', count(*) FILTER (WHERE factual NOT BETWEEN 1 AND 5) FROM a
UNION ALL SELECT 'relevance_range', count(*) FILTER (WHERE relevance NOT BETWEEN 1 AND 5) FROM a
UNION ALL SELECT 'completeness_range', count(*) FILTER (WHERE complete NOT BETWEEN 1 AND 5) FROM a""")
ORACLE["S13_enforced_run_state"] = ORACLE["A9_run_state"]
