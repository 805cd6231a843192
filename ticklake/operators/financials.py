"""XBRL statement frames -> canonical financial facts.

Flow (C2): statement rows (P10) -> candidate keys mapped to line codes on the
*distinct* concepts only (J1, broadcast rule table) -> join back -> unpivot the
period columns (P9) -> numeric values (P11) and fiscal periods (P12) -> merge
pick per fact grain (W3) -> upsert (S9).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import coerce as C
from ..session import cut_lineage
from .common import first_by, top_k_per_group

#: concepts (with anchor and statement) whose mapping is given to all tasks; more are joined by key
MAX_MAPPED = 100_000
STATEMENT_ORDER = {"balance": 0, "income": 1, "cashflow": 2}
_PERIOD_FORMATS = ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%Y%m%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S")


# SQL-text builders for the large J1 / W3 expressions: one parse on the JVM side
# instead of hundreds of Python->JVM calls per plan.
def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_WS_SQL = "'" + "".join(f"\\u{ord(ch):04x}" for ch in C.WHITESPACE) + "'"


def _strip_sql(x: str) -> str:
    return f"btrim(CAST({x} AS STRING), {_WS_SQL})"


def _norm_sql(x: str) -> str:
    s = _strip_sql(x)
    local = (f"CASE WHEN contains({s}, '}}') THEN substring_index({s}, '}}', -1) "
             f"WHEN contains({s}, ':') THEN substring_index({s}, ':', -1) ELSE {s} END")
    return f"lower(regexp_replace({local}, '[^\\\\p{{L}}\\\\p{{N}}]', ''))"


def _keys_sql(n: str) -> str:
    parts = [n] + [f"CASE WHEN startswith({n}, '{p}') AND length({n}) > {len(p)} THEN substring({n}, {len(p) + 1}) END"
                   for p in schemas.TAXONOMY_PREFIXES]
    return "array(" + ", ".join(parts) + ")"


def _infer_sql(x: str) -> str:
    s = _strip_sql(x)
    branches = [f"WHEN {s} IS NULL OR {s} = '' THEN NULL",
                f"WHEN contains({s}, '}}') THEN {_strip_sql(f'substring_index({s}, chr(125), -1)')}",
                f"WHEN contains({s}, ':') THEN {_strip_sql(f'substring_index({s}, chr(58), -1)')}"]
    for p in schemas.ANCHOR_PREFIXES:
        branches.append(f"WHEN startswith(lower({s}), '{p}') THEN {_strip_sql(f'substring({s}, {len(p) + 1})')}")
    return f"nullif(CASE {' '.join(branches)} END, '')"


def _issuer_sql(x: str) -> str:
    s = _strip_sql(x)
    pre = f"substring_index({s}, '_', 1)"
    rest = _strip_sql(f"substring({s}, length({pre}) + 2)")
    pl = f"lower(replace({pre}, '-', ''))"
    blocked = ", ".join(f"'{b}'" for b in schemas.ISSUER_BLOCKED)
    ok = (f"contains({s}, '_') AND length({pre}) BETWEEN 2 AND 5 "
          f"AND replace({pre}, '-', '') RLIKE '^[\\\\p{{L}}\\\\p{{N}}]+$' AND NOT {pl} IN ({blocked}) "
          f"AND NOT startswith({pl}, 'usgaap') AND NOT startswith({pl}, 'ifrs') AND {rest} <> ''")
    return f"CASE WHEN {ok} THEN {rest} END"


def _cand_sql(r: str, n: str, k: str, group: int) -> str:
    base = group * 100
    items = [f"named_struct('key', {r}, 'kind', 'ovr', 'rank', {base})",
             f"named_struct('key', {n}, 'kind', 'ovr', 'rank', {base + 1})"]
    for i in range(len(schemas.TAXONOMY_PREFIXES) + 1):
        items.append(f"named_struct('key', {k}[{i}], 'kind', 'ovr', 'rank', {base + 2 + 2 * i})")
        items.append(f"named_struct('key', {k}[{i}], 'kind', 'map', 'rank', {base + 3 + 2 * i})")
    empty = "CAST(array() AS array<struct<key:string,kind:string,rank:int>>)"
    return f"CASE WHEN {r} IS NOT NULL AND {r} <> '' THEN array({', '.join(items)}) ELSE {empty} END"


def _pref_sql(line_code: str, keys: str) -> str:
    whens = []
    for lc, prefs in schemas.MERGE_PREFERRED.items():
        inner = " ".join(f"WHEN array_contains({keys}, '{p}') THEN {i}" for i, p in enumerate(prefs))
        whens.append(f"WHEN {line_code} = '{lc}' THEN (CASE {inner} END)")
    return "CASE " + " ".join(whens) + " END"



# ---------------------------------------------------------------------------
# Period columns and statement rows
# ---------------------------------------------------------------------------
def parse_period_name(name: str) -> dt.date | None:
    s = str(name).strip()
    for fmt in _PERIOD_FORMATS:
        try:
            return dt.datetime.strptime(s, fmt).date()
        except ValueError:
            continue
    return None


def period_columns(df: DataFrame) -> list[str]:
    """Column names that are dates (schema metadata only, read on the driver);
    the 11 metadata names are skipped case-blind, unparsable names are skipped."""
    meta = set(schemas.STATEMENT_METADATA_COLUMNS)
    return [c for c in df.columns if c.strip().lower() not in meta and parse_period_name(c) is not None]


def _find(df: DataFrame, *names: str) -> str | None:
    low = {c.lower(): c for c in df.columns}
    for n in names:
        if n.lower() in low:
            return low[n.lower()]
    return None


def statement_rows(df: DataFrame) -> DataFrame:
    """P10: drop abstract rows that carry no number in any period, drop blank
    concepts; without a concept column the ``index`` column is the concept.
    Adds ``concept_s`` (trimmed) and ``std_concept`` (trimmed or NULL)."""
    periods = period_columns(df)
    concept = _find(df, "concept")
    std = _find(df, "standard_concept", "standardconcept")
    abstract = _find(df, "is_abstract", "isabstract")
    if concept is None:
        idx = _find(df, "index")
        if idx is None:
            raise ValueError("statement frame has neither a concept nor an index column")
        out = df.withColumn("concept_s", C.strip(F.col(idx)))
        return out.where(F.col("concept_s").isNotNull()).withColumn("std_concept", F.lit(None).cast("string"))
    has_num = F.lit(False)
    for p in periods:
        has_num = has_num | C.extract_numeric(F.col(f"`{p}`")).isNotNull()
    out = df
    if abstract is not None:
        is_abs = F.coalesce(F.col(abstract).cast("string").try_cast("boolean"), F.lit(False))
        out = out.where(~is_abs | has_num)
    out = out.withColumn("concept_s", C.strip(F.col(concept)))
    out = out.where(F.col("concept_s").isNotNull() & (F.col("concept_s") != ""))
    std_col = C.clean_text(F.col(std)) if std else F.lit(None).cast("string")
    return out.withColumn("std_concept", std_col)


def unpivot_periods(df: DataFrame, ids: Sequence[str], periods: Sequence[str] | None = None) -> DataFrame:
    """Wide period columns -> rows (period name, raw value as text)."""
    periods = list(periods) if periods is not None else period_columns(df)
    cast = df.select(*ids, *[F.col(f"`{p}`").cast("string").alias(p) for p in periods])
    return cast.unpivot(list(ids), list(periods), "period", "raw_value")


# ---------------------------------------------------------------------------
# Concept -> line code
# ---------------------------------------------------------------------------
def _after_last(s: Column, ch: str) -> Column:
    return F.substring_index(s, ch, -1)


def normalize_name(c: Column | str) -> Column:
    """Local name (after the last '}' else after the last ':'), lower-case,
    letters and digits only."""
    if isinstance(c, str):
        return F.expr(_norm_sql(_q(c)))
    s = C.strip(c)
    local = F.when(s.contains("}"), _after_last(s, "}")).when(s.contains(":"), _after_last(s, ":")).otherwise(s)
    return F.lower(F.regexp_replace(local, r"[^\p{L}\p{N}]", ""))


def infer_standard_concept(c: Column | str) -> Column:
    """Anchor from the concept: its local name after '}' or ':', else the text
    after one of 12 known taxonomy prefixes (case-blind), else NULL."""
    if isinstance(c, str):
        return F.expr(_infer_sql(_q(c)))
    s = C.strip(c)
    low = F.lower(s)
    by_prefix = F.lit(None).cast("string")
    for p in reversed(schemas.ANCHOR_PREFIXES):
        by_prefix = F.when(low.startswith(p), C.strip(F.substring(s, len(p) + 1, 1 << 30))).otherwise(by_prefix)
    out = (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
        .when(s.contains("}"), C.strip(_after_last(s, "}")))
        .when(s.contains(":"), C.strip(_after_last(s, ":")))
        .otherwise(by_prefix)
    )
    return F.nullif(out, F.lit(""))


def overrides_df(spark: SparkSession, rows: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Overrides (concept, line_code) -> keys: the raw concept and its
    normalised name; incomplete rows skipped."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("concept", T.StringType()), T.StructField("line_code", T.StringType())])
    return load_overrides_df(schemas.local_df(spark, list(rows), schema))


def load_overrides_df(df: DataFrame) -> DataFrame:
    ok = df.where(F.col("concept").isNotNull() & (F.col("concept") != "") &
                  F.col("line_code").isNotNull() & (F.col("line_code") != ""))
    lc = C.strip(F.col("line_code"))
    raw = ok.select(C.strip(F.col("concept")).alias("key"), lc.alias("line_code"))
    nrm = ok.select(normalize_name("concept").alias("key"), lc.alias("line_code"))
    return raw.unionByName(nrm).dropDuplicates(["key"])


def load_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Read the overrides JSON document ``{"overrides": [{concept, line_code}]}``."""
    doc = spark.read.option("multiLine", True).json(path)
    if "overrides" not in doc.columns:
        return overrides_df(spark)
    rows = doc.select(F.explode_outer("overrides").alias("o")).select(
        F.col("o.concept").cast("string").alias("concept"), F.col("o.line_code").cast("string").alias("line_code"))
    return load_overrides_df(rows)


def map_line_codes(keys: DataFrame, gaap: DataFrame, overrides: DataFrame | None = None,
                   concept_col: str = "concept_s", std_col: str = "std_for_map",
                   statement_col: str = "statement") -> DataFrame:
    """Add ``line_code`` to each distinct (concept, anchor, statement) row.

    Priority: anchor, then concept, then issuer remainder; inside each: override
    on the raw text, override on the normalised name, then for each lookup key
    an override or a map entry whose statement matches.  Candidates are exploded
    with their rank and joined to the bounded rule table (broadcast); the lowest
    rank wins.  Call it on DISTINCT concepts and join the result back.
    """
    spark = keys.sparkSession
    ov = overrides if overrides is not None else overrides_df(spark)
    rules = (
        gaap.select("key", "line_code", "statement", F.lit("map").alias("kind"))
        .unionByName(ov.select("key", "line_code", F.lit(None).cast("string").alias("statement"),
                               F.lit("ovr").alias("kind")))
    )
    k = keys.select(concept_col, std_col, statement_col).distinct()
    staged = k.selectExpr(
        "*", f"{_strip_sql(_q(std_col))} AS _r0", f"{_strip_sql(_q(concept_col))} AS _r1",
        f"{_issuer_sql(_q(concept_col))} AS _r2")
    staged = staged.selectExpr("*", *[f"{_norm_sql(f'_r{g}')} AS _n{g}" for g in range(3)])
    staged = staged.selectExpr("*", *[f"{_keys_sql(f'_n{g}')} AS _k{g}" for g in range(3)])
    cand = F.expr("concat(" + ", ".join(_cand_sql(f"_r{g}", f"_n{g}", f"_k{g}", g) for g in range(3)) + ")")
    ex = staged.select(concept_col, std_col, statement_col, F.explode(cand).alias("c")).select(
        concept_col, std_col, statement_col, F.col("c.key").alias("_key"), F.col("c.kind").alias("_kind"),
        F.col("c.rank").alias("_rank")).where(F.col("_key").isNotNull())
    r = rules.select(F.col("key").alias("_key"), F.col("kind").alias("_kind"),
                     F.col("statement").alias("_rstmt"), F.col("line_code").alias("_lc"))
    hit = ex.join(F.broadcast(r), ["_key", "_kind"]).where(
        (F.col("_kind") == "ovr") | (F.col("_rstmt") == F.col(statement_col)))
    best = hit.groupBy(F.col(concept_col).alias("_bc"), F.col(std_col).alias("_bs"),
                       F.col(statement_col).alias("_bt")).agg(F.min_by("_lc", "_rank").alias("line_code"))
    on = (F.col(concept_col).eqNullSafe(F.col("_bc")) & F.col(std_col).eqNullSafe(F.col("_bs"))
          & F.col(statement_col).eqNullSafe(F.col("_bt")))
    return k.join(best, on, "left").drop("_bc", "_bs", "_bt")


# ---------------------------------------------------------------------------
# candidates, merge
# ---------------------------------------------------------------------------
def statement_candidates(frame: DataFrame, statement: str | None, is_annual: Column | bool,
                         gaap: DataFrame, overrides: DataFrame | None = None,
                         ids: Sequence[str] = ("filing_accession", "ticker_id"),
                         seq_col: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Candidate facts of one statement frame (P9-P13 + J1).

    Returns (candidates, unmapped rows).  ``seq`` carries the input order:
    (statement, period column position, row order)."""
    periods = period_columns(frame)
    rows = statement_rows(frame)
    stmt_col = F.lit(statement) if statement is not None else F.col("statement")
    rows = rows.withColumn("statement", stmt_col)
    # all per-concept work (anchor inference, candidate keys, rule join) runs on
    # the distinct (concept, standard concept, statement) keys only
    keys = rows.select("concept_s", "std_concept", "statement").distinct().withColumn(
        "std_for_map", F.coalesce(F.col("std_concept"), infer_standard_concept("concept_s")))
    mk = map_line_codes(keys, gaap, overrides)
    mk = mk.select(F.col("concept_s").alias("_mc"), F.col("std_for_map").alias("_ms"),
                   F.col("statement").alias("_mt"), "line_code")
    keyed = keys.join(mk, (F.col("concept_s") == F.col("_mc")) & F.col("std_for_map").eqNullSafe(F.col("_ms"))
                      & (F.col("statement") == F.col("_mt")), "left").select(
        F.col("concept_s").alias("_kc"), F.col("std_concept").alias("_ks"), F.col("statement").alias("_kt"),
        "std_for_map", "line_code")
    # the mapping goes to the rows: rows dealt by concept would be a few large tasks
    keyed = cut_lineage(keyed)
    if keyed.count() <= MAX_MAPPED:
        keyed = F.broadcast(keyed)
    rows = rows.join(keyed, (F.col("concept_s") == F.col("_kc")) & F.col("std_concept").eqNullSafe(F.col("_ks"))
                     & (F.col("statement") == F.col("_kt")), "left").drop("_kc", "_ks", "_kt")
    unmapped = rows.where(F.col("line_code").isNull()).select(
        "statement", F.col("concept_s").alias("concept"), F.col("std_concept").alias("standard_concept"))
    dec = _find(frame, "decimals")
    unit = _find(frame, "units", "unit")
    scale = _find(frame, "scale")
    ann = is_annual if isinstance(is_annual, Column) else F.lit(bool(is_annual))
    keep = [*ids, "statement", "line_code", "concept_s", "std_for_map", seq_col,
            *([dec] if dec else []), *([unit] if unit else []), *([scale] if scale else [])]
    ann_name = "_is_annual"
    base = rows.where(F.col("line_code").isNotNull()).withColumn(ann_name, ann)
    pos = {p: i for i, p in enumerate(periods)}
    long = unpivot_periods(base.select(*keep, ann_name, *[F.col(f"`{p}`") for p in periods]),
                           [*keep, ann_name], periods)
    pidx = F.lit(None).cast("int")
    for p, i in pos.items():
        pidx = F.when(F.col("period") == p, F.lit(i)).otherwise(pidx)
    pdate = _period_date(F.col("period"), periods)
    value = C.extract_numeric(F.col("raw_value"))
    a = F.col(ann_name)
    out = long.withColumn("_pdate", pdate).withColumn("value", value).where(F.col("value").isNotNull()).select(
        *ids,
        F.year("_pdate").alias("fiscal_year"),
        C.fiscal_period_end(F.col("_pdate"), a).alias("fiscal_period_end"),
        C.period_type(a).alias("period_type"),
        C.fiscal_quarter(F.col("_pdate"), a).alias("quarter"),
        "line_code", "value",
        (C.opt_int(F.col(dec)) if dec else F.lit(None).cast("bigint")).alias("decimals"),
        (C.opt_str(F.col(unit)) if unit else F.lit(None).cast("string")).alias("unit"),
        (C.opt_int(F.col(scale)) if scale else F.lit(None).cast("bigint")).alias("scale"),
        F.col("concept_s").alias("source_concept"),
        F.col("std_for_map").alias("source_standard_concept"),
        (F.col("std_for_map").isNotNull() & (C.strip(F.col("std_for_map")) != "")).alias("anchored"),
        F.struct(_statement_rank(F.col("statement")).alias("s"), pidx.alias("p"), F.col(seq_col).alias("r")).alias("seq"),
    )
    return out, unmapped


def _statement_rank(c: Column) -> Column:
    out = F.lit(9)
    for name, i in reversed(list(STATEMENT_ORDER.items())):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out


def _period_date(c: Column, periods: Sequence[str]) -> Column:
    """Period column name -> DATE (names were parsed on the driver)."""
    out = F.lit(None).cast("date")
    for p in periods:
        d = parse_period_name(p)
        out = F.when(c == p, F.lit(d.isoformat()).cast("date")).otherwise(out)
    return out


def union_statements(*frames: DataFrame) -> DataFrame:
    """Union by name of the statements' candidates (missing columns NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


GRAIN = ["ticker_id", "fiscal_year", "fiscal_period_end", "period_type", "line_code"]


def merge_facts(cands: DataFrame, grain: Sequence[str] = ("filing_accession", *GRAIN)) -> DataFrame:
    """One fact per grain.

    A preferred local name of the line code wins, in the listed order, then
    input order; otherwise anchored rows win, then the normalised name, then
    input order (``seq``).  A min-by aggregate: hot grains are combined
    map-side before the shuffle."""
    staged = cands.selectExpr("*", f"{_norm_sql('source_concept')} AS _norm")
    staged = staged.selectExpr("*", f"{_keys_sql('_norm')} AS _keys")
    staged = staged.selectExpr("*", f"{_pref_sql('line_code', '_keys')} AS _pref")
    pref, norm = F.col("_pref"), F.col("_norm")
    matched = pref.isNotNull()
    order = [
        F.coalesce(pref, F.lit(1 << 20)),
        F.when(matched, F.lit(0)).otherwise(F.when(F.col("anchored"), F.lit(0)).otherwise(F.lit(1))),
        F.when(matched, F.lit("")).otherwise(norm),
        F.col("seq"),
    ]
    # A grain is one filing x period x line code: a handful of candidates by
    # construction (no hot key), so a row_number pick (one shuffle, one sort) is
    # cheaper than a sort-based struct min_by aggregate with a partial pass.
    w = Window.partitionBy(*grain).orderBy(*order)
    return staged.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(*cands.columns)


def merge_conflicts(cands: DataFrame, grain: Sequence[str] = ("filing_accession", *GRAIN), sample: int = 10) -> DataFrame:
    """Grains whose candidates disagree on the value: the number of distinct
    values, the least and the greatest, and the first ``sample`` in order (cut
    per grain below the shuffle, never a whole grain in one cell)."""
    d = cands.select(*grain, "value").where(F.col("value").isNotNull()).distinct()
    n = d.groupBy(*grain).agg(F.count(F.lit(1)).alias("n_values"), F.min("value").alias("min_value"), F.max("value").alias("max_value")).where(F.col("n_values") > 1)
    first = top_k_per_group(d, list(grain), [F.col("value")], sample, rank_col="_r").groupBy(*grain).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("value")), lambda x: x.cast("string")), ",").alias("values"))
    return n.join(first, list(grain))


def unmapped_concepts(unmapped: DataFrame, sample: int = 25) -> DataFrame:
    """Per statement the number of distinct unmapped (concept, standard
    concept) pairs and the first ``sample`` of them in sorted order.  The
    sample is cut per group below the shuffle (WindowGroupLimit), never by
    collecting a whole group."""
    d = unmapped.select("statement", "concept", "standard_concept").distinct()
    n = d.groupBy("statement").agg(F.count(F.lit(1)).alias("unmapped_count"))
    top = top_k_per_group(d, ["statement"], [F.col("concept").asc_nulls_first(),
                                             F.col("standard_concept").asc_nulls_first()], sample, rank_col="_r")
    item = F.concat(F.col("concept"), F.lit("|"), F.coalesce(F.col("standard_concept"), F.lit("")))
    s = top.groupBy("statement").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", item.alias("v")))), lambda x: x["v"]),
                     ";").alias("sample"))
    return n.join(s, "statement")


def latest_periods(fact: DataFrame) -> DataFrame:
    """Per ticker the latest annual period (end, year) and latest quarterly
    period (end, quarter, year) in one aggregation."""
    ann = F.col("period_type") == "annual"
    qtr = F.col("period_type") == "quarterly"
    return fact.groupBy("ticker_id").agg(
        F.max(F.when(ann, F.col("fiscal_period_end"))).alias("latest_annual_end"),
        F.max_by(F.col("fiscal_year"), F.when(ann, F.col("fiscal_period_end"))).alias("latest_annual_year"),
        F.max(F.when(qtr, F.col("fiscal_period_end"))).alias("latest_quarter_end"),
        F.max_by(F.col("quarter"), F.when(qtr, F.col("fiscal_period_end"))).alias("latest_quarter"),
        F.max_by(F.col("fiscal_year"), F.when(qtr, F.col("fiscal_period_end"))).alias("latest_quarter_year"),
    )


RATIO_LINES = ("current_assets", "current_liabilities", "inventory", "total_liabilities", "stockholders_equity",
               "net_income", "total_assets", "revenue", "gross_profit", "operating_income", "cashflow_operating",
               "capex")


def ratios(fact: DataFrame) -> DataFrame:
    """Ratios per (ticker, period) from the canonical lines (division by
    zero or a missing line gives NULL)."""
    g = ["ticker_id", "fiscal_year", "fiscal_period_end", "period_type"]
    wide = fact.where(F.col("line_code").isin(*RATIO_LINES)).groupBy(*g).agg(
        *[F.max(F.when(F.col("line_code") == lc, F.col("value").cast("double"))).alias(lc) for lc in RATIO_LINES])

    def div(a, b):
        return F.round(F.try_divide(a, F.nullif(b, F.lit(0.0))), 6)

    c = F.col
    return wide.select(
        *g,
        div(c("current_assets"), c("current_liabilities")).alias("current_ratio"),
        div(c("current_assets") - c("inventory"), c("current_liabilities")).alias("quick_ratio"),
        div(c("total_liabilities"), c("stockholders_equity")).alias("debt_to_equity"),
        div(c("net_income"), c("total_assets")).alias("return_on_assets"),
        div(c("net_income"), c("stockholders_equity")).alias("return_on_equity"),
        div(c("gross_profit"), c("revenue")).alias("gross_margin"),
        div(c("operating_income"), c("revenue")).alias("operating_margin"),
        div(c("net_income"), c("revenue")).alias("net_margin"),
        (c("cashflow_operating") - c("capex")).alias("free_cash_flow"),
    )


def facts_by_term(fact: DataFrame, lines: DataFrame, term: str) -> DataFrame:
    """Facts whose line has ``term`` among its synonyms (case-blind)."""
    hit = lines.where(F.array_contains(F.col("synonyms"), F.lower(F.lit(term)))).select(
        "line_code", "display_name", F.col("statement").alias("line_statement"))
    return fact.join(F.broadcast(hit), "line_code")


def statement_frames(wide: DataFrame) -> Mapping[str, DataFrame]:
    """Split a wide table holding several statements into one frame each."""
    return {s: wide.where(F.col("statement") == s).drop("statement") for s in STATEMENT_ORDER}


def financial_facts(wide: DataFrame, gaap: DataFrame, overrides: DataFrame | None = None,
                    is_annual: str = "is_annual") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates of all three statements (U1) -> merged facts.
    Returns (merged, candidates, unmapped)."""
    if "statement" in wide.columns:
        # one pass over all statements: the statement is a column, not a frame
        allc, unm = statement_candidates(wide, None, F.col(is_annual), gaap, overrides)
        return merge_facts(allc), allc, unm
    cands, unms = [], []
    for stmt, frame in statement_frames(wide).items():
        c, u = statement_candidates(frame, stmt, F.col(is_annual), gaap, overrides)
        cands.append(c)
        unms.append(u)
    allc = union_statements(*cands)
    return merge_facts(allc), allc, union_statements(*unms)


def latest_column_date(df: DataFrame) -> dt.date:
    """The latest date among a frame's column names (schema metadata,
    read on the driver); an error when no column name is a date."""
    dates = [parse_period_name(c) for c in df.columns if c.strip().lower() not in schemas.STATEMENT_METADATA_COLUMNS]
    dates = [d for d in dates if d is not None]
    if not dates:
        raise ValueError("no date-named column in the frame")
    return max(dates)
