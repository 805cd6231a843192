"""Data-quality checks taken from the warehouse constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Q1: violations per rule in one pass.

    ``rules`` maps a rule name to a SQL boolean expression (a CHECK constraint).
    As in SQL, a rule that evaluates to NULL passes.  Output: (rule, violations).
    """
    names = list(rules)
    agg = df.agg(*[F.count_if(~F.expr(rules[n])).alias(f"r{i}") for i, n in enumerate(names)])
    stack = ", ".join(f"'{n}', r{i}" for i, n in enumerate(names))
    return agg.selectExpr(f"stack({len(names)}, {stack}) AS (rule, violations)")


#: FIXED VALUES: the constraints of the warehouse's tables (rules, and the columns that are unique together)
CONSTRAINTS: dict[str, tuple[dict[str, str], list[str]]] = {
    "process_run_state": ({
        "ticker_present": "ticker_id IS NOT NULL",
        "process_name_domain": "process_name IN ('stocks', 'financials', 'press_releases', 'insider_transactions')",
        "process_status_domain": "status IN ('idle', 'running', 'success', 'failed')",
        "attempts_present": "attempts IS NOT NULL",
    }, ["ticker_id", "process_name"]),
    "financial_fact": ({
        "fiscal_year_present": "fiscal_year IS NOT NULL",
        "period_end_present": "fiscal_period_end IS NOT NULL",
        "period_type_domain": "period_type IN ('annual', 'quarterly')",
        "quarter_range": "quarter IS NULL OR quarter BETWEEN 1 AND 4",
        "value_present": "value IS NOT NULL",
        "source_concept_present": "source_concept IS NOT NULL",
    }, ["ticker_id", "fiscal_year", "fiscal_period_end", "period_type", "line_code"]),
    "human_annotations": ({
        "preferred_response_domain": "preferred_response IN ('control', 'experimental', 'tie', 'both_poor')",
        "factual_accuracy_range": "factual_accuracy_rating >= 1 AND factual_accuracy_rating <= 5",
        "relevance_range": "relevance_rating >= 1 AND relevance_rating <= 5",
        "completeness_range": "completeness_rating >= 1 AND completeness_rating <= 5",
    }, ["evaluation_pair_id", "annotator_user_id"]),
}


def enforce(df: DataFrame, rules: Mapping[str, str], unique: Sequence[str] = ()) -> DataFrame:
    """Q1, Q2 and S13 inside the plan that writes: the rows of ``df``; a row that
    violates a rule, or a second row of a unique key, fails the job that computes
    them, so a bad batch is never published and nothing is computed twice."""
    if unique:
        keyed = df.groupBy(*unique).agg(F.count("*").alias("_n"), F.first(F.struct(*df.columns)).alias("_row"))
        whole = F.col("_n") == 1
        for k in unique:
            whole = whole | F.col(k).isNull()
        # rows with a NULL key part are exempt, and all of them stay
        exempt = df.where(" OR ".join(f"`{k}` IS NULL" for k in unique))
        keyed = keyed.where(F.assert_true(whole, F.lit(f"duplicate key on {list(unique)}")).isNull())
        df = keyed.where(" AND ".join(f"`{k}` IS NOT NULL" for k in unique)).select("_row.*").unionByName(exempt)
    for name, rule in rules.items():
        df = df.where(F.assert_true(F.coalesce(F.expr(rule), F.lit(True)), F.lit(f"rule {name} violated")).isNull())
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q2: key values held by more than one row (rows with a NULL key part are
    exempt, as for a UNIQUE constraint)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return (
        df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Q3: child rows whose non-NULL foreign key has no parent row."""
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.where(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("_pk"), "left_anti")


def check_mapping(gaap: DataFrame, lines: DataFrame) -> DataFrame:
    """Q4: mapping entries whose line code is not seeded with the same statement,
    and seeded lines with no mapping entry (side = 'map' | 'line')."""
    g = gaap.select("line_code", F.col("statement").alias("map_statement")).distinct()
    ln = lines.select("line_code", F.col("statement").alias("line_statement"))
    j = g.join(ln, "line_code", "full")
    return j.where(
        F.col("line_statement").isNull() | F.col("map_statement").isNull()
        | (F.col("line_statement") != F.col("map_statement"))
    ).select(
        "line_code", "map_statement", "line_statement",
        F.when(F.col("line_statement").isNull(), "map").when(F.col("map_statement").isNull(), "line")
        .otherwise("statement").alias("problem"),
    )
