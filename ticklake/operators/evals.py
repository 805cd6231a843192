"""Evaluation runs, judgements and query traces (analytic views of the warehouse)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

JUDGES = ("factual_grounding", "completeness", "consistency")


def _avg6(c):
    return F.round(F.avg(c).cast("double"), 6)


def run_summary(runs: DataFrame, pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """A1 (+J3): per run, distinct pairs, 9 judge averages, latencies, confidence.

    The two left joins repeat a pair once per judgement row, so the latency and
    confidence averages and the row sum are weighted by judgement count, exactly
    as in the source view.  ``AVG(..)::INTEGER`` rounds half away from zero.
    """
    run_cols = [c for c in runs.columns]
    p = pairs.select(
        F.col("id").alias("_pair_id"), F.col("evaluation_run_id").alias("_run_id"),
        "control_avg_latency_ms", "experimental_avg_latency_ms",
        "experimental_confidence_score", "total_rows_retrieved",
    )
    s = scores.select(
        F.col("evaluation_pair_id").alias("_spair"), "judge_type",
        "control_score", "experimental_score", "improvement_delta",
    )
    j = runs.join(p, runs["id"] == p["_run_id"], "left").join(s, F.col("_pair_id") == F.col("_spair"), "left")
    aggs = [F.count_distinct("_pair_id").alias("completed_pairs")]
    for jt in JUDGES:
        hit = F.col("judge_type") == jt
        aggs += [
            _avg6(F.when(hit, F.col("control_score"))).alias(f"avg_control_{jt}"),
            _avg6(F.when(hit, F.col("experimental_score"))).alias(f"avg_experimental_{jt}"),
            _avg6(F.when(hit, F.col("improvement_delta"))).alias(f"avg_improvement_{jt}"),
        ]
    aggs += [
        F.round(F.avg("control_avg_latency_ms")).cast("int").alias("avg_control_latency_ms"),
        F.round(F.avg("experimental_avg_latency_ms")).cast("int").alias("avg_experimental_latency_ms"),
        _avg6(F.col("experimental_confidence_score")).alias("avg_experimental_confidence"),
        F.sum("total_rows_retrieved").alias("total_rows_retrieved"),
    ]
    return j.groupBy(*[runs[c] for c in run_cols]).agg(*aggs)


def pair_details(runs: DataFrame, pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per pair with the three judges side by side.

    The source joins the score table three times with the judge type in the ON
    clause; (pair, judge_type) is unique, so one aggregation that pivots the
    three judges gives the same rows with one shuffle instead of three.
    """
    prefix = {"factual_grounding": "fg", "completeness": "completeness", "consistency": "consistency"}
    piv = []
    for jt in JUDGES:
        hit = F.col("judge_type") == jt
        p = prefix[jt]
        piv += [
            F.max(F.when(hit, F.col("control_score"))).alias(f"{p}_control_score"),
            F.max(F.when(hit, F.col("experimental_score"))).alias(f"{p}_experimental_score"),
            F.max(F.when(hit, F.col("improvement_delta"))).alias(f"{p}_improvement"),
        ]
        if jt == "consistency":  # the judge that measures entropy
            piv += [F.max(F.when(hit, F.col(c))).alias(c) for c in ("semantic_entropy_control", "semantic_entropy_experimental") if c in scores.columns]
    wide = scores.where(F.col("judge_type").isin(*JUDGES)).groupBy(
        F.col("evaluation_pair_id").alias("id")).agg(*piv)
    r = runs.select(F.col("id").alias("evaluation_run_id"), "run_name")
    base = pairs.join(r, "evaluation_run_id")
    keep = [c for c in ("id", "evaluation_run_id", "run_name", "question_id", "question_text", "company_ticker",
                        "experimental_trace_id", "experimental_confidence_score", "total_rows_retrieved",
                        "created_at") if c in base.columns]
    return base.select(*keep).join(wide, "id", "left")


def hallucination_rate(runs: DataFrame, pairs: DataFrame, scores: DataFrame,
                       threshold: float = 0.6) -> DataFrame:
    """A3: per run and group, share of all pairs whose factual-grounding score is
    below ``threshold``; 0 for a run without pairs; rounded to 4 decimals."""
    total = pairs.groupBy(F.col("evaluation_run_id").alias("run_id")).agg(F.count(F.lit(1)).alias("_n"))
    fg = scores.where(F.col("judge_type") == "factual_grounding")
    p = pairs.select(F.col("id").alias("evaluation_pair_id"), F.col("evaluation_run_id").alias("run_id"))
    low = (
        p.join(fg, "evaluation_pair_id")
        .groupBy("run_id")
        .agg(
            F.count_if(F.col("control_score") < F.lit(threshold)).alias("_control"),
            F.count_if(F.col("experimental_score") < F.lit(threshold)).alias("_experimental"),
        )
    )
    base = runs.select(F.col("id").alias("run_id")).join(total, "run_id", "left").join(low, "run_id", "left")
    rows = []
    for g in ("control", "experimental"):
        rate = F.when(F.coalesce(F.col("_n"), F.lit(0)) == 0, F.lit(0.0)).otherwise(
            F.round(F.coalesce(F.col(f"_{g}"), F.lit(0)) / F.col("_n"), 4))
        rows.append(base.select("run_id", F.lit(g).alias("group_name"), rate.cast("double").alias("hallucination_rate")))
    return rows[0].unionByName(rows[1])


def success_rates(attempts: DataFrame) -> DataFrame:
    """A2: per query type: total, successful (no error), success %, avg time."""
    ok = F.count_if(F.col("error_message").isNull())
    n = F.count(F.lit(1))
    return attempts.groupBy("query_type").agg(
        n.alias("total_attempts"),
        ok.alias("successful_attempts"),
        F.round(ok * F.lit(100.0) / F.nullif(n, F.lit(0)), 2).cast("double").alias("success_rate_percent"),
        F.round(F.avg("execution_time_ms"), 6).alias("avg_execution_time_ms"),
    )


def attempts_view(attempts: DataFrame, kind: str) -> DataFrame:
    """P20: attempts of one type, ``query_text`` renamed ``<kind>_query``."""
    cols = []
    for c in attempts.columns:
        if c == "query_type":
            continue
        if c == "query_text":
            cols.append(F.col(c).alias(f"{kind}_query"))
        elif kind == "sql" and c == "source_indexes" or kind == "vector" and c == "source_tables":
            continue
        else:
            cols.append(F.col(c))
    return attempts.where(F.col("query_type") == kind).select(*cols)


def trace_tree(spark: SparkSession, traces: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Root id and depth of every trace reachable from a root.

    Pointer doubling: every trace points to an ancestor and knows how far up it
    is; a round replaces the pointer by that ancestor's pointer and adds the
    distances, so a tree of depth n takes about log2(n) equi-joins.  Each round
    is cut with a reliable checkpoint.  Traces whose parent is missing drop out;
    a round in which no trace reaches a root leaves only cycles, which drop out
    too.  ``id`` is the key of ``traces``.
    """
    state = cut_lineage(traces.select(
        "id", F.coalesce("parent_trace_id", "id").alias("up"), F.when(F.col("parent_trace_id").isNull(), 0).otherwise(1).alias("depth"),
        F.col("parent_trace_id").isNull().alias("done")))
    left = state.where("not done").count()
    while left:
        far = state.select(F.col("id").alias("up"), F.col("up").alias("far"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        moved = state.where("not done").join(far, "up").select("id", F.col("far").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        state = cut_lineage(state.where("done").unionByName(moved))
        before, left = left, state.where("not done").count()
        if left == before:
            break
    out = state.where("done").select("id", F.col("up").alias("root_id"), "depth")
    return out if max_depth is None else out.where(F.col("depth") <= max_depth)
