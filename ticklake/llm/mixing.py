"""Mixing sources to target weights by entropy balancing.

Sources get weights 1, 2, 3, 1, ... in code point order (null last) and share
all words by weight.  A target stops at ``most`` times its source's size; the
excess is shared again by weight among the others (water filling).

Every document gets a rate, how often it is taken.  Among all rates whose
expected words meet the source's target and that stay within ``most``, entropy
balancing picks the one nearest to 1 in relative entropy.  Its solution is an
exponential tilt, ``rate = min(most, exp(t * size / scale))``, with one unknown
``t`` a source: the minimum of a convex dual, found by Newton's method.  A step
needs two sums over the source's documents; Spark makes these sums for all
sources at once from (source, size, number of documents), which is aggregated
once.  Steps that would leave the bracket known to hold ``t`` are halved into it,
and steps go on until every source is at its target.  ``AT_ONCE`` steps are one
plan: the aggregate and every step are partitioned by source, so a plan has one
shuffle and one stage, however many steps it holds.

Rates become whole copies: documents of one source and size share a rate, so
their number of copies is rounded cumulatively over the sizes of the source.
What is then missing to the target (at most about one long document) is made up
by copies of the largest sizes that fit, as far as the running sum of what they
can give stays below it, then by the largest that fit in the rest, and last by
one copy of the size nearest to what is left; all windows over one partitioning.
``gap`` is what remains.  Within a size, copies are dealt evenly; which documents
get the odd ones is decided by a hash of the id, so reruns agree.

Only ids, sources and sizes are shuffled.  A size that a third of all documents
share is split by hash before its documents are numbered.

Defined results: null and empty texts have size 0, take no words and have one
copy.  Null is a source of its own.  Repeated rows are documents of their own.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import reliable, tasks

MOST, CLOSE, AT_ONCE, FILLS = 3, 1e-9, 6, 4


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Weights and water-filled targets; one row a source in, one out."""
    # one row a source: these windows are as long as the list of sources
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    full = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_room = Window.orderBy(most * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    level = (weighted.withColumn("room", most * F.col("source_size"))
             .withColumn("total", F.sum("source_size").over(full)).withColumn("weights", F.sum("weight").over(full))
             .withColumn("level", (F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0)))
                         / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    first = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fits = level.withColumn("level", F.first(F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level")), ignorenulls=True).over(first))
    return fits.select("key", "source", "weight", "source_size", "squares",
                       F.least(F.col("room").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _newton(hist: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """One step for all sources; sources that are done stay."""
    z = F.col("size") / F.col("scale")
    tilt = F.exp(F.least(F.col("t") * z, F.lit(50.0)))
    words = F.col("n") * F.col("size") * F.least(tilt, F.lit(float(most)))
    slope = F.when(tilt < most, F.col("n") * F.col("size") * tilt * z).otherwise(0.0)
    kept = ("target", "scale", "t", "low", "high", "done")
    # merge joins keep the partitioning by source, so steps need no shuffle between them
    sums = hist.join(state.hint("merge"), "key").groupBy("key").agg(*[F.first(c).alias(c) for c in kept], F.sum(words).alias("words"), F.sum(slope).alias("slope"))
    low = F.when(F.col("words") < F.col("target"), F.greatest("low", "t")).otherwise(F.col("low"))
    high = F.when(F.col("words") > F.col("target"), F.least("high", "t")).otherwise(F.col("high"))
    # a Newton step for the logarithm of the words, which is nearly linear in t
    step = F.col("t") + F.log(F.try_divide("target", "words")) * F.try_divide("words", "slope")
    inside = (F.col("slope") > 0) & (F.col("words") > 0) & (step > F.col("low")) & (step < F.col("high"))
    halved = (F.when(F.col("low") < -1e299, 2 * F.col("high") - F.abs("high") - 1)
              .when(F.col("high") > 1e299, 2 * F.col("low") + F.abs("low") + 1).otherwise((F.col("low") + F.col("high")) / 2))
    # where no number is left between the two sides, t is as good as it gets
    done = F.col("done") | (F.abs(F.col("words") - F.col("target")) <= CLOSE * F.col("target")) | (F.col("high") - F.col("low") <= 1e-15 * F.abs("t"))
    moved = sums.withColumn("low", low).withColumn("high", high).withColumn("done", done)
    return moved.select("key", "target", "scale", F.when(F.col("done"), F.col("t")).when(inside, step).otherwise(halved).alias("t"), "low", "high", "done")


def tilts(hist: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """``t`` of each source by Newton steps on the dual; none where the target
    takes all documents ``most`` times."""
    state = goal.where((F.col("source_size") > 0) & (F.col("target") < most * F.col("source_size"))).select(
        "key", "target", (F.col("squares") / F.col("source_size")).alias("scale"), F.log(F.col("target") / F.col("source_size")).alias("t"),
        F.lit(-1e300).alias("low"), F.lit(1e300).alias("high"), F.lit(False).alias("done"))
    while True:
        for _ in range(AT_ONCE):
            state = _newton(hist, state, most)
        state = reliable(state)
        if state.where("not done").isEmpty():
            return state.select("key", "scale", "t")


def copies_by_size(hist: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """Whole numbers of copies for all documents of a source and size: key,
    size, n, copies, source_size, target, gap."""
    rated = hist.join(goal.select("key", "source_size", "target").hint("merge"), "key").join(tilts(hist, goal, most).hint("merge"), "key", "left")
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("t").isNull(), float(most)).otherwise(
        F.least(F.lit(float(most)), F.exp(F.col("t") * F.col("size") / F.col("scale"))))
    # windows as long as the list of different sizes of a source
    of_source = Window.partitionBy("key")
    up = of_source.orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    larger = of_source.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = rated.withColumn("rate", rate).withColumn("sum", F.sum(F.col("n") * F.col("rate")).over(up))
    whole = F.floor(F.col("sum") + 0.5) - F.floor(F.col("sum") - F.col("n") * F.col("rate") + 0.5)
    kept = summed.withColumn("copies", F.greatest(F.lit(0), F.least(whole, most * F.col("n"))).cast("long"))
    short = F.col("target") - F.sum(F.col("size") * F.col("copies")).over(of_source)
    spare = F.when(F.col("gap") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    for _ in range(FILLS):
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("gap"))
        given = F.coalesce(F.sum(F.when(fits, spare * F.col("size"))).over(larger), F.lit(0))
        many = F.greatest(F.lit(0), F.least(spare, F.floor((F.abs("gap") - F.col("given")) / F.col("size"))))
        kept = kept.withColumn("gap", short).withColumn("given", given).withColumn(
            "copies", F.col("copies") + F.when(fits, F.signum("gap").cast("long") * many).otherwise(0))
    # rounding up is nearer where more than half of a copy is missing
    near = (F.col("size") > 0) & (spare > 0) & (F.col("size") < 2 * F.abs("gap"))
    kept = kept.withColumn("gap", short).withColumn("pick", F.max(F.when(near, F.col("size"))).over(of_source))
    change = F.when(F.col("size") == F.col("pick"), F.signum("gap").cast("long")).otherwise(0)
    kept = kept.withColumn("copies", F.col("copies") + change).withColumn("gap", short)
    return kept.select("key", "size", "n", "copies", "source_size", "target", "gap")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST,
        row_col: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and gap (target less all
    words taken of the source) of every row; with ``row_col`` (a row id) also
    that as ``row``."""
    row = [docs[row_col].alias("row")] if row_col else []
    carried = ["row"] if row_col else []
    words = F.coalesce(F.regexp_count(docs[text_col], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    source = docs[source_col].cast("string")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    rows = reliable(docs.select(docs[id_col].alias("doc_id"), source.alias("source"), key.alias("key"), words.alias("size"), *row))
    hist = reliable(rows.groupBy("key", "size").agg(F.count("*").alias("n"), F.first("source").alias("source")))
    sources = hist.groupBy("key").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                      F.sum(F.col("size").cast("double") * F.col("size") * F.col("n")).alias("squares"))
    goal = reliable(targets(sources, most))
    planned = reliable(copies_by_size(hist.drop("source"), goal, most))

    # number the documents of a source and size, in parts so that none is long
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4 * tasks(docs.sparkSession)))
    parted = rows.drop("source").withColumn("part", part)
    lead = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (parted.groupBy("key", "size", "part").agg(F.count("*").alias("in_part"))
              .withColumn("start", F.coalesce(F.sum("in_part").over(lead), F.lit(0))).drop("in_part"))
    plan = starts.join(planned, ["key", "size"])
    numbered = parted.withColumn("in_part", F.row_number().over(Window.partitionBy("key", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")))
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("start") + F.col("in_part") <= F.col("copies") % F.col("n"), 1).otherwise(0)
    joined = numbered.join(plan, ["key", "size", "part"]).withColumn("copies", copies.cast("long"))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "gap", *carried)
