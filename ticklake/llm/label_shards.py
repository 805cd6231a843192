"""Sharding by balanced label propagation; the law is ``bytes``.

Documents with equal texts are linked.  Each starts in a shard given by a hash
of its id.  In every round the documents of a group (equal texts) ask to move to
the shard with most of the group's bytes among those that have room for the whole
group, which cuts fewer links.  A group that has room in no shard fills several:
its shards are taken from the fullest of it down until their room holds it, and
its units (the group's part of one shard, cut where it is large) in other shards
are laid along that room, each within one shard.

A shard takes what fits under its quota (an even share of all bytes): the bytes
that ask for it are summed by priority class, a hash that is new in every round,
and classes are let in while the running sum fits.  Nothing asks for a shard that
has no room for it, so nothing too large closes a shard to others.

At the end the shards are evened out: every shard keeps documents up to its even
share, linked ones first, and releases the rest; released documents fill the
gaps of the others in one running order.  Sizes then differ from the even share
by about one document.

All rounds are joins and sums over (group, shard), and over a bounded number of
hash classes; only ids, sizes and hashes are shuffled, never texts.  Running sums
over documents are made in two steps: sums by class, then within a class, so no
task holds a shard.

Defined results: null texts have no bytes (size 1, CRC 0) and equal empty texts.
Repeated rows are documents of their own; a null id is hashed as such.  An empty
table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import reliable, tasks

SHARDS, ROUNDS, CLASSES = 16, 5, 1024
PARTS = 32  # a unit above this part of a shard is cut


def linked(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, group and the shard to start with."""
    raw = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    return reliable(docs.select(
        docs[id_col].alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.md5(raw).alias("group"), F.pmod(F.xxhash64(docs[id_col]), F.lit(shards)).cast("int").alias("shard")))


def pieced(nodes: DataFrame, share: float, parts: int = PARTS) -> DataFrame:
    """``nodes`` with ``piece``, a hash that cuts the large units."""
    most = share / parts
    large = reliable(nodes.groupBy("group", "shard").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > most)
                     .select("group", "shard", F.ceil(F.col("bytes") / F.lit(most)).alias("pieces")))  # at most shards * parts rows
    return (nodes.join(F.broadcast(large), ["group", "shard"], "left")
            .withColumn("piece", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.coalesce("pieces", F.lit(1))).cast("int")).drop("pieces"))


def propagate(nodes: DataFrame, share: float, rounds: int = ROUNDS, classes: int = CLASSES) -> DataFrame:
    """Where each unit (group, first shard and piece) of a group of two or more
    ends: group, origin, piece, shard, bytes, n."""
    several = nodes.groupBy("group", "shard", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = several.groupBy("group").agg(F.sum("n").alias("all")).where("all > 1").select("group")
    units = reliable(several.join(groups, "group").select("group", F.col("shard").alias("origin"), "piece", "shard", "bytes", "n"))
    group = Window.partitionBy("group")  # at most a row a shard, or a unit
    for turn in range(rounds):
        # a row a shard, with the quota that is left
        room = units.groupBy("shard").agg(F.greatest(F.lit(float(share)) - F.sum("bytes"), F.lit(0.0)).alias("room"))
        tie = F.xxhash64("group", "shard")  # of equal shards one given by a hash
        first = group.orderBy(F.desc("bytes"), F.desc(tie)).rowsBetween(Window.unboundedPreceding, -1)
        here = (units.groupBy("group", "shard").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("unit")).join(F.broadcast(room), "shard")
                .withColumn("room", F.when(F.col("room") >= F.max("unit").over(group), F.col("room")).otherwise(F.lit(0.0)))  # room for any of its units
                .withColumn("all", F.sum("bytes").over(group)).withColumn("holds", F.col("bytes") + F.col("room"))
                .withColumn("before", F.coalesce(F.sum("holds").over(first), F.lit(0.0))).withColumn("low", F.coalesce(F.sum("room").over(first), F.lit(0.0))))
        fits = F.col("holds") >= F.col("all")
        taken = F.struct("shard", "low", (F.col("low") + F.col("room")).alias("high"))
        goals = here.groupBy("group").agg(F.max(fits).alias("fits"), F.max_by("shard", F.struct(fits, "bytes", tie)).alias("best"),
                                          F.collect_list(F.when(F.col("before") < F.col("all"), taken)).alias("goals"))
        mark = F.xxhash64("group", "origin", "piece", F.lit(turn))
        ahead = group.orderBy(mark, "origin", "piece").rowsBetween(Window.unboundedPreceding, -1)
        outside = ~F.exists("goals", lambda g: g["shard"] == F.col("shard"))
        asked = units.join(goals, "group").withColumn("at", F.coalesce(F.sum(F.when(outside, F.col("bytes"))).over(ahead), F.lit(0)))
        place = F.get(F.filter("goals", lambda g: (g["low"] <= F.col("at")) & (F.col("at") + F.col("bytes") <= g["high"])), 0)["shard"]
        wish = F.when(F.col("fits"), F.col("best")).when(outside, F.coalesce(place, F.col("shard"))).otherwise(F.col("shard"))
        asked = reliable(asked.withColumn("wish", wish).withColumn(
            "class", F.pmod(F.when(F.col("fits"), F.xxhash64("group", F.lit(turn))).otherwise(mark), F.lit(classes))).drop("fits", "best", "goals", "at"))
        if not asked.where("wish <> shard").limit(1).count():
            break
        queue = Window.partitionBy("wish").orderBy("class")  # at most ``classes`` rows a shard
        let_in = (asked.where("wish <> shard").groupBy("wish", "class").agg(F.sum("bytes").alias("asked"))
                  .withColumn("running", F.sum("asked").over(queue)).join(F.broadcast(room.withColumnRenamed("shard", "wish")), "wish")
                  .where(F.col("running") <= F.col("room")).select("wish", "class", F.lit(True).alias("ok")))
        units = reliable(asked.join(let_in, ["wish", "class"], "left").select(
            "group", "origin", "piece", F.when(F.col("ok"), F.col("wish")).otherwise(F.col("shard")).alias("shard"), "bytes", "n"))
    return units


def _running(rows: DataFrame, keys: list[str], order: Column, classes: int, what: Column) -> DataFrame:
    """``before``: the sum of ``what`` over the rows of the same keys that come
    first in the order of (``order``, hash of the id); in two steps."""
    rows = rows.withColumn("class", order * classes + F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(classes)))
    lead = Window.partitionBy(*keys).orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*keys, "class").agg(F.sum(what).alias("in_class"))
              .select(*keys, "class", F.coalesce(F.sum("in_class").over(lead), F.lit(0)).alias("start")))
    inner = (Window.partitionBy(*keys, "class").orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id", "text_crc32")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("within", F.sum(what).over(inner)).join(starts, [*keys, "class"])
            .withColumn("before", F.col("start") + F.col("within") - what).drop("class", "within", "start"))


def even_out(rows: DataFrame, shards: int, classes: int) -> DataFrame:
    """Release what is above the even share and fill the gaps with it.  ``rows``
    has doc_id, size, text_crc32, single, shard."""
    placed = reliable(_running(rows, ["shard"], F.col("single").cast("long"), classes, F.col("size")))
    total = placed.agg(F.sum("size")).first()[0] or 0
    share = total / shards
    stays = F.col("before") + F.col("size") / 2 <= share
    held = {r["shard"]: r["held"] for r in placed.where(stays).groupBy("shard").agg(F.sum("size").alias("held")).collect()}  # a row a shard
    gaps = [max(0.0, share - held.get(s, 0)) for s in range(shards)]
    freed = _running(placed.where(~stays).drop("before").withColumn("all", F.lit(0)), ["all"], F.lit(0).cast("long"), classes, F.col("size"))
    scale = sum(gaps) / max(1.0, float(total - sum(held.values())))
    at = (F.col("before") + F.col("size") / 2) * scale
    target, upto = F.lit(shards - 1), sum(gaps)
    for s in reversed(range(shards)):
        target = F.when(at < upto, s).otherwise(target) if gaps[s] > 0 else target
        upto -= gaps[s]
    filled = freed.select("doc_id", "size", "text_crc32", target.cast("int").alias("shard"))
    return placed.where(stays).select("doc_id", "size", "text_crc32", "shard").unionByName(filled)


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                    rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    classes = max(CLASSES, 4 * tasks(docs.sparkSession))
    nodes = linked(docs, id_col, text_col, shards)
    share = (nodes.agg(F.sum("size")).first()[0] or 0) / shards
    nodes = pieced(nodes, share)
    units = propagate(nodes, share, rounds).select("group", F.col("origin").alias("shard"), "piece", F.col("shard").alias("to"))
    rows = nodes.join(units, ["group", "shard", "piece"], "left").select(
        "doc_id", "size", "text_crc32", F.col("to").isNull().alias("single"), F.coalesce("to", "shard").alias("shard"))
    even = reliable(even_out(rows, shards, classes))
    slots = _running(even, ["shard"], F.lit(0).cast("long"), classes, F.lit(1).cast("long"))
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("before").cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))
