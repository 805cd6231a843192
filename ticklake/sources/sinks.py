"""Keyed writes expressed as DataFrame plans: upsert, insert-ignore, partial
update, strict insert, seeding and deletes with foreign-key rules.

No table format with MERGE is assumed: each function returns the new table
state as a DataFrame, and ``write_version`` / ``write_snapshot`` publish it as a
new versioned parquet directory that readers see once it is complete, so a
failed job never leaves a half-written table.

An upsert is one full outer join on the key: target and batch are each read and
shuffled once.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import first_by, latest_by


def dedupe_batch(source: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None,
                 winner: str = "last") -> DataFrame:
    """One row per key inside a batch: the last (or first) row by ``order``."""
    if not order:
        return source.dropDuplicates(list(keys))
    ordc = [F.col(o) if isinstance(o, str) else o for o in order]
    if winner == "last":
        return latest_by(source, list(keys), ordc, [c for c in source.columns if c not in keys])
    return first_by(source, list(keys), ordc, [c for c in source.columns if c not in keys])


def _batch_rows(source: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None, winner: str,
                wanted: Sequence[str]) -> DataFrame:
    """``dedupe_batch`` for the columns that a table has.  Where the order and
    these columns can be compared, a row is sent once, as one struct that begins
    with its order, and not as a payload and an order that repeat each other."""
    names = [c for c in source.columns if c in wanted or c in keys]
    if not order:
        return dedupe_batch(source, keys, order, winner).select(*names)
    rest = [c for c in names if c not in keys and c not in order]
    types = dict(source.dtypes)
    if not all(isinstance(o, str) and "`" not in o and o not in keys for o in order) or any(
            t in types[c] for c in [*order, *rest] for t in ("map<", "variant", "interval")):
        return dedupe_batch(source, keys, order, winner).select(*names)
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *rest])])
    best = source.groupBy(*keys).agg((F.max if winner == "last" else F.min)(row).alias("_w"))
    return best.select(*[F.col(c) if c in keys else F.col("_w")[c].alias(c) for c in names])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
           order: Sequence[str | Column] | None = None, winner: str = "last",
           touch_col: str | None = None, now=None) -> DataFrame:
    """S9 (+S14): INSERT .. ON CONFLICT (keys) DO UPDATE SET update_cols.

    Within the batch the last row by ``order`` wins (``winner='first'`` keeps the
    first, i.e. the oldest filing when the batch is ordered newest first).  On a
    conflict only ``update_cols`` take the batch value; other columns keep the
    stored value.  New keys are inserted with all batch columns.  ``touch_col``
    is set to ``now`` on updated and inserted rows.
    """
    keys = list(keys)
    tschema = target.schema
    types = {f.name: f.dataType for f in tschema.fields}
    cols = [f.name for f in tschema.fields]
    update_cols = list(update_cols) if update_cols is not None else [c for c in cols if c not in keys]
    src = _batch_rows(source, keys, order, winner, cols)
    src_cols = set(src.columns)
    # one full outer join: each side is read and shuffled once
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in src.columns], F.lit(True).alias("_given"))
    t = target.withColumn("_stored", F.lit(True))
    match = functools.reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    j = t.join(s, match, "full")
    stored, given = F.col("_stored").isNotNull(), F.col("_given").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.when(stored, F.col(c)).otherwise(F.col(f"_s_{c}").cast(types[c])).alias(c))
        elif touch_col and c == touch_col:
            out.append(F.when(given, F.lit(now).cast(types[c])).otherwise(F.col(c)).alias(c))
        elif c not in src_cols:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(given, F.col(f"_s_{c}").cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(stored, F.col(c)).otherwise(F.col(f"_s_{c}").cast(types[c])).alias(c))
    return j.select(*out)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column] | None = None) -> DataFrame:
    """INSERT .. ON CONFLICT DO NOTHING; inside the batch the first row wins."""
    keys = list(keys)
    src = _batch_rows(source, keys, order, "first", target.columns)
    new = src.join(target.select(*keys), keys, "left_anti")
    tfields = target.schema.fields
    new_cols = set(new.columns)
    return target.unionByName(new.select(*[
        (F.col(f.name) if f.name in new_cols else F.lit(None)).cast(f.dataType).alias(f.name) for f in tfields]))


def update_columns(target: DataFrame, source: DataFrame, key: str | Sequence[str], cols: Sequence[str],
                   keep_on_null: bool = True, touch_col: str | None = None, now=None) -> DataFrame:
    """S12 (+S14): UPDATE target SET cols = source.cols WHERE key matches.

    ``keep_on_null=True`` keeps the stored value where the source value is NULL
    (protects NOT NULL columns such as a ticker's name); ``False`` overwrites
    with NULL exactly like the source system.  The source must be unique on key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    s = source.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols]).withColumn("_hit", F.lit(True))
    j = target.join(s, keys, "left")
    out = []
    types = {f.name: f.dataType for f in target.schema.fields}
    for c in types:
        if c in cols:
            new = F.coalesce(F.col(f"_u_{c}"), F.col(c)) if keep_on_null else F.col(f"_u_{c}")
            out.append(F.when(F.col("_hit"), new.cast(types[c])).otherwise(F.col(c)).alias(c))
        elif touch_col and c == touch_col:
            out.append(F.when(F.col("_hit"), F.lit(now).cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


class DuplicateKeyError(ValueError):
    pass


def insert_unique(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Strict insert; a key already stored or repeated in the batch raises."""
    keys = list(keys)
    dup_batch = source.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    clash = source.join(target.select(*keys), keys, "left_semi").limit(1).count()
    if dup_batch or clash:
        raise DuplicateKeyError(f"duplicate key on {keys}")
    return target.unionByName(source.select(*target.columns))


def seed(existing: DataFrame, seed_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert seed rows whose key is absent (re-running is a no-op)."""
    return insert_ignore(existing, seed_rows, keys)


class RestrictViolation(ValueError):
    pass


def delete_with_rules(parent: DataFrame, pk: str, delete_keys: DataFrame,
                      children: Mapping[str, tuple[DataFrame, str, str]]) -> dict[str, DataFrame]:
    """Delete parent rows and apply each child's FK rule.

    ``children`` maps a name to (child_df, fk_column, rule) with rule in
    CASCADE | RESTRICT | SET NULL.  RESTRICT raises when a deleted parent is
    still referenced.  Returns the new state of the parent and every child.
    """
    gone = delete_keys.select(F.col(pk).alias("_gone")).distinct()
    out = {"parent": parent.join(gone, F.col(pk) == F.col("_gone"), "left_anti")}
    for name, (child, fk, rule) in children.items():
        rule = rule.upper()
        hit = F.col(fk) == F.col("_gone")
        if rule == "RESTRICT":
            if child.join(gone, hit, "left_semi").limit(1).count():
                raise RestrictViolation(f"{name}.{fk} still references deleted rows")
            out[name] = child
        elif rule == "CASCADE":
            out[name] = child.join(gone, hit, "left_anti")
        elif rule == "SET NULL":
            j = child.join(gone.withColumn("_hit", F.lit(True)), hit, "left")
            out[name] = j.select(*[
                F.when(F.col("_hit"), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
                if f.name == fk else F.col(f.name) for f in child.schema.fields])
        else:
            raise ValueError(rule)
    return out


def _versions(spark: SparkSession, table_dir: str) -> list[tuple[int, str]]:
    """Number and path of every completely written version, oldest first.

    A version is complete when its writer's ``_SUCCESS`` file is there.  Only a
    table folder that does not exist, or holds no complete version yet, gives an
    empty list; any other trouble with the folder raises."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_dir.rstrip("/"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            out.append((int(name[2:]), f"{table_dir.rstrip('/')}/{name}"))
    return sorted(out)


def write_version(df: DataFrame, table_dir: str, number: int, partition_by: Sequence[str] = ()) -> str:
    """Write version ``number`` of a table, anew if it is there already.  Readers
    see it only when it is complete; there is no pointer that could be lost."""
    version = f"{table_dir.rstrip('/')}/v={number:010d}"
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(version)
    return version


def write_snapshot(df: DataFrame, table_dir: str, partition_by: Sequence[str] = ()) -> str:
    """Publish ``df`` as the version after the newest; a failed write leaves
    the old one current."""
    done = _versions(df.sparkSession, table_dir)
    return write_version(df, table_dir, done[-1][0] + 1 if done else 0, partition_by)


def read_below(spark: SparkSession, table_dir: str, number: int) -> DataFrame | None:
    """The newest complete version with a number below ``number``, if any."""
    done = [path for n, path in _versions(spark, table_dir) if n < number]
    return spark.read.parquet(done[-1]) if done else None


def read_current(spark: SparkSession, table_dir: str) -> DataFrame:
    """The newest complete version."""
    done = _versions(spark, table_dir)
    if not done:
        raise FileNotFoundError(f"no complete version in {table_dir}")
    return spark.read.parquet(done[-1][1])


def written_before(spark: SparkSession, table_dir: str, number: int | None = None) -> DataFrame | None:
    """The rows of all complete versions (with a number below ``number``)
    together, for tables whose versions are increments."""
    done = [path for n, path in _versions(spark, table_dir) if number is None or n < number]
    return spark.read.parquet(*done) if done else None
