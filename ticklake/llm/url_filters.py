"""URL filters: a sort-merge range join of urls with prefix rules.

A rule ``host/path`` fits its host and all subdomains when the url's path
starts with the rule's path.  Both sides get a canonical key: the host's labels
in reverse order, each ended by ``?`` (a character that neither host nor path
can hold), then the path: ``com?example?/en/``.  A rule is then the interval of
all keys that start with its key, and any two rules are nested or disjoint.

A url has one key for each ancestor of its host (up to the deepest rule's
depth); the rules that hold such a key are the rules on that host that fit.
Each sweep sorts interval bounds and url keys together.  A bound carries the
stack of rules that are active from there on (an interval's start pushes its
rule, its end pops it), so the last bound at or before a url key tells the
active nested rules, innermost on top.  The longest rule over all ancestors
wins; of equal ones that with the longer host.

Distinct (host, path) pairs are spread over the sweeps by hash, so a hot host
is no hot task; the bounds (two a rule) go to every sweep.

Defined results: a url that is null or has no ``://`` has an empty host and an
empty path and no rule; a host may be empty for other urls too (``http:///x``)
and then no rule fits.  Two rules with the same host and path: ``block`` wins.
Null rules are ignored.  Repeated pages give repeated rows; columns other than
id and url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, tasks

#: (verdict, rule) of the registered query.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, rule string")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url as columns; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "?"), F.lit("?"), path)


def _bounds(rules: DataFrame) -> DataFrame:
    """Interval bounds in key order with the stack active from there on."""
    split = rules.where("rule is not null and verdict is not null").select(
        "verdict", "rule",
        lower_ascii(F.substring_index("rule", "/", 1)).alias("r_host"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("r_path"),
    ).where("r_host <> ''")
    one = split.groupBy("r_host", "r_path").agg(F.max_by(F.struct("verdict", "rule"), F.struct("verdict", "rule")).alias("r"))
    keyed = one.select(_key(_labels(F.col("r_host")), F.col("r_path")).alias("key"),
                       F.struct(F.length("r_path").alias("path_len"), F.length("r_host").alias("host_len"),
                                F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict")).alias("entry"))
    # the rules around a rule: those whose key is a prefix of its key
    inner = keyed.select(F.col("key").alias("inner_key"),
                         F.explode(F.expr("transform(sequence(1, length(key)), n -> substring(key, 1, n))")).alias("key"))
    stacks = inner.join(keyed, "key").groupBy("inner_key").agg(F.array_sort(F.collect_list("entry")).alias("stack"))
    start = stacks.select(F.col("inner_key").cast("binary").alias("key"), "stack")
    end = stacks.select(F.concat(F.col("inner_key").cast("binary"), F.unhex(F.lit("FF"))).alias("key"),
                        F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    return start.unionByName(end)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", sweeps: int | None = None) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every row of ``pages``;
    ``default`` is the verdict where no rule fits."""
    sweeps = sweeps or 2 * tasks(pages.sparkSession)
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    bounds = _bounds(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(sweeps - 1))).alias("sweep"), "key", F.lit(0).alias("kind"),
        F.struct("stack").alias("active"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))
    # no rule reaches deeper or further than these two numbers
    deep, far = rules.agg(F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\."))), F.max(F.length("rule"))).first()
    labels = _labels(F.col("host"))
    probes = urls.where("host <> ''").groupBy("host", "path").agg(F.lit(1)).select("host", "path").select(
        F.pmod(F.xxhash64("host", "path"), F.lit(sweeps)).cast("int").alias("sweep"), "host", "path",
        F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, deep or 1))))).alias("depth"),
    ).select(
        "sweep", _key(F.slice(labels, F.lit(1), F.col("depth")), F.substring("path", 1, max(1, far or 1))).cast("binary").alias("key"),
        F.lit(1).alias("kind"), F.lit(None).cast(bounds.schema["active"].dataType).alias("active"), "host", "path")
    sweep = Window.partitionBy("sweep").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = bounds.unionByName(probes).withColumn("now", F.last("active", ignorenulls=True).over(sweep))
    top = swept.where("kind = 1 and size(now.stack) > 0").select("host", "path", F.element_at("now.stack", -1).alias("top"))
    best = top.groupBy("host", "path").agg(
        F.max_by("top", F.struct(F.col("top.path_len") + F.col("top.host_len"), F.col("top.host_len"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _sql() -> str:
    values = ", ".join(f"('{v}', '{r}')" for v, r in RULES)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path FROM cut
), urls AS (
  SELECT page_id, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(path, '') AS path FROM parts
), rules AS (
  SELECT v AS verdict, r AS rule, split_part(r, '/', 1) AS r_host, substr(r, strpos(r, '/')) AS r_path FROM (VALUES {values}) t(v, r)
)
SELECT u.page_id, u.host, u.path,
       (SELECT max_by(rule, length(rule)) FROM rules WHERE (u.host = r_host OR ends_with(u.host, '.' || r_host)) AND starts_with(u.path, r_path)) AS rule,
       coalesce((SELECT max_by(verdict, length(rule)) FROM rules WHERE (u.host = r_host OR ends_with(u.host, '.' || r_host)) AND starts_with(u.path, r_path)), 'allow') AS verdict
FROM urls u
"""


SQL = _sql()
