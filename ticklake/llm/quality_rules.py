"""Quality rules: base rules on each text, and cross-document line frequency.

*Base rules* look at one text: too few words, or too many words in repeated
3-word windows.

*Line frequency*: lines are normalised (A-Z lower-cased, white space collapsed)
and hashed; for every host and line the distinct documents that hold the line
are counted.  Copies of a text are one document here, so copies alone never
make a line frequent.  A line held by at least ``min_docs`` documents of a host
is boilerplate and is removed, however large the host is, so that a template on
a minority of a host's pages counts too; a document is rejected as depleted if
less than ``min_left`` of its words are left.  ``max_share`` above 0 asks for that
share of the host's documents as well.

One pass over the texts makes a short row for each document (counts, and a hash
and word count for each distinct line); all shuffles move hashes only.  Counts
are aggregated before each shuffle, so a line or host that holds a third of all
rows is one row a task.  The short rows are checkpointed, because they are read
three times and carry a generated row id.

Defined results: null texts have no words, and fail as too short.  Rows without
a host form one host.  Repeated rows are kept, each with its result; a text
without frequent lines is never depleted.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reliable

MIN_WORDS, REPEAT_PERCENT = 50, 50
MIN_DOCS, MAX_SHARE, MIN_LEFT = 50, 0.0, 0.2
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1}
        reach = 0  # words before this one are counted
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def line_rows(text: str | None) -> list[dict]:
    """Hash and number of words (over all places) of each distinct line."""
    out: dict[bytes, int] = {}
    for line in (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b"\n"):
        words = line.split()
        if words:
            key = b" ".join(words)
            out[key] = out.get(key, 0) + len(words)
    return [{"line": int.from_bytes(hashlib.blake2b(k, digest_size=8).digest(), "little", signed=True), "words": n} for k, n in out.items()]


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("host", pa.string()), ("body", pa.binary()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))),
])
_DDL = ("doc_id long, host string, body binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "lines array<struct<line:long,words:long>>")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for value in batch.column(2):
            text = value.as_py()
            body = hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()
            for column, x in zip(columns, (body, *base_counts(text), line_rows(text)), strict=True):
                column.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1), *(pa.array(c, f.type) for c, f in zip(columns, list(_SCHEMA)[2:], strict=True))], schema=_SCHEMA)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS,
            max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """Base counts, removed lines and words, and the verdict of every row."""
    return _judged(docs, id_col, text_col, host_col, min_docs, max_share, min_left).drop("row")


def rejected_rows(docs: DataFrame, row_col: str, text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS,
                  max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """The ids (``row_col``) of the rows that the rules reject."""
    judged = _judged(docs, row_col, text_col, host_col, min_docs, max_share, min_left)
    return judged.where("not kept").select(F.col("doc_id").alias(row_col))


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, max_share: float, min_left: float) -> DataFrame:
    host = F.coalesce(F.concat(F.lit("="), docs[host_col].cast("string")), F.lit(""))
    read = docs.select(docs[id_col].alias("doc_id"), host.alias("host"), docs[text_col].alias("text")).mapInArrow(_read, _DDL)
    rows = reliable(read.withColumn("row", F.monotonically_increasing_id()))
    lines = rows.select("row", "host", "body", F.explode("lines").alias("l")).select("row", "host", "body", "l.line", "l.words")
    held = lines.select("host", "line", "body").distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    if max_share > 0:
        hosts = rows.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
        held = held.join(hosts, "host").where(F.col("n_docs") > max_share * F.col("host_docs"))
    frequent = held.select("host", "line")
    removed = lines.join(frequent, ["host", "line"]).groupBy("row").agg(F.count("*").alias("n_removed_lines"), F.sum("words").alias("n_removed_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = rows.drop("lines", "body").join(removed, "row", "left").na.fill(0, ["n_removed_lines", "n_removed_words"])
    depleted = (F.col("n_removed_words") > 0) & (F.col("n_words") - F.col("n_removed_words") < min_left * F.col("n_words"))
    return out.select("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                      (~failed & ~depleted).alias("kept"), "n_removed_lines", "n_removed_words")


_WORD = r"[^\x20\x09-\x0D]+"
SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, doc_id, host, text, regexp_extract_all(text, '{_WORD}') AS w FROM base
), tri AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE n > 1) GROUP BY r
), line AS (
  SELECT r, host, text, l, lower_words, len(regexp_extract_all(l, '{_WORD}')) AS n
  FROM (SELECT r, host, text, l, translate(array_to_string(regexp_extract_all(l, '{_WORD}'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_words
        FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS l FROM base))
  WHERE lower_words <> ''
), dup AS (
  SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM line GROUP BY r
), held AS (
  SELECT host, lower_words, count(DISTINCT text) AS n_docs FROM line GROUP BY ALL
), hosts AS (
  SELECT host, count(DISTINCT text) AS host_docs FROM base GROUP BY host
), gone AS (
  SELECT r, count(DISTINCT lower_words) AS n_removed_lines, sum(n) AS n_removed_words
  FROM line JOIN held USING (host, lower_words) JOIN hosts USING (host) WHERE n_docs >= {MIN_DOCS} AND n_docs > {MAX_SHARE} * host_docs GROUP BY r
), counts AS (
  SELECT words.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(n_removed_words, 0) AS n_removed_words
  FROM words LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_removed_words > 0 AND n_words - n_removed_words < {MIN_LEFT} * n_words) AS kept,
       n_removed_lines::BIGINT AS n_removed_lines, n_removed_words::BIGINT AS n_removed_words
FROM (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AS base_failed FROM counts)
"""
