"""Filing text operators: attachment choice, MD&A sections, markdown, chunks.

Markdown looks at a paragraph and the one before it; the chunk buffer is a fold
over a document's sentences.  Both work in the task that has the document.  A
document of more than ``LONG_TEXT`` characters is cut into segments that several
tasks work on: for the buffer, segments are summarised as state tables, which
compose to every segment's start.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.coerce import strip
from ..functions.text import WS, clean_filing_text, extract_title, html_unescape, sentences, squash, words
from .common import first_by

ColLike = str | Column


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Which text of a filing
# ---------------------------------------------------------------------------
def pick_attachment(attachments: DataFrame, key: str = "filing_id") -> DataFrame:
    """Per filing the first attachment whose document type contains
    'EX-99', else the first attachment (by ordinal)."""
    order = [F.struct((~F.coalesce(F.col("document_type").contains("EX-99"), F.lit(False))).alias("not_ex99"),
                      F.col("ordinal").alias("ordinal"))]
    return first_by(attachments, [key], order, ["ordinal", "document_type", "text"])


def normalize_item_key(c: ColLike) -> Column:
    return F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]", "")


def mdna_sections(filings: DataFrame, items: DataFrame, rules: DataFrame,
                  form_col: str = "type", id_col: str = "id") -> DataFrame:
    """MD&A sections of 10-K (Item 7, 7A) and 10-Q (Item 2) filings.

    For each section of the filing's form, the content of the first candidate
    key (in rule order) that the filing has with non-empty content; sections
    without content are dropped, other forms give nothing.  The rule table is
    fixed and broadcast."""
    r = rules.select("form", "section_id", "section_title", F.posexplode("candidates").alias("cand_pos", "cand"))
    r = r.withColumn("cand_norm", normalize_item_key("cand")).drop("cand")
    f = filings.select(F.col(id_col).alias("filing_id"), F.col(form_col).alias("form"))
    fr = f.join(F.broadcast(r), "form")
    it = items.where(F.col("content").isNotNull() & (F.col("content") != "")).select(
        "filing_id", normalize_item_key("item_key").alias("cand_norm"), "content")
    hit = fr.join(it, ["filing_id", "cand_norm"])
    return hit.groupBy("filing_id", "form", "section_id", "section_title").agg(
        F.min_by("content", "cand_pos").alias("content"))


# ---------------------------------------------------------------------------
# Text -> markdown
# ---------------------------------------------------------------------------
_NS = f"[^{WS}]"
_S = f"[{WS}]"
# FIXED VALUES: patterns that tell table rows, numbered and bullet lists
# one character each before and after the gaps, and no way back: a long word is read once, not once for each of its characters
TABLE_ROW = rf"(?d)(\|.*\|)|({_NS}{_S}{{2,}}+{_NS}++{_S}{{2,}}+{_NS})"
NUMBERED = rf"^{_S}*\d+\.{_S}"
BULLET = rf"^{_S}*[•\-\*]{_S}"


def _pipe_count(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit("|"), F.lit("")))


def _separator(row: Column) -> Column:
    n = _pipe_count(row) - 1
    return F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n), " | "), F.lit(" |"))


def _format_paragraph(p: Column, pc: Column) -> Column:
    """A non-table paragraph: numbered list, bullet list or text with heading
    rules.  ``pc`` is the paragraph with whitespace collapsed and punctuation
    spaced, computed once per paragraph by the caller."""
    lines = F.split(p, "\n")
    numbered = F.array_join(F.transform(lines, lambda x: strip(x)), "\n")
    bullets = F.array_join(F.transform(lines, lambda x: strip(F.regexp_replace(x, rf"^{_S}*[•\-\*]{_S}*", "- "))), "\n")
    is_upper = (F.upper(pc) == pc) & (F.lower(pc) != pc)
    heading = (
        F.when(is_upper, F.concat(F.lit("## "), pc))
        .when((F.length(pc) < 80) & pc.endswith(":"), F.concat(F.lit("### "), pc))
        .when(pc.rlike(rf"^[A-Z][a-z]+{_S}+\p{{Nd}}+(\.|:)"), F.concat(F.lit("### "), pc))
        .otherwise(pc)
    )
    return F.when(p.rlike(NUMBERED), numbered).when(p.rlike(BULLET), bullets).otherwise(heading)


def _spaced(p: Column) -> Column:
    pc = strip(F.regexp_replace(p, f"{_S}+", " "))
    return F.regexp_replace(pc, rf"([.,!?:;])([^{WS}\p{{Nd}}])", "$1 $2")


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is read."""
    return F.get(F.transform(F.array(value), body), 0)


def _paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, rf"\n{_S}*\n", -1), lambda x: strip(x)), lambda x: x != "")


def _markdown_pieces(paras: Column, after_row: Column) -> Column:
    """The paragraphs as markdown, each with the line ends before it.

    A paragraph needs to know only whether it and the one before it
    (``after_row`` for the first) are table rows, so nothing is carried along.
    Lambda bodies run without common-subexpression elimination; each paragraph's
    values are computed once in a first pass and only read after."""
    first = F.transform(paras, lambda p: F.struct(p.alias("p"), p.rlike(TABLE_ROW).alias("t")))
    second = F.transform(first, lambda x: F.struct(
        x["p"].alias("p"), x["t"].alias("t"),
        F.when(~x["t"], _spaced(x["p"])).alias("pc")))
    items = F.transform(second, lambda x: F.struct(
        x["t"].alias("t"),
        F.when(x["t"], F.when(x["p"].contains("|"), x["p"]).otherwise(
            F.concat(F.lit("| "), F.array_join(F.split(x["p"], f"{_S}{{2,}}", -1), " | "), F.lit(" |")))).alias("row"),
        F.when(~x["t"], _format_paragraph(x["p"], x["pc"])).alias("fmt"),
    ))

    def piece(x, before):
        head = F.concat(F.lit("\n\n"), x["row"], F.lit("\n"), _separator(x["row"]))
        return (F.when(x["t"] & before, F.concat(F.lit("\n"), x["row"])).when(x["t"], head)
                .otherwise(F.concat(F.lit("\n\n"), x["fmt"])))

    def joined(a):
        before = F.slice(F.concat(F.array(after_row), F.transform(a, lambda x: x["t"])), F.lit(1), F.size(a))
        return F.array_join(F.zip_with(a, before, piece), "")

    return _once(items, joined)


def _markdown_source(c: ColLike) -> Column:
    return _paragraphs(html_unescape(F.coalesce(_c(c), F.lit(""))))


def to_markdown(c: ColLike) -> Column:
    """Filing text -> markdown.

    Paragraphs (split at blank lines) are classified; consecutive table-like
    paragraphs form one table whose first row gets a separator row; other
    paragraphs become lists or text with heading rules."""
    return F.substring(_markdown_pieces(_markdown_source(c), F.lit(False)), 3, 2**31 - 1)


#: texts of more characters are worked on by several tasks
LONG_TEXT = 1 << 20
#: paragraphs, or sentences, that such a text gives to a task at a time
SEGMENT = 4096


def _segments(df: DataFrame, keep: list[str], parts: Column, segment: int) -> DataFrame:
    """(row, keep, seg, parts, before): the parts of each row in segments that
    are dealt over all tasks; ``before`` is the part before a segment."""
    from ..session import cut_lineage

    held = df.select(F.struct(*keep).alias("keep"), parts.alias("all"), F.monotonically_increasing_id().alias("row"))
    cuts = F.sequence(F.lit(0), F.floor(F.greatest(F.size("all") - 1, F.lit(0)) / F.lit(segment)).cast("int"))
    cuts = F.transform(cuts, lambda i: F.struct(i.alias("seg"), F.slice("all", i * segment + 1, F.lit(segment)).alias("parts"),
                                                                 F.when(i > 0, F.get("all", i * segment - 1)).alias("before")))
    return cut_lineage(held.select("row", "keep", F.inline(cuts)).repartition("row", "seg"))


def markdown_rows(df: DataFrame, keep: list[str], text: Column, size: Column | None = None, long_text: int = LONG_TEXT,
                  segment: int = SEGMENT) -> DataFrame:
    """T3 as rows: ``keep`` columns + markdown.  A text whose ``size`` (by default
    its length) passes ``long_text`` is split into segments of paragraphs that
    several tasks format; the others stay in their row."""
    big = F.coalesce(F.length(text) if size is None else size, F.lit(0)) > long_text
    short = df.where(~big).select(*keep, to_markdown(text).alias("markdown"))
    segs = _segments(df.where(big), keep, _markdown_source(text), segment)
    done = segs.select("row", "seg", F.when(F.col("seg") == 0, F.col("keep")).alias("keep"),
                       _markdown_pieces(F.col("parts"), F.coalesce(F.col("before").rlike(TABLE_ROW), F.lit(False))).alias("piece"))
    whole = done.groupBy("row").agg(F.max("keep").alias("keep"), F.array_sort(F.collect_list(F.struct("seg", "piece"))).alias("pieces"))
    return short.unionByName(whole.select("keep.*", F.substring(F.array_join("pieces.piece", ""), 3, 2**31 - 1).alias("markdown")))


# ---------------------------------------------------------------------------
# Sentence-aware chunks
# ---------------------------------------------------------------------------
def chunk_bounds(lengths: Column, n: int, overlap: int | None = None) -> Column:
    """Fold over sentence token counts -> array<struct<s,e>> token ranges.

    A sentence that would overflow a non-empty buffer closes the chunk; the
    next buffer starts with the last ``overlap`` tokens; a long sentence is
    never split."""
    ov = int(n * 0.1) if overlap is None else overlap
    init = F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"),
                    F.array().cast("array<struct<s:int,e:int>>").alias("b"))

    def step(acc, ln):
        emit = ((acc["e"] - acc["s"] + ln) > n) & (acc["e"] > acc["s"])
        nb = F.when(emit, F.concat(acc["b"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))).otherwise(acc["b"])
        ns = F.when(emit, F.greatest(acc["e"] - ov, acc["s"]) if ov > 0 else acc["e"]).otherwise(acc["s"])
        return F.struct(ns.alias("s"), (acc["e"] + ln).alias("e"), nb.alias("b"))

    def finish(acc):
        return F.when(acc["e"] > acc["s"], F.concat(acc["b"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))) \
            .otherwise(acc["b"])

    return F.aggregate(lengths, init, step, finish)


def chunk_texts(c: ColLike, n: int = 500, overlap: int | None = None) -> Column:
    """T6 as a column: array of chunk texts (token = whitespace word; sentences
    per T5; chunk text = its tokens joined by one space)."""
    sents = sentences(squash(_c(c)))
    lens = F.transform(sents, lambda s: F.size(F.split(s, f"{_S}+")))
    toks = words(F.array_join(sents, " "))
    bounds = chunk_bounds(lens, n, overlap)
    return F.transform(bounds, lambda b: F.array_join(F.slice(toks, b["s"] + 1, b["e"] - b["s"]), " "))


def _folded(n: int, ov: int):
    """Sentence counts -> token ranges, from a buffer that holds [s, e) already."""
    def fold(lengths, s=0, e=0):
        out = []
        for ln in lengths:
            if e - s + ln > n and e > s:
                out.append((s, e))
                s = max(e - ov, s) if ov > 0 else e
            e += ln
        return out, s, e
    return fold


def _cutter(names: list[str], n: int, ov: int, held_chars: int = 1 << 20):
    """Batches whose last column holds sentences -> batches of chunks."""
    fold = _folded(n, ov)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sents, rows, numbers, texts, held = batch.column(batch.num_columns - 1), [], [], [], 0

            def chunks(batch=batch):
                at = pa.array(rows, pa.int64())
                columns = [c.take(at) for c in batch.columns[:-1]]
                return pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int32()), pa.array(texts, pa.string())], names=names)

            # one text at a time as Python strings; what is cut leaves when it is held_chars long
            for i in range(batch.num_rows):
                sentences_of = sents[i].as_py()
                bounds, s, e = fold([x.count(" ") + 1 for x in sentences_of])
                tokens = " ".join(sentences_of).split(" ")
                for number, (a, b) in enumerate(bounds + [(s, e)] * (e > s), 1):
                    rows.append(i)
                    numbers.append(number)
                    texts.append(" ".join(tokens[a:b]))
                    held += len(texts[-1])
                if held > held_chars:
                    yield chunks()
                    rows, numbers, texts, held = [], [], [], 0
            yield chunks()

    return run


def _short_chunks(df: DataFrame, keep: list[str], sents: Column, n: int, ov: int) -> DataFrame:
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField("chunk_number", T.IntegerType()), T.StructField("chunk", T.StringType())])
    return df.select(*keep, sents.alias("_sents")).mapInArrow(_cutter(schema.names, n, ov), schema)


def _long_chunks(segs: DataFrame, keep_names: list[str], n: int, ov: int) -> DataFrame:
    """Chunks of long texts.

    What a segment does depends only on the number of tokens in the buffer before
    it, and from n + 1 on not on how many: so each segment is summarised as a
    table from 0 .. n + 1 tokens before to tokens after and chunks closed.  The
    tables of a text are run through in order, which hands every segment its
    start; segments then close their chunks, and cut the texts of chunks (which
    may reach into other segments) out of their own tokens."""
    fold = _folded(n, ov)

    def summary(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            tokens, after, closed = [], [], []
            for parts in batch.column(2).to_pylist():
                held, made = np.arange(n + 2), np.zeros(n + 2, np.int64)
                for ln in (x.count(" ") + 1 for x in parts):
                    close = (held + ln > n) & (held > 0)
                    held = np.where(close, np.minimum(held, ov), held) + ln
                    made += close
                tokens.append(sum(x.count(" ") + 1 for x in parts))
                after.append(held.tolist())
                closed.append(made.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(after, pa.list_(pa.int64())),
                                              pa.array(closed, pa.list_(pa.int64()))], names=["row", "seg", "tokens", "after", "closed"])

    def starts(table: pa.Table) -> pa.Table:
        import pyarrow as pa

        rows = table.sort_by("seg").to_pylist()
        token, held, chunk, out = 0, 0, 0, []
        for i, r in enumerate(rows):
            out.append((r["row"], r["seg"], token, held, chunk, i == len(rows) - 1))
            state = min(held, n + 1)
            token, held, chunk = token + r["tokens"], r["after"][state], chunk + r["closed"][state]
        kinds = [("row", pa.int64()), ("seg", pa.int32()), ("token", pa.int64()), ("held", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_())]
        return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), kinds, strict=True)], [k for k, _ in kinds])

    def close(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                bounds, s, e = fold([x.count(" ") + 1 for x in r["parts"]], r["token"] - r["held"], r["token"])
                if r["last"] and e > s:
                    bounds.append((s, e))
                out += [(r["row"], r["chunk"] + i, a, b) for i, (a, b) in enumerate(bounds, 1)]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "chunk_number", "s", "e"])

    def cut(segments: pa.Table, wanted: pa.Table) -> pa.Table:
        import pyarrow as pa

        out = []
        for r in segments.to_pylist():
            tokens, begin = " ".join(r["parts"]).split(" "), r["token"]
            for w in wanted.to_pylist():
                out.append((w["row"], w["chunk_number"], r["seg"], " ".join(tokens[max(0, w["s"] - begin):w["e"] - begin])))
        kinds = [("row", pa.int64()), ("chunk_number", pa.int64()), ("seg", pa.int32()), ("piece", pa.string())]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], [k for k, _ in kinds])

    tables = segs.select("row", "seg", "parts").mapInArrow(summary, "row long, seg int, tokens long, after array<long>, closed array<long>")
    begun = tables.groupBy("row").applyInArrow(starts, "row long, seg int, token long, held long, chunk long, last boolean")
    started = segs.select("row", "seg", "parts").join(begun, ["row", "seg"])
    bounds = started.mapInArrow(close, "row long, chunk_number long, s long, e long")
    firsts = begun.groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    reach = F.sequence(F.size(F.filter("tokens", lambda x: x <= F.col("s"))) - 1, F.size(F.filter("tokens", lambda x: x < F.col("e"))) - 1)
    wanted = bounds.join(firsts, "row").select("row", "chunk_number", "s", "e", F.explode(reach).alias("seg"))
    pieces = started.select("row", "seg", "parts", "token").groupBy("row", "seg").cogroup(wanted.groupBy("row", "seg")).applyInArrow(
        cut, "row long, chunk_number long, seg int, piece string")
    chunks = pieces.groupBy("row", "chunk_number").agg(F.array_sort(F.collect_list(F.struct("seg", "piece"))).alias("p"))
    return segs.where("seg = 0").select("row", "keep").join(chunks, "row").select(
        *[F.col(f"keep.`{c}`").alias(c) for c in keep_names], F.col("chunk_number").cast("int").alias("chunk_number"), F.array_join("p.piece", " ").alias("chunk"))


def chunk_rows(df: DataFrame, keep: list[str], text: Column, n: int = 500, overlap: int | None = None, size: Column | None = None,
               long_text: int = LONG_TEXT, segment: int = SEGMENT) -> DataFrame:
    """T6 as rows: ``keep`` columns + (chunk_number, chunk).

    Sentences are split in the JVM and folded in the task that has the text.  A
    text whose ``size`` (by default its length; callers that clean the text give
    the raw length, so that nothing is cleaned twice) passes ``long_text`` is
    folded by several tasks instead."""
    ov = int(n * 0.1) if overlap is None else overlap
    big = F.coalesce(F.length(text) if size is None else size, F.lit(0)) > long_text
    sents = sentences(squash(text))
    segs = _segments(df.where(big), keep, sents, segment).where(F.size("parts") > 0)
    return _short_chunks(df.where(~big), keep, sents, n, ov).unionByName(_long_chunks(segs, keep, n, ov))


def chunk(df: DataFrame, id_col: str, text_col: str, n: int = 500, overlap: int | None = None, clean: bool = False) -> DataFrame:
    """One row per chunk: (id, chunk_number from 1, chunk); ``clean`` cleans
    the text first (T1)."""
    text = clean_filing_text(F.col(text_col)) if clean else F.col(text_col)
    return chunk_rows(df, [id_col], text, n, overlap, size=F.length(text_col))


# ---------------------------------------------------------------------------
# Statement chunk rows
# ---------------------------------------------------------------------------
def statement_chunks(texts: DataFrame, id_col: str = "filing_id", text_col: str = "text", kind: str = "8-K",
                     section_col: str | None = None, title_col: str | None = None, n: int = 500) -> DataFrame:
    """Rows of the ``statements`` table for press releases (kind '8-K') or
    MD&A sections (kind 'MDNA', with section id / title columns).

    8-K: title from the cleaned text, word count of the cleaned chunk; MD&A:
    the section title, word count of the raw chunk."""
    cleaned = clean_filing_text(F.col(text_col))
    if kind == "8-K":
        title = extract_title(cleaned)
        label = F.lit("8-K PR")
    else:
        title = F.col(title_col)
        label = F.col(section_col)
    base = texts.select(F.col(id_col).alias("filingId"), label.alias("_label"), title.alias("title"), F.col(text_col).alias("_text"))
    ex = chunk_rows(base, ["filingId", "_label", "title"], clean_filing_text(F.col("_text")), n, size=F.length("_text")).withColumnRenamed(
        "chunk", "raw_content")
    content = clean_filing_text(F.col("raw_content"))
    wc = F.size(words(content)) if kind == "8-K" else F.size(words(F.col("raw_content")))
    return ex.select(
        "filingId",
        F.concat(F.col("_label"), F.lit("_chunk_"), F.col("chunk_number").cast("string")).alias("section"),
        "title",
        content.alias("content"),
        "raw_content",
        to_markdown(F.col("raw_content")).alias("markdown_content"),
        wc.alias("word_count"),
        "chunk_number",
    )
