"""Text operators: literal expectations and a property test of the chunk fold."""
import random
import re

from pyspark.sql import functions as F

from ticklake.functions import text as TX
from ticklake.operators import text as TO


def one(spark, fn, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


def test_clean_filing_text(spark):
    out = one(spark, TX.clean_filing_text, "<p>Hello <b>world</b></p>")
    assert "<" not in out and out == "Hello world"
    assert one(spark, TX.clean_filing_text, "Café   crème! #1") == "Café crème! 1"


def test_extract_title(spark):
    assert one(spark, TX.extract_title, "FOR IMMEDIATE RELEASE\n\nApple announces new product line today") == \
        "Apple announces new product line today"
    assert one(spark, TX.extract_title, "short") == "Press Release"
    assert one(spark, TX.extract_title, "A" * 250) == "A" * 200


def test_markdown(spark):
    assert one(spark, TO.to_markdown, "OVERVIEW\n\nSome text here.") == "## OVERVIEW\n\nSome text here."
    md = one(spark, TO.to_markdown, "| a | b |\n| 1 | 2 |")
    assert "| --- |" in md
    md = one(spark, TO.to_markdown, "1. first\n2. second\n\n- x\n* y\n\nSection 1: intro")
    assert md == "1. first\n2. second\n\n- x\n- y\n\n### Section 1: intro"
    assert one(spark, TO.to_markdown, "a &amp; b &#65;&#x42;") == "a & b AB"


def test_sentences(spark):
    s = one(spark, TX.sentences, "One two. Three four! five six. Seven?")
    assert list(s) == ["One two.", "Three four! five six.", "Seven?"]


def _reference_chunks(text, n):
    """Plain buffer loop (token = word, sentences per the regex rule)."""
    overlap = int(n * 0.1)
    sents = [x.strip() for x in re.split(r"(?<=[.!?])\s+(?=[A-Z])", " ".join(text.split())) if x.strip()]
    chunks, buf = [], []
    for s in sents:
        toks = s.split()
        if len(buf) + len(toks) > n and buf:
            chunks.append(" ".join(buf))
            buf = buf[-overlap:] if overlap > 0 else []
        buf.extend(toks)
    if buf:
        chunks.append(" ".join(buf))
    return chunks


def test_chunk_fold_matches_buffer_loop(spark):
    rnd = random.Random(3)
    docs = []
    for i in range(60):
        sents = []
        for _ in range(rnd.randint(0, 40)):
            w = [rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rnd.randint(1, 30))]
            sents.append(w[0].capitalize() + " " + " ".join(w[1:]) + rnd.choice([".", "!", "?"]))
        docs.append((i, " ".join(sents)))
    df = spark.createDataFrame(docs, "id int, text string")
    for n in (10, 50):
        got = {}
        for r in TO.chunk(df, "id", "text", n=n).collect():
            got.setdefault(r.id, []).append((r.chunk_number, r.chunk))
        for i, text in docs:
            want = _reference_chunks(text, n)
            have = [c for _, c in sorted(got.get(i, []))]
            assert have == want, (n, i)


def test_chunk_bounds_example(spark):
    df = spark.createDataFrame([([3, 4, 5, 2],)], "l array<int>")
    b = df.select(TO.chunk_bounds(F.col("l"), 8, 1).alias("b")).first()["b"]
    assert [(x["s"], x["e"]) for x in b] == [(0, 7), (6, 14)]
    assert one(spark, lambda c: F.size(TO.chunk_texts(c, 50)), "") == 0


def test_pick_attachment(spark):
    df = spark.createDataFrame([(1, 1, "8-K", "cover"), (1, 2, "EX-99.1", "release"), (2, 1, "8-K", "only")],
                               "filing_id int, ordinal int, document_type string, text string")
    got = {r.filing_id: r.text for r in TO.pick_attachment(df).collect()}
    assert got == {1: "release", 2: "only"}


def test_mdna_sections(spark):
    from ticklake import schemas
    filings = spark.createDataFrame([(1, "10-K"), (2, "10-Q"), (3, "8-K")], "id int, type string")
    items = spark.createDataFrame([(1, "Item 7", "mdna"), (1, "ITEM 7A", "risk"), (2, "part_i_item_2", "q"),
                                   (3, "Item 7", "x")], "filing_id int, item_key string, content string")
    out = {(r.filing_id, r.section_id): r.content
           for r in TO.mdna_sections(filings, items, schemas.mdna_rules_df(spark)).collect()}
    assert out == {(1, "Item 7"): "mdna", (1, "Item 7A"): "risk", (2, "Item 2"): "q"}


def test_character_references(spark):
    from ticklake.functions.text import html_unescape
    cases = {"&#9999999;": "\ufffd", "&#38;lt;": "&lt;", "&#150;": "\u2013", "&#xD800;": "\ufffd", "&eacute;&auml;": "éä", "&amp;lt; &lt;b&gt;": "&lt; <b>",
             "&#0;": "\ufffd", "&#99999999999999999999;": "\ufffd", "&#x1F600;": "😀", "&#233;": "é", "&unknown; & &amp &;": "&unknown; & &amp &;",
             "&NotEqualTilde;": "\u2242\u0338", "&#x110000;&#x10FFFF;": "\ufffd\U0010ffff", "&#000065;": "A", "&bsol;&apos;&NewLine;": "\\'\n", "": "", "plain": "plain"}
    df = spark.createDataFrame(list(cases.items()), "s string, want string")
    for r in df.select("s", "want", html_unescape("s").alias("got")).collect():
        assert r.got == r.want, r
    assert spark.sql("SELECT CAST(NULL AS STRING) s").select(html_unescape("s").alias("x")).first().x is None


def _made_text(rnd, sentences):
    return " ".join(" ".join(["Alpha", *(rnd.choice(["beta", "gamma"]) for _ in range(rnd.choice([1, 3, 9, 60])))]) + rnd.choice([".", "!"]) for _ in range(sentences))


def test_long_texts_in_segments(spark):
    rnd = random.Random(9)
    docs = [(i, _made_text(rnd, rnd.choice([0, 1, 2, 70, 500])), "k") for i in range(20)] + [(3, "Same id here.", "k"), (50, None, None)]
    df = spark.createDataFrame(docs, "id int, text string, row string")
    for n, overlap in ((10, None), (50, 0), (40, 39)):
        ov = int(n * .1) if overlap is None else overlap
        want = sorted((i, k, j, c) for i, t, k in docs for j, c in enumerate(_chunks_with(t or "", n, ov), 1))
        for segment in (1, 7, 64):
            got = TO.chunk_rows(df, ["id", "row"], F.col("text"), n, overlap, long_text=5, segment=segment).collect()
            assert sorted((r.id, r.row, r.chunk_number, r.chunk) for r in got) == want, (n, segment)


def _chunks_with(text, n, overlap):
    chunks, buf = [], []
    for s in [x for x in re.split(r"(?<=[.!?])\s+(?=[A-Z])", " ".join(text.split())) if x.strip()]:
        toks = s.split()
        if len(buf) + len(toks) > n and buf:
            chunks.append(" ".join(buf))
            buf = buf[-overlap:] if overlap > 0 else []
        buf.extend(toks)
    return chunks + [" ".join(buf)] if buf else chunks


def test_long_markdown_in_segments(spark):
    rnd = random.Random(4)
    paragraph = ["| a | b |", "x  y  z", "TITLE", "Plain text,here", "1. one\n 2. two", "- b", "Heading:", "&lt;p&gt; q"]
    docs = [(i, "\n\n".join(rnd.choice(paragraph) for _ in range(rnd.choice([0, 1, 5, 40])))) for i in range(25)] + [(99, None)]
    df = spark.createDataFrame(docs, "id int, text string")
    want = {r.id: r.m for r in df.select("id", TO.to_markdown("text").alias("m")).collect()}
    for segment in (1, 3, 1000):
        got = {r.id: r.markdown for r in TO.markdown_rows(df, ["id"], F.col("text"), long_text=3, segment=segment).collect()}
        assert got == want


def test_table_rows_in_linear_time(spark):
    import itertools
    import time

    from ticklake.operators.text import _NS, _S, TABLE_ROW
    plain = rf"(?d)(\|.*\|)|({_NS}+{_S}{{2,}}{_NS}+{_S}{{2,}}{_NS}+)"
    texts = ["".join(x) for n in range(8) for x in itertools.product("a \u2003|\n"[:4], repeat=n)]
    texts += ["a  b  c", "a\t\nb \u3000\U0001F600\U0001F600  c", "|\n|", "|a\r|", "  a  b  ", "a  b c  d", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~F.col("t").rlike(TABLE_ROW).eqNullSafe(F.col("t").rlike(plain))).count() == 0
    t0 = time.time()
    long_word = spark.range(1).select(F.repeat(F.concat(F.lit("x"), F.col("id").cast("string")), 200_000).alias("t"))
    assert long_word.select(F.col("t").rlike(TABLE_ROW)).first()[0] is False
    assert time.time() - t0 < 30


def test_chunks_leave_before_a_batch_is_done():
    import pyarrow as pa

    ids, sents = list(range(300)), [[f"W{i} x{j}." for j in range(i % 40)] for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sents, pa.list_(pa.string()))], names=["id", "_sents"])
    names = ["id", "chunk_number", "chunk"]
    whole, parts = (list(TO._cutter(names, 9, 2, held)([batch])) for held in (1 << 30, 200))
    assert pa.Table.from_batches(parts) == pa.Table.from_batches(whole) and whole[0].num_rows > 1000
    assert max(b.num_rows for b in parts) < 100
