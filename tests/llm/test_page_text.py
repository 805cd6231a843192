import numpy as np

from ticklake.llm import page_text as P


def text_of(page):
    found = P.main_blocks(P.blocks(page))
    return None if found is None else "\n\n".join(found)


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- x --><div class="ad">Buy</div>
    <article class="post with-ads"><h1>A &amp; B &lt;b&gt; &eacute;&#233;&#x1F600;</h1><p>One <b>two</b>three<br>four
      five</p><div class="cookie-notice">We use</div><form>Mail <input></form><p>unclosed <b>bold<p>Next</p>
      <aside>Side</aside><section id="comments"><p>First!</p></section><figure><figcaption>Cap</figcaption></figure>tail</article>
    <footer>&copy; x</footer></body></html>"""
    assert text_of(page) == "A & B <b> éé😀\n\nOne twothree four five\n\nunclosed bold\n\nNext\n\nCap\n\ntail"


def test_main_where_there_is_no_article():
    assert text_of("<div id=nav>m</div><main><p>x</p><div class='share'>s</div></main><p>y</p>") == "x"
    assert text_of("<div class='post-content'><p>x</p></div><p>y</p>") == "x"
    assert text_of("<article><p>x</article><main>m</main>") == "x"
    assert text_of("<p>x</p>") is None


def test_attributes_are_whole_names():
    for inner in ('<a href="/the-hidden-valley">x</a>', '<p title="hidden costs">x</p>', '<a href="/view?id=search">x</a>', '<p data-hidden="false">x</p>',
                  "<p data-class='ad'>x</p>", '<p title="class=ad id=nav">x</p>', '<p data-style="display:none">x</p>', "<p class=a class=ad>x</p>",
                  "<p aria-hidden=false>x</p>", "<p title = hidden>x</p>"):
        assert text_of(f"<article>{inner}</article>") == "x", inner
    for inner in ("<p hidden>x</p>", "<p HIDDEN=''>x</p>", '<p a="b"hidden>x</p>', "<p aria-hidden = 'true'>x</p>", "<p style='display: none'>x</p>",
                  "<div class = ad>x</div>", "<div title='a > b' class='cookie-notice'>x</div>", "<div a=/ role=navigation>x</div>"):
        assert text_of(f"<article>{inner}y</article>") == "y", inner


def test_ids_of_headings_and_sections_are_no_marks():
    for inner in ('<section id="related-work">x</section>', '<h2 id="search-methods">x</h2>', '<p id="notice">x</p>', '<h2 id="comments">x</h2>',
                  '<div class="section" id="share-of-income">x</div>', '<dt id="term-banner">x</dt>', '<h2 class="section-header">x</h2>'):
        assert text_of(f"<article>{inner}</article>") == "x", inner
    for inner in ('<section id="comments">x</section>', '<p id="breadcrumbs">x</p>', '<div id="ad-1">x</div>', '<section class="related-posts">x</section>',
                  '<div id="sidebar-left">x</div>'):
        assert text_of(f"<article>{inner}y</article>") == "y", inner


def test_quotes_open_only_after_an_equals_sign():
    assert text_of("<article><p title=it's>One. It isn't two.</p><p>Three</p></article>") == "One. It isn't two.\n\nThree"
    assert text_of('<article><p a"b>x "q" y</p><p title = "a > b" c=\'d > e\'>z</p><p t="never closed>u</p></article>') == 'x "q" y\n\nz\n\nu'


def test_main_around_an_article_belongs_to_it():
    assert text_of("<main><h1>Head</h1><p>Lead.</p><article><p>x</p></article><nav>n</nav></main><p>y</p>") == "Head\n\nLead.\n\nx"
    assert text_of("<main>m</main><article>x</article><main>n<article>z</article>") == "x\n\nn\n\nz"


def test_deep_pages_take_linear_time():
    import time
    for page in ("<div>" * 30_000 + "</b>" * 30_000 + "x", "<article>" + "<b>" * 100_000 + "x", "<p a=\"b" * 30_000, "<p a='" * 30_000 + "x", "</div>" * 100_000):
        begun = time.process_time()
        P.blocks(page)
        assert time.process_time() - begun < 3


def test_broken_pages():
    assert text_of(None) is None and text_of("") is None
    assert text_of("<article>a<script>never closed") == "a"
    assert text_of("<article>a <!-- never closed") == "a"
    assert text_of("<article>1 < 2 and 3 > 2, <x") == "1 < 2 and 3 > 2,"
    assert text_of('<article><p title="a > b">x</p><p a="open>y</p></article>') is not None
    assert text_of("<article>" + "<div>" * 3000 + "deep") == "deep"


def test_suffixes_repeated_in_two_pages():
    a, b, c = np.arange(1, 21, dtype=np.uint64), np.arange(5, 15, dtype=np.uint64), np.array([7, 8, 9, 99, 98, 7, 8, 9], np.uint64)
    got = P.repeated_windows([a, b, c], np.array([1, 2, 3]), np.array([1, 2, 3]), 8)
    assert np.flatnonzero(got[0]).tolist() == [4, 5, 6] and got[1].all() and not got[2].any()
    got = P.repeated_windows([a, b, c], np.array([1, 2, 3]), np.array([1, 2, 3]), 3)
    assert np.flatnonzero(got[2]).tolist() == [0, 5]
    assert not any(g.any() for g in P.repeated_windows([a, b], np.array([4, 4]), np.array([4, 4]), 5))


def rows_of(df):
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in P.extract(df).collect()}


def test_host_boilerplate_goes_from_open_pages(spark):
    plate = " ".join(f"boiler{i}" for i in range(30))
    own = {i: " ".join(f"own{i}x{j}" for j in range(20)) for i in range(4)}
    page = "<html><body><div>{}</div><p>{}</p></body></html>"
    rows = [(i, f"http://a.com/{i}", page.format(plate, own[i])) for i in range(2)]
    rows += [(2, "http://b.com/2", page.format(plate, own[2]))]  # another host
    rows += [(3, "http://c.com/3", page.format(plate, own[3])), (4, "http://c.com/4", page.format(plate, own[3]))]  # copies of a page
    rows += [(5, "http://a.com/5", f"<article>{plate}</article>")]
    got = rows_of(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got[0][0] == own[0] and got[1][0] == own[1]
    assert got[2][0] == plate + "\n\n" + own[2]
    assert got[3][0] == got[4][0] == plate + "\n\n" + own[3]
    assert got[5] == (plate, len(plate))


def test_short_blocks_repeated_on_a_host(spark):
    feet = [" ".join(f"foot{k}x{j}" for j in range(k)) for k in range(5, 11)]
    own = {i: " ".join(f"own{i}x{j}" for j in range(7)) for i in range(6)}
    page = "<html><body><p>{0}</p>" + "".join(f"<div>{f}</div><p>{{1}} {k}</p>" for k, f in enumerate(feet)) + "</body></html>"
    rows = [(i, f"http://a.com/{i}", page.format(own[i], own[i])) for i in range(2)]
    rows += [(2, "http://b.com/2", page.format(own[2], own[2]))]  # another host
    rows += [(3, "http://c.com/3", f"<p>{own[3]}</p><div>{feet[0]}</div>")] * 2  # copies of a page
    rows += [(4, "http://d.com/4", f"<p>{own[4]} {feet[0]} {own[4]}</p>"), (5, "http://d.com/5", f"<p>{own[5]}</p><div>{feet[0]}</div>")]  # inside a block
    rows += [(6, "http://e.com/6", f"<p>{own[4]}</p><div>{feet[1]}</div>"), (7, "http://e.com/7", f"<article>x</article><footer>{feet[1]}</footer>")]
    got = {d: t for d, (t, _) in rows_of(spark.createDataFrame(rows, "page_id long, url string, html string")).items()}
    for i in range(2):
        assert got[i] == "\n\n".join([own[i], *(f"{own[i]} {k}" for k in range(6))])
    assert all(f in got[2] for f in feet)
    assert got[3] == own[3] + "\n\n" + feet[0] and got[4] == f"{own[4]} {feet[0]} {own[4]}" and got[5] == own[5] + "\n\n" + feet[0]
    assert got[6] == own[4]


def test_hot_minimizers_are_no_one_task(spark):
    import random

    rng = random.Random(3)
    rows = []
    for i in range(60):
        parts = [f"c{rng.randrange(6)} " * 3 + "one hot phrase here " + " ".join(f"d{rng.randrange(4)}" for _ in range(5)) for _ in range(6)]
        rows.append((i, f"http://{'ab'[i % 2]}.com/{i}", f"<p>own{i} " + " ".join(parts) + "</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    plain = rows_of(df)
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in P.extract(df, hot=3).collect()} == plain and any(len(t.split()) < 60 for t, _ in plain.values())


def test_segments_are_dealt_in_bounded_buckets(spark):
    rows = [("h", 1, bytes([i, 1])) for i in range(50)] + [("h", k, bytes([k, 2])) for k in range(2, 252)]
    segments = spark.createDataFrame(rows, "host string, key long, hash binary")
    cool, warm = P.dealt(segments, hot=5)
    assert {r["key"] for r in warm.collect()} == {1} and cool.count() == 250
    assert cool.select("bucket").distinct().count() > 30 and max(r["count"] for r in cool.groupBy("bucket").count().collect()) <= 20
    cool, warm = P.dealt(segments, hot=1000)
    assert warm is None and cool.count() == 300


def test_awkward_rows_and_empty(spark):
    schema = "page_id long, url string, html string, host string, row int, blocks double"
    rows = [(1, None, None, "h", 1, 1.0), (2, "http://x.com/", "", "h", 1, 1.0), (None, "x", "<article>é</article>", None, None, None)]
    rows += [(3, "http://x.com/3", "<article>a</article>", "h", 1, 1.0)] * 2 + [(4, "http://x.com/4", "<p>" + "w " * 50000, "h", 1, 1.0)]
    got = sorted((tuple(r) for r in P.extract(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert len(got) == 6 and (1, None, "", 0) in got and (None, "x", "é", 1) in got and got.count((3, "http://x.com/3", "a", 1)) == 2
    assert [g for g in got if g[0] == 4][0][3] == 99999
    assert P.extract(spark.createDataFrame([], schema)).collect() == []


def test_smoke_table_keeps_whole_articles(spark, smoke_dir):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{smoke_dir}/pages.parquet")
    got = rows_of(pages)
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert got[r["page_id"]][0] == "\n\n".join(x for x in parts if x)
