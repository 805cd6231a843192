from collections import defaultdict

from ticklake.llm import quality_rules as Q

WS = " \t\n\x0b\x0c\r"


def words(text):
    for c in WS:
        text = text.replace(c, "\0" if c == "\0" else " ")
    return [w for w in text.split(" ") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=Q.MIN_DOCS, max_share=Q.MAX_SHARE, min_left=Q.MIN_LEFT):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)"""
    held, texts = defaultdict(set), defaultdict(set)
    norm = lambda line: " ".join(words(lower(line)))
    for _, t, s in rows:
        texts[s].add(t or "")
        for line in (t or "").split("\n"):
            if norm(line):
                held[s, norm(line)].add(t)
    out = []
    for d, t, s in rows:
        t = t or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i:i + 3])].append(i)
        rep = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        gone = sum(len(words(x)) for x in lines if len(held[s, norm(x)]) >= min_docs and len(held[s, norm(x)]) > max_share * len(texts[s]))
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed,
                    not failed and not (gone and len(w) - gone < min_left * len(w))))
    return out


def ours(df, **kw):
    return sorted((tuple(r)[:8] for r in Q.quality(df, **kw).collect()), key=str)


def test_smoke_table_like_brute_force(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string, source string")
    assert ours(df) == sorted(brute(documents), key=str)
    assert ours(df, min_docs=2, max_share=.1, min_left=.9) == sorted(brute(documents, 2, .1, .9), key=str)


def test_frequent_lines_of_a_host(spark):
    plate = "Menu " + " ".join(f"m{i}" for i in range(60))
    body = lambda i: " ".join(f"b{i}x{j}" for j in range(60))
    rows = [(i, f"{plate.upper() if i % 2 else plate}  \n{body(i)}", "a") for i in range(70)]
    rows += [(100 + i, f"{plate}\nmore {i}", "a") for i in range(5)]  # nothing but the line
    rows += [(200, plate, "b")] + [(300 + i, body(999), "c") for i in range(90)]  # one document there; copies
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r[0]: r[7] for r in ours(df)}
    assert ours(df) == sorted(brute(rows), key=str)
    assert all(got[i] for i in range(70)) and not any(got[100 + i] for i in range(5)) and got[200] and all(got[300 + i] for i in range(90))


def test_template_on_a_minority_of_a_host(spark):
    template = "\n".join(f"Menu {i} " + " ".join(f"m{i}x{j}" for j in range(8)) for i in range(30))
    unique = lambda i, n: " ".join(f"u{i}y{j}" for j in range(n))
    rows = [(i, f"{template}\n{unique(i, 12)}", "h") for i in range(80)] + [(1000 + i, unique(i + 1000, 90), "h") for i in range(320)]
    rows += [(5000 + i, f"{template}\n{unique(i + 5000, 12)}", "other") for i in range(49)]  # one below the limit
    rows += [(9000, f"{template}\n{unique(9000, 200)}", "h")]  # enough left
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert ours(df) == sorted(brute(rows), key=str)
    got = {r.doc_id: r for r in Q.quality(df).collect()}
    assert all(not got[i].kept and got[i].n_removed_lines == 30 for i in range(80))
    assert all(got[1000 + i].kept for i in range(320)) and all(got[5000 + i].kept for i in range(49)) and got[9000].kept


def test_awkward_rows_and_empty(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    assert ours(awkward) == sorted(brute(rows), key=str)
    assert ours(empty) == []
