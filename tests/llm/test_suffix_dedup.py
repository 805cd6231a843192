import hashlib
import random

import numpy as np
import pyarrow as pa

from ticklake.llm import suffix_dedup as S
from ticklake.llm.column_bwt import column_bwt, least_owner, places


def brute(rows, window=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from a table of all windows."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - window + 1):
                w = b[i:i + window]
                least[w] = min(d, least.get(w, d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - window + 1):
                if least[b[i:i + window]] < d:
                    gone[i:i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def ours(df, **kw):
    return sorted((tuple(r) for r in S.remove_repeats(df, **kw).collect()), key=str)


def test_smoke_table_like_brute_force(spark, documents):
    rows = [(d, t) for d, t, _ in documents]
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_passages_periods_and_unicode(spark):
    rng = random.Random(2)
    passages = ["".join(rng.choice("abcdé ñ") for _ in range(rng.choice([49, 50, 51, 60, 120, 300]))) for _ in range(12)]
    rows = []
    for d in range(150):
        parts = [rng.choice(passages)[rng.randrange(5):] if rng.random() < .6 else "".join(rng.choice("xyzw日") for _ in range(rng.randrange(80))) for _ in range(5)]
        rows.append((rng.randrange(1000), "".join(parts)))
    rows += [(2000, "ab" * 400), (2001, "ab" * 30 + "c" + "ab" * 300), (2002, "a" * 1000), (2003, "a" * 49), (2004, "a" * 50), (1999, "x" + "a" * 49)]
    rows += [(2100, "\0" * 60), (2101, "q" + "\0" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ours(df) == brute(rows)
    assert ours(df, collection=5) == brute(rows)
    assert ours(df, hot=2) == ours(df, hot=0) == brute(rows)  # windows go one by one


def test_awkward_rows(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = ours(awkward)
    assert [g for g in got if g[1] < 10000] == [b for b in brute([r for r in rows if len(r[1] or "") < 10000])]
    assert [g for g in got if g[1] >= 10000][0][2] == 0  # repeats inside one document stay


def test_empty(spark, empty):
    assert ours(empty) == []


def test_kept_text_is_whole_characters(spark):
    text = "é" * 30  # 60 bytes
    df = spark.createDataFrame([(1, text, 1), (2, "z" + text[:27] + "q", 2)], "doc_id long, text string, r long")
    got = {r["row"]: r for r in S.remove_repeats(df, carry={"row": "r"}).collect()}
    assert got[1]["kept_text"] == text and got[2]["kept_text"] == "zq" and got[2]["n_removed"] == 54


def test_column_bwt_like_sorting_suffixes():
    rng = random.Random(3)
    for trial in range(150):
        strings = ["".join(rng.choice("ab" if trial % 2 else "abc") for _ in range(rng.randrange(1, 14))) for _ in range(rng.randrange(1, 12))]
        lengths = np.array([len(s) for s in strings])
        columns = np.zeros((len(strings), lengths.max()), np.uint8)
        for i, s in enumerate(strings):
            columns[i, :len(s)] = [ord(c) - 96 for c in reversed(s)]
        bwt, lcp = column_bwt(columns, lengths)
        suffixes = sorted((s[k:], i) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert bwt.tolist() == [0 if len(t) == lengths[i] else ord(strings[i][len(strings[i]) - len(t) - 1]) - 96 for t, i in suffixes]
        common = [0]
        for (a, _), (b, _) in zip(suffixes, suffixes[1:]):
            common.append(next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))
        assert lcp.tolist() == common
        at = places(bwt, lengths)
        assert all(at[i, len(t) - 1] == r for r, (t, i) in enumerate(suffixes) if t)


def test_least_owner():
    rows = np.frombuffer(b"abcdefgh" b"xabcdexx" b"zzzzzzzz", np.uint8).reshape(3, 8)
    got = least_owner(rows, np.array([8, 7, 8]), np.array([5, 3, 9]), 4)
    assert got[0].tolist() == [3, 3, 5, 5, 5] and got[1][:4].tolist() == [3, 3, 3, 3] and got[1][4] == np.iinfo(np.int64).max


def test_chance_meetings_are_not_compared(monkeypatch):
    """Blocks that have a short phrase in common and no window do not go to the
    transform; a bucket's answers are right whether they do or not."""
    rng = random.Random(4)
    rows = [(d, "".join(rng.choice("abcdefgh") for _ in range(60)) + " and of the other one it was " + "".join(rng.choice("abcdefgh") for _ in range(60))) for d in range(200)]
    rows += [(d + 200, rows[d][1][30:110]) for d in range(0, 200, 20)] + [(300 + d, "ab" * 60) for d in range(3)]
    docs = pa.table({"doc_id": pa.array([r[0] for r in rows]), "text": pa.array([r[1] for r in rows])})
    gone, compared = {}, []
    monkeypatch.setattr(S, "least_owner", lambda strings, *a: compared.append(len(strings)) or least_owner(strings, *a))
    batches = [S._Batch(docs.filter(pa.array(np.arange(len(rows)) % 2 == b)), S.WINDOW, S.GRAM, 1) for b in range(2)]
    answers = S._repeated_minimizers(pa.concat_tables([x.minimizer_messages(b) for b, x in enumerate(batches)]), S.HOT)
    for b, x in enumerate(batches):
        x.repeated(answers.slice(b, 1))
    sent = pa.concat_tables([x.block_messages(b) for b, x in enumerate(batches)])
    least = S._least_documents(sent, S.WINDOW, (S.WINDOW + S.GRAM) // 2, S.COLLECTION)
    for b, x in enumerate(batches):
        for d, n in zip(x.doc_ids.tolist(), [int(g.sum()) for g in np.split(x.covered(least.slice(b, 1)), x.offsets[1:-1])], strict=True):
            gone[d] = n
    assert gone == {d: n for d, _, n, *_ in brute(rows)}
    assert sum(compared) < 60  # the blocks of copied text, and not those of the phrase


def test_messages_do_not_grow_with_the_square_of_the_batches():
    assert [S._buckets(n) for n in (1, 42, 206, 2424)] == [1, 42, 64, 606]
