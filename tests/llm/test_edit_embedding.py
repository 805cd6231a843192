import hashlib
import random

import numpy as np
import pytest
import xxhash

from ticklake.llm import edit_embedding as E


def following(rows):
    """(row, next row) in the order of descending ids."""
    h = lambda t: int.from_bytes(xxhash.xxh64(t.encode(), seed=42).digest(), "big", signed=True) if t is not None else 42
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), h(r[1])))
    return list(zip(order, order[1:] + order[:1], strict=True))


BITS = [(E._hash(np.arange(E.PERIOD)[:, None], np.arange(E.CLASSES)[None, :], np.full((1, E.CLASSES), w)) & np.uint64(1)).tolist() for w in range(E.WALKS)]


def one_step_at_a_time(text, walk):
    """The character (its place) that stands at every step of a walk."""
    out, i, stayed, kinds, bits = [], 0, 0, E.classes(E.points(text)).tolist(), BITS[walk]
    while i < len(kinds):
        out.append(i)
        stayed += 1
        if bits[(len(out) - 1) % E.PERIOD][kinds[i]] or stayed == E.LONGEST:
            i, stayed = i + 1, 0
    return out


def sampled(text, walk):
    steps = one_step_at_a_time(text, walk)
    level = 0
    while -(-len(steps) // 2 ** level) > E.SAMPLES:
        level += 1
    out = []
    for block in range(-(-len(steps) // 2 ** level)):
        at = block
        for lv in range(level, 0, -1):
            at = 2 * at + int(E._hash([at], [lv])[0] & 1)
        out.append(1 + int(E._hash([ord(text[steps[at]])], [at], [walk])[0] % 255) if at < len(steps) else 0)
    return bytes([level, len(out), *out])


def brute(rows):
    out = []
    for (d, t), (_, nxt) in following(rows):
        t, nxt = t or "", nxt or ""
        body = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        marks = [b"".join(sampled(x, w) for w in range(E.WALKS)) for x in (t, body, nxt)]
        like = [E.likeness(E.parsed(marks[0]), E.parsed(m)) for m in marks[1:]]
        out.append((d, len(t), hashlib.sha256(body.encode()).hexdigest(), marks[0].hex(), marks[1].hex(), *like))
    return sorted(out, key=str)


def ours(df):
    return sorted(map(tuple, E.fingerprints(df).collect()), key=str)


def test_smoke_table_like_brute_force(spark, documents):
    rows = [(d, t) for d, t, _ in documents]
    df = spark.createDataFrame(documents, "doc_id long, text string, source string")
    got = ours(df)
    assert got == brute(rows)
    assert sum(r[5] > r[6] for r in got) > .95 * len(got)  # half of a text is nearer than the next text
    assert sum(r[5] for r in got) / len(got) > .4 > .25 > sum(r[6] for r in got) / len(got)


def test_awkward_rows_and_empty(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert ours(awkward) == brute(rows)
    assert ours(empty) == []
    alone = spark.createDataFrame([(7, "näh 😀 a")], "doc_id long, text string")
    assert ours(alone) == brute([(7, "näh 😀 a")]) and ours(alone)[0][6] == 1.0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 30, 31, 32, 33, 63, 64, 65, 700, 40001])
def test_lengths(n):
    rng = random.Random(n)
    text = "".join(rng.choice("abcdeé 😀") for _ in range(n))
    mark = E.fingerprint(text)
    assert E.packed(mark) == b"".join(sampled(text, w) for w in range(E.WALKS))
    assert E.likeness(mark, E.fingerprint(text)) == 1.0 and E.parsed(E.packed(mark))[1][0] == mark[1][0]


def test_likeness_falls_with_edits():
    rng = random.Random(1)
    mean = []
    for edits in (0, 2, 10, 40, 400):
        total = 0
        for _ in range(30):
            text = [rng.choice("etaoinshrdlu ") for _ in range(1000)]
            other = list(text)
            for _ in range(edits):
                i = rng.randrange(len(other))
                other[i:i + rng.randrange(2)] = rng.choice(["", "q"])
            total += E.likeness(E.fingerprint("".join(text)), E.fingerprint("".join(other)))
        mean.append(total / 30)
    assert mean[0] == 1.0 and all(a > b for a, b in zip(mean, mean[1:], strict=False)) and mean[1] > .7 and mean[-1] < .3


def test_levels_are_compared_at_the_coarser():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(66))
    longer = text * 2
    a, b = E.fingerprint(longer[:len(text)]), E.fingerprint(longer)
    assert a[0][0] < b[0][0] and .4 < E.likeness(a, b) < .7


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randrange(20))) for _ in range(2))
        assert E.edit_distance(a, b) == levenshtein(a, b)


def test_near_copies(spark):
    rng = random.Random(4)
    made = lambda n: [rng.choice("etaoinshrdlucm ") for _ in range(n)]
    rows, want = [], {}
    for g in range(12):
        text = made(rng.choice([40, 300, 2500]))
        for c in range(6):
            other = list(text)
            for _ in range(c * len(text) // 200):
                other[rng.randrange(len(other))] = "x"
            rows.append((g * 100 + c, "".join(other)))
            want[g * 100 + c] = g * 100
    rows += [(5000 + i, "".join(made(500))) for i in range(40)] + [(9000, rows[0][1]), (9001, None), (9002, ""), (None, "x")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, body int")
    got = {r.doc_id: r.class_id for r in E.near_copies(df).collect()}
    assert len(got) == len(rows) and sum(got[d] == w for d, w in want.items()) >= .95 * len(want)
    assert all(got[5000 + i] == 5000 + i for i in range(40)) and got[9000] == 0 and got[9001] == got[9002] == 9001 and got[None] is None
    assert E.near_copies(df.limit(0)).collect() == []
