import re

from ticklake.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    """n_words, n_base, first_word, last_word, base_labels"""
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


TEXTS = [None, "", "MIT License", "the mit--license, Apache\nLICENSE v2; mit license", "mitlicense", "a mit license b mit license", "émit license",
         "mit licenseé", "general public license general public license", "GNU General Public\tLicense", "1 2 3 ", "apache license " * 500, "x " * 40000 + "mit license"]


def test_base_like_brute_force(spark, documents):
    rows = [(d, t) for d, t, _ in documents] + [(10**6 + i, t) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert r["labels"].split(",") == sorted(set(r["labels"].split(",")))


def test_notices_with_edits():
    scan = L.Scanner()
    found = scan.scan("intro Released undr the MITT License. end")[-1]
    assert [(m["label"], m["errors"], m["first_word"], m["last_word"], m["found"]) for m in found if m["label"] == "mit"] == [("mit", 2, 1, 5, "released undr the mitt license")]
    assert scan.scan("all right reserved")[5] == "proprietary" and scan.scan("al rigt reservd")[5] == ""
    assert scan.scan("GNU Lesser General Public License")[5] == "gpl,lgpl"
    assert scan.scan("This is under the Mozila Public Licence 2.0")[5] == "mpl"


def test_neighbouring_notices_all_count():
    def places(text):
        return [(m["first_word"], m["last_word"], m["errors"]) for m in L.Scanner().scan(text)[-1] if m["notice"] == "all rights reserved"]

    assert places("x all right reserved all rights reserved y") == [(1, 3, 1), (4, 6, 0)]
    assert places("all right reserved all rigts reservd all rights reserved") == [(0, 2, 1), (3, 5, 2), (6, 8, 0)]
    assert places("all rights reserved all right reserved z " * 3) == [(7 * i + 3 * k, 7 * i + 3 * k + 2, k) for i in range(3) for k in range(2)]
    assert places("all rights reserved") == [(0, 2, 0)]


def test_all_planted_notices_are_found():
    import random

    rng, scan = random.Random(5), L.Scanner()
    for n, (notice, _) in enumerate(L.NOTICES):
        for _ in range(20):
            planted = []
            for _ in range(rng.randrange(2, 6)):
                t = list(notice)
                for _ in range(rng.randrange(L.ERRORS + 1)):
                    i = rng.choice([i for i in range(2, len(t) - 2) if "".join(t[i - 1:i + 2]).isalpha()])  # words stay words
                    t[i:i + 1] = rng.choice([[], ["q"], [t[i], "q"]])
                planted.append("".join(t))
            assert [m["notice"] for m in scan.scan(" zzzz ".join(planted))[-1]].count(notice) == len(planted), (n, planted)


def test_seeds_lose_no_match():
    import random

    import regex
    rng, scan = random.Random(8), L.Scanner()
    for notice, label in L.NOTICES:
        for _ in range(40):
            t = list(notice)
            for _ in range(rng.randrange(L.ERRORS + 1)):
                i = rng.randrange(1, len(t) - 1)
                t[i:i + 1] = rng.choice([[], ["q"], [t[i], "q"]])
            text = "zz " + "".join(t) + " zz"
            words = scan.words(text).decode().strip()
            assert bool(regex.search(f"(?:{regex.escape(notice)}){{e<={L.ERRORS}}}", words)) == (label in scan.scan(text)[5].split(","))


def test_awkward_rows_and_empty(spark, awkward, empty):
    got = L.scan_licenses(awkward).collect()
    assert len(got) == awkward.count() and {r["n_words"] for r in got if r["doc_id"] in (900001, 900002, 900004)} == {0}
    assert L.scan_licenses(empty).collect() == []


def test_many_notices_in_one_text_take_linear_time():
    import time
    scanner = L.Scanner()
    notice = L.NOTICES[0][0]
    begun = time.process_time()
    found = scanner.scan(f"{notice} one two three " * 20_000)[-1]
    assert time.process_time() - begun < 8
    n = notice.count(" ") + 4
    same = [m for m in found if m["notice"] == notice]
    assert [m["first_word"] for m in same] == [i * n for i in range(20_000)]
