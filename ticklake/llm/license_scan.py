"""License scans: phrases, and a fuzzy search for short license notices.

Every text is brought to its words (A-Z lower-cased; a word is a run of
letters, digits and non-ASCII characters) joined by single spaces.

*Base*: places where the words of a phrase stand consecutively.

*Notices*: each notice may differ from the text by up to ``errors`` single
character edits.  By the pigeonhole principle one of ``errors + 1`` pieces of
the notice then stands in the text unchanged.  An Aho-Corasick automaton over
the pieces of all notices finds these seeds in one pass over the text; around
each seed, the ``regex`` library's bounded-error matching verifies the edits and
gives the best span.  Spans are widened to whole words.

Rows are scanned one by one in the tasks that read them: no shuffle.

Defined results: null and empty texts have no words, no places, empty labels
and score 0.  Overlapping places all count; spans of a notice that share more than
half of its length, as two seeds can give, are one match, with the fewest edits.  Other columns of the input are ignored; repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: phrase, label
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: notice, label: short texts by which works name their license
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version", "apache"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("creative commons attribution", "cc"),
    ("licensed under cc by", "cc"),
    ("all rights reserved", "proprietary"),
]

ERRORS = 2

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, matches array<struct<label:string,notice:string,first_word:long,last_word:long,errors:int,found:string>>")

_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_TO_WORDS = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length with their offsets."""
    n = errors + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES, errors: int = ERRORS):
        import ahocorasick
        import regex

        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases]
        self.notices, self.errors = notices, errors
        self.seeds = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(notices):
            for off, piece in pieces(notice, errors):
                where.setdefault(piece, []).append((i, off))
        for piece, at in where.items():
            self.seeds.add_word(piece, (len(piece), at))
        if where:
            self.seeds.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={errors}}}") for n, _ in notices]

    def words(self, text: str | None) -> bytes:
        """The words, joined and surrounded by single spaces."""
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS)
        return b" " + b" ".join(raw.split(b" ")) + b" " if b"  " not in raw else b" " + b" ".join(w for w in raw.split(b" ") if w) + b" "

    def scan(self, text: str | None) -> tuple:
        joined = self.words(text).strip(b" ")
        n_words = joined.count(b" ") + 1 if joined else 0
        padded = b" " + joined + b" "
        starts, base = [], set()
        for phrase, label in self.phrases:
            at, seen, count = padded.find(phrase), 0, 0
            while at >= 0:
                count += padded.count(b" ", seen, at)
                seen = at
                starts.append(count)
                base.add(label)
                at = padded.find(phrase, at + 1)
        found = self.fuzzy(joined.decode("utf-8", "surrogatepass")) if n_words else []
        labels = base | {m["label"] for m in found}
        score = 1.0 if base else max((1 - m["errors"] / len(m["notice"]) for m in found), default=0.0)
        return (n_words, len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, found)

    def fuzzy(self, joined: str) -> list[dict]:
        """Matches with at most ``errors`` edits, at most one a span and notice."""
        if not self.notices:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (length, at) in self.seeds.iter(joined):
            for i, off in at:
                start = end - length + 1 - off
                windows.setdefault(i, []).append((max(0, start - self.errors), min(len(joined), start + len(self.notices[i][0]) + self.errors)))
        out = []
        for i, spans in sorted(windows.items()):
            notice, label = self.notices[i]
            # a window holds one match; the same place found by several seeds is one
            verified = {m.span(): sum(m.fuzzy_counts) for a, b in sorted(set(spans)) if (m := self.patterns[i].search(joined, a, b))}
            placed: list[tuple[int, int, int]] = []
            for (a, b), errors in sorted(verified.items()):
                same = placed and 2 * (placed[-1][1] - a) > len(notice)
                if same and errors < placed[-1][2]:
                    placed[-1] = (a, b, errors)
                elif not same:
                    placed.append((a, b, errors))
            first, counted = 0, 0  # words before a place, counted from the match before
            for start, end, errors in placed:
                lo = joined.rfind(" ", 0, start + 1) + 1 if joined[start] != " " else start + 1
                hi = joined.find(" ", end - 1)
                hi = len(joined) if hi < 0 else hi
                first, counted = (first + joined.count(" ", counted, lo), lo) if lo >= counted else (joined.count(" ", 0, lo), lo)
                out.append({"label": label, "notice": notice, "first_word": first,
                            "last_word": first + joined.count(" ", lo, hi), "errors": errors, "found": joined[lo:hi]})
        return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=tuple(PHRASES),
                  notices=tuple(NOTICES), errors: int = ERRORS) -> DataFrame:
    """Base places, labels, score and verified spans of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, errors)
        names = SCHEMA_ARROW.names
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.int64()), batch.column(1)
            rows = [scanner.scan(t.as_py()) for t in texts]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names[1:]]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(SCHEMA_ARROW)[1:], strict=True))], schema=SCHEMA_ARROW)

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, SCHEMA)


SCHEMA_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("matches", pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()),
                                    ("last_word", pa.int64()), ("errors", pa.int32()), ("found", pa.string())]))),
])
