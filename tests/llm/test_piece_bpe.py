import hashlib
import random

import pytest
import sentencepiece

from ticklake.llm import piece_bpe as B
from ticklake.llm.queries import model_file

FIXED = ["Hello  world\n\tfoo ", " lead", "", "é ﬁ ①　x　y", "a\x00b", "😀 日本", "▁x ▁▁ y", "\u200bz\xa0q\r\n", "<s> </s><unk> <0x0A>", "é", "   ", " " * 200 + "x",
         " " * 70, "a" * 500, "ab" * 3000, "▁", "日本語の文章です。", "x" + " " * 33 + "▁hello", "\n\n\n  \n", "aaaa  bbbb   cccc    dddd     eeeee", "\ufeff", "\ufffd�"]


@pytest.fixture(scope="module")
def both():
    return B.PieceCoder(model_file()), sentencepiece.SentencePieceProcessor(model_file=model_file())


def test_like_the_library(both):
    ours, library = both
    rng = random.Random(1)
    letters = list("abcdeé ▁ \n\t日本<>0xA.,the  ingion😀")
    texts = FIXED + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x4E00, 0x4F00)])) for _ in range(30)) for _ in range(500)]
    for t in texts:
        ids = library.encode(t)
        assert ours.encode(t) == ids, t
        assert ours.decode(ids) == library.decode(ids)


def test_decoding_any_ids(both):
    ours, library = both
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([*range(0, 260), 300, 400, 29871, 31999]) for _ in range(rng.randrange(9))]
        assert ours.decode(ids) == library.decode(ids), ids


def test_backtracking_is_merging(both):
    ours, _ = both
    rng = random.Random(3)
    for _ in range(3000):
        text = "▁" + "".join(rng.choice("abinthegrs") for _ in range(rng.randrange(1, 14)))
        assert [ours.piece[i] for i in ours.run(text)] == ours.merge(text)


def test_small_table_of_chunks(both):
    _, library = both
    ours = B.PieceCoder(model_file(), remembered=3)
    text = "one two three four five six one two three " * 20
    assert ours.encode(text) == library.encode(text) and len(ours.known) <= 3


def test_table_and_awkward_rows(spark, documents, awkward, empty, both):
    _, library = both
    rows = [(d, t) for d, t, _ in documents]
    for df, want in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (awkward, [(r["doc_id"], r["text"]) for r in awkward.collect()])):
        expected = []
        for d, t in want:
            ids = library.encode(t or "")
            expected.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        assert sorted((tuple(r) for r in B.encode_documents(df, model_file()).collect()), key=str) == sorted(expected, key=str)
    assert B.encode_documents(empty, model_file()).collect() == []
    assert [r["ids"] for r in B.encode_documents(awkward.where("doc_id = 900003"), model_file(), with_ids=True).collect()] == [library.encode("one")]
