"""SentencePiece (BPE) encoding and decoding by backtracking.

The text is escaped as the model does it (a leading space, then every space and
every ``▁`` becomes ``▁``) and cut before each run of ``▁``, where no piece of
such a model crosses.  Each chunk is encoded on its own:

* an Aho-Corasick automaton over all pieces gives the longest piece starting at
  each place;
* pieces are laid from left to right, longest first.  A piece may follow the
  one before it only if merging the characters of both again, by the model's
  scores, yields just these two pieces; answers are remembered by pair;
* where nothing fits, the place is marked failed in a bit field, the last piece
  is taken back and its longest shorter prefix piece is tried.

The result is the one segmentation whose neighbours all survive merging, which
is what merging the whole chunk gives.  Equal scores break that argument; the
model has them only among runs of ``▁``, so chunks that start with two or more
``▁`` are merged directly.  Characters without a piece end a run of pieces and
become their UTF-8 byte pieces.

Decoding concatenates the pieces, joins byte pieces to characters (invalid
bytes become U+FFFD each), turns ``▁`` into spaces and drops the first one.

Chunks repeat; each task keeps a bounded table of encoded ones.  Rows are
encoded in the tasks that read them: no shuffle.

Defined results: null and empty texts have no ids.  Other columns are ignored,
repeated rows are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
REMEMBERED, PAIRS = 150_000, 250_000


class PieceCoder:
    """Encoder and decoder of one model; the library only reads the file."""

    def __init__(self, model_file: str, remembered: int = REMEMBERED):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.byte_ids: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.out: list[bytes] = []
        self.unknown = sp.unk_id()
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.out.append(bytes([value]))
            elif sp.is_control(i):
                self.out.append(b"")
            elif sp.is_unknown(i):
                self.out.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.out.append(piece.encode())
        self.controls = {i for i in range(n) if sp.is_control(i)}
        self.is_byte = [sp.is_byte(i) for i in range(n)]
        if any(c not in self.ids for p in self.ids for c in p) or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("this model's pieces cross spaces or hold characters that are no pieces")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.length = [len(p) for p in self.piece]
        #: the longest piece that is a proper prefix of a piece, or -1
        self.shorter = [next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1) for p in self.piece]
        self.characters = {p for p in self.ids if len(p) == 1}
        self.pairs: dict[int, bool] = {}
        self.remembered = remembered
        self.known: dict[str, bytes] = _Chunks(self)

    def merge(self, text: str) -> list[str]:
        """Merge neighbours by score, highest first, of equal ones the leftmost."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: int, right: int) -> bool:
        """Whether merging both again gives just these two pieces."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        x, y = self.piece[left], self.piece[right]
        known = self.pairs[left << 32 | right] = self.merge(x + y) == [x, y]
        return known

    def run(self, text: str) -> list[int]:
        """Ids of the pieces of a run of characters that all are pieces."""
        size, length, shorter, pairs = len(text), self.length, self.shorter, self.pairs
        longest = [-1] * (size + 1)
        for end, i in self.automaton.iter(text):
            longest[end + 1 - length[i]] = i
        failed = 0  # a bit for each place
        laid: list[int] = []
        at, last, piece = 0, -1, longest[0]
        while at < size:
            while piece >= 0:
                if not failed >> at + length[piece] & 1:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | piece)
                    if self.fit(last, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                laid.append(piece)
                at += length[piece]
                last, piece = piece, longest[at]
            else:
                if not laid:
                    raise ValueError("no segmentation")
                failed |= 1 << at
                taken = laid.pop()
                at -= length[taken]
                last, piece = laid[-1] if laid else -1, shorter[taken]
        return laid

    def chunk(self, text: str) -> list[int]:
        """Ids of a chunk: some spaces (escaped), then no more of them."""
        if text.startswith(SPACE * 2):
            return [j for p in self._merged_runs(text) for j in self._ids(p)]
        if self.characters.issuperset(text):
            return self.run(text)
        ids: list[int] = []
        for known, run in self._runs(text):
            ids.extend(self.run(run) if known else self._ids(run))
        return ids

    def _ids(self, piece: str) -> list[int]:
        """A piece's id, or those of a character that is none."""
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        return [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]

    def _runs(self, text: str) -> Iterator[tuple[bool, str]]:
        start, ids = 0, self.ids
        for i, c in enumerate(text):
            if c not in ids:
                if start < i:
                    yield True, text[start:i]
                yield False, c
                start = i + 1
        if start < len(text):
            yield True, text[start:]

    def _merged_runs(self, text: str) -> list[str]:
        """Direct merging of a chunk that starts with a run of spaces."""
        spaces = len(text) - len(text.lstrip(SPACE))
        if spaces <= 64:
            out: list[str] = []
            for known, run in self._runs(text):
                out.extend(self.merge(run) if known else list(run))
            return out
        return self._long_merge(text)

    def _long_merge(self, text: str) -> list[str]:
        """Merging with a heap, for long runs of spaces."""
        import heapq

        out: list[str] = []
        for known, run in self._runs(text):
            if not known:
                out.extend(run)
                continue
            part: list[str | None] = list(run)
            nxt, prv = [*range(1, len(run)), -1], [-1, *range(len(run) - 1)]
            heap: list[tuple[float, int, int]] = []

            def offer(i: int, j: int, part=part, heap=heap) -> None:
                if i >= 0 and j >= 0 and (s := self.score.get(part[i] + part[j])) is not None:
                    heapq.heappush(heap, (-s, i, len(part[i]) + len(part[j])))

            for i in range(len(run) - 1):
                offer(i, i + 1)
            while heap:
                _, i, size = heapq.heappop(heap)
                if part[i] is None or (j := nxt[i]) < 0 or len(part[i]) + len(part[j]) != size:
                    continue
                part[i], part[j] = part[i] + part[j], None
                nxt[i] = nxt[j]
                if nxt[i] >= 0:
                    prv[nxt[i]] = i
                offer(prv[i], i)
                offer(i, nxt[i])
            out.extend(p for p in part if p is not None)
        return out

    def encode_digest(self, text: str | None) -> bytes:
        """The decimal ids joined by commas."""
        if not text:
            return b""
        if SPACE in text:
            text = text.replace(SPACE, " ")
        parts = text.split(" ")
        if "" in parts:  # runs of spaces, or one at either end
            parts = [m[1:] for m in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]
        return b",".join(map(self.known.__getitem__, parts))

    def encode(self, text: str | None) -> list[int]:
        digest = self.encode_digest(text)
        return list(map(int, digest.split(b","))) if digest else []

    def decode(self, ids: list[int]) -> str:
        try:
            if not self.controls.isdisjoint(ids):  # they end a run of bytes
                text = self._decode_bytes(ids)
            else:
                text = b"".join(map(self.out.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            text = self._decode_bytes(ids)
        return text.replace(SPACE, " ")[text.startswith(SPACE):]

    def _decode_bytes(self, ids: list[int]) -> str:
        """Runs of byte pieces to characters; each invalid byte is U+FFFD."""
        out, run = [], bytearray()

        def flush() -> None:
            i = 0
            while i < len(run):
                for k in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[i:i + k]).decode())
                        i += k
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    i += 1
            run.clear()

        for i in ids:
            if self.is_byte[i]:
                run += self.out[i]
            else:
                flush()
                out.append(self.out[i].decode())
        flush()
        return "".join(out)


class _Chunks(dict):
    """Encoded chunks (without their first space), as joined decimal ids."""

    def __init__(self, coder: PieceCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, part: str) -> bytes:
        ids = ",".join(map(str, self.coder.chunk(SPACE + part))).encode()
        if len(part) < 200:
            if len(self) >= self.coder.remembered:
                self.clear()
            self[part] = ids
        return ids


_CODERS: dict[str, PieceCoder] = {}


def coder(model_file: str) -> PieceCoder:
    """One coder a process and model file."""
    if model_file not in _CODERS:
        _CODERS[model_file] = PieceCoder(model_file)
    return _CODERS[model_file]


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Number of ids, digests of ids and of the text decoded from them, for
    every document; the ids themselves with ``with_ids``."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(model_file)
        for batch in batches:
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for text in batch.column(1):
                joined = code.encode_digest(text.as_py())
                ids = list(map(int, joined.split(b","))) if joined else []
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(joined).hexdigest())
                text_sha.append(hashlib.sha256(code.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, ddl)
