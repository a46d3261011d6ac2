"""SentencePiece BPE encoding by backtracking, and decoding.

A text becomes segments: a run of space marks with what follows, up to the next mark. No piece of such a model has a
mark after another character, nor a newline, so merges never cross segments or lines, and segments can be encoded (and
remembered) alone. In a segment an Aho-Corasick automaton over the pieces gives every piece at every place. The encoder takes the longest one,
and goes on from its end; a piece may follow another only if re-merging the two by the model's scores gives just these
two back. If no piece fits, the end is marked in a bitfield of failed positions and the encoder steps back to the next
shorter piece. Since the encoding is the only sequence whose neighbours all fit, the first one found is it.
Characters that no piece has become byte pieces.

Bounded memory: remembered segments and pairs are dropped when they reach a fixed number.

Defined results: null text is empty and has no ids; a text of any length is encoded whole; null ids stay null; repeated
rows each give a row; an empty table gives no rows; only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import doc_texts

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
KEEP_SEGMENTS, KEEP_PAIRS, KEEP_LENGTH = 1_200_000, 1_000_000, 48


class Matches:
    """All pieces at each place of a long segment, shorter ones first, found a window at a time; few windows are held."""

    SIZE, HELD = 1 << 16, 4

    def __init__(self, automaton: ahocorasick.Automaton, text: str, longest: int) -> None:
        self.automaton, self.text, self.longest = automaton, text, longest
        self.windows: dict[int, list[list[tuple[int, int]]]] = {}

    def __getitem__(self, at: int) -> list[tuple[int, int]]:
        w, inside = divmod(at, self.SIZE)
        if w not in self.windows:
            if len(self.windows) >= self.HELD:
                del self.windows[next(iter(self.windows))]
            self.windows[w] = matches(self.automaton, self.text[w * self.SIZE : (w + 1) * self.SIZE + self.longest], self.SIZE)
        return self.windows[w][inside]


def matches(automaton: ahocorasick.Automaton, text: str, most: int) -> list[list[tuple[int, int]]]:
    """(length, piece) of all pieces that start at each of the first ``most`` places, shorter ones first."""
    by_start: list[list[tuple[int, int]]] = [[] for _ in range(min(len(text), most))]
    for end, found in automaton.iter(text):
        start = end - found[0] + 1
        if start < most:
            by_start[start].append(found)
    return by_start


class PieceEncoder:
    """Encodes like the sentencepiece library with the BPE model of the given file (identity normalisation)."""

    def __init__(self, model_file: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = self.library.get_piece_size()
        plain = [i for i in range(n) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))]
        self.pieces = {self.library.id_to_piece(i): i for i in plain}
        self.scores = {p: self.library.get_score(i) for p, i in self.pieces.items()}
        self.names = {i: p for p, i in self.pieces.items()}
        self.bytes = {int(self.library.id_to_piece(i)[1:-1], 16): i for i in range(n) if self.library.is_byte(i)}
        self.unknown = self.library.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece has a space mark after another character")
        self.longest = max(map(len, self.pieces), default=0)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.pieces.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.width = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.written = [str(i) for i in range(n)]
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}  # segments that begin with one space mark, by what follows it
        self.bare: dict[str, bytes] = {}  # beginnings of lines
        self.line_end = None if any("\n" in p for p in self.pieces) else self.packed(self.segment("\n"))

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge neighbours, the best score first and of equal ones the leftmost, until none forms a piece."""
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a: merging their characters gives these two. -1: b begins the segment."""
        if len(self.pairs) >= KEEP_PAIRS:
            self.pairs.clear()
        pair = [self.names[a], self.names[b]] if a >= 0 else [self.names[b]]
        ok = self.pairs[(a << 32) + b] = self.merged(list("".join(pair))) == pair
        return ok

    def segment(self, text: str) -> list[int]:
        """Ids of a segment."""
        by_start = matches(self.automaton, text, len(text)) if len(text) <= Matches.SIZE else Matches(self.automaton, text, self.longest)
        ids: list[int] = []
        at = 0
        while at < len(text):
            if not by_start[at]:
                ids += [self.bytes[x] for x in text[at].encode()] if self.bytes else [self.unknown]
                at += 1
                continue
            stop = at  # up to the next character without a piece
            while stop < len(text) and by_start[stop]:
                stop += 1
            ids += self.stretch(by_start, at, stop)
            at = stop
        return ids

    def stretch(self, by_start: list[list[tuple[int, int]]] | Matches, begin: int, end: int) -> list[int]:
        """Ids of a stretch whose characters all have pieces."""
        failed = bytearray((end - begin >> 3) + 1)
        pairs, fits = self.pairs, self.fits
        stack: list[tuple[int, int, int]] = []  # where a piece starts, its place among the choices there, the piece
        at, last, k = begin, -1, len(by_start[begin]) - 1
        while at < end:
            found = by_start[at]
            while k >= 0:
                length, piece = found[k]
                to = at + length - begin
                if not failed[to >> 3] >> (to & 7) & 1:
                    ok = pairs.get((last << 32) + piece)
                    if fits(last, piece) if ok is None else ok:
                        break
                k -= 1
            if k >= 0:
                stack.append((at, k, piece))
                at, last = at + length, piece
                k = len(by_start[at]) - 1 if at < end else -1
            else:
                failed[at - begin >> 3] |= 1 << (at - begin & 7)
                if not stack:
                    raise ValueError("no encoding")
                at, k, _ = stack.pop()
                last, k = stack[-1][2] if stack else -1, k - 1
        return [piece for _, _, piece in stack]

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.width).tobytes()

    def remembered(self, store: dict[str, bytes], mark: str, words: list[str]) -> bytes:
        """Packed ids of the segments mark + word."""
        try:
            return b"".join(map(store.__getitem__, words))
        except KeyError:
            pass
        parts = []
        for w in words:
            got = store.get(w)
            if got is None:
                got = self.packed(self.segment(mark + w))
                if len(w) <= KEEP_LENGTH:
                    if len(store) >= KEEP_SEGMENTS:
                        store.clear()
                    store[w] = got
            parts.append(got)
        return b"".join(parts)

    def encoded(self, text: str) -> list[int]:
        """Ids of a whole text."""
        if not text:
            return []
        if self.line_end is None or MARK in text or "  " in text or text[0] == " ":
            parts = [self.packed(self.segment(s)) for s in SEGMENT.findall(MARK + text.replace(" ", MARK))]
        else:  # one space before each word, and no piece has a newline: words and beginnings of lines are segments
            parts = []
            for i, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if i:
                    parts += [self.line_end, self.remembered(self.bare, "", words[:1])]
                parts.append(self.remembered(self.known, MARK, words[1:] if i else words))
        return np.frombuffer(b"".join(parts), self.width).tolist()

    def ids_digest(self, ids: list[int]) -> str:
        """SHA-256 of the decimal ids with commas."""
        return hashlib.sha256(",".join(map(self.written.__getitem__, ids)).encode()).hexdigest()

    def decoded(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_encoders: dict[str, PieceEncoder] = {}


def encoder_for(model_file: str) -> PieceEncoder:
    """One encoder for each Python worker."""
    if model_file not in _encoders:
        _encoders[model_file] = PieceEncoder(model_file)
    return _encoders[model_file]


def round_trip(model_file: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model_file)
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids = encoder.encoded(text.as_py())
                rows.append((len(ids), encoder.ids_digest(ids), hashlib.sha256(encoder.decoded(ids).encode()).hexdigest()))
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True))], names)

    return run


def encode_decode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: ids of the whole text, and the text they decode to."""
    return doc_texts(docs, id_col, text_col).mapInArrow(round_trip(model_file), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([encoder.encoded(t.as_py()) for t in batch.column("text")], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return doc_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")
