"""Packing by concatenate and cut.

First pass: each input partition tokenises its documents in order and writes, for every document, its ids and how many
ids of the partition come before it, to the shared folder. The totals of the partitions (one number each) become
running sums: the global place of each partition, and so of each document, on one endless line of ids. Second pass:
the line is cut every ``length`` ids. A document knows from its place which windows it crosses, so each of its pieces
is a boundary record (window, offset, length) made without looking at any other document. Only the last window needs
padding. No pass moves ids between tasks.

Tokenising remembers the ids of words, as the tokenizer's merges never cross words; the tokenizer itself encodes each
new word, and all texts with characters outside of a plain range (where words may depend on their surroundings).

Defined results: null text is empty and has the end id alone; a text of any length is tokenised whole, in one row, and
cut into as many pieces as it takes; repeated rows are packed each; null ids stay null; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import doc_texts, write_scratch

#: Characters whose words are the same alone and in a text: ASCII and Latin-1 without controls.
PLAIN = [c for c in map(chr, range(0x21, 0x100)) if not unicodedata.category(c).startswith(("C", "Z"))]
NOT_PLAIN = re.compile(f"[^ \t\n\r{re.escape(''.join(PLAIN))}]|<\\|")


def word_pattern() -> re.Pattern[str]:
    """The tokenizer's words over plain, lower-case text: contractions, letters, single digits, other characters."""
    letters = re.escape("".join(c for c in PLAIN if unicodedata.category(c)[0] == "L"))
    numbers = re.escape("".join(c for c in PLAIN if unicodedata.category(c)[0] == "N"))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^ \t\n\r{letters}{numbers}]+")


class WordTokenizer:
    """Ids of a tokenizer file of lower-cased words, as packed little-endian 16- or 32-bit numbers."""

    def __init__(self, file: str, keep: int = 800_000) -> None:
        self.tokenizer = Tokenizer.from_file(file)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.parts = word_pattern().findall
        self.known: dict[str, bytes] = {}
        self.keep = keep

    def learn(self, words: set[str]) -> None:
        """Ids of new words (without white space). Their parts are what the tokenizer treats alone, so parts that are not
        known yet are encoded, in one text with spaces between them, and words are put together."""
        known = self.known
        split = [(w, self.parts(w)) for w in words]
        new = list({p for _, parts in split for p in parts if p not in known})
        got = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        ids, index = np.array(got.ids, self.width), np.array(got.word_ids, np.int64)
        if len(index) and index[-1] != len(new) - 1:
            raise ValueError("the tokenizer splits words otherwise")
        cuts = np.searchsorted(index, np.arange(len(new) + 1)).tolist()
        packed, size = ids.tobytes(), self.width.itemsize
        for p, a, b in zip(new, cuts[:-1], cuts[1:], strict=True):
            known[p] = packed[a * size : b * size]
        for w, parts in split:
            if len(parts) > 1:
                known[w] = b"".join([known[p] for p in parts])

    def ids(self, text: str) -> bytes:
        if NOT_PLAIN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        words = text.lower().split()
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            new = set(words).difference(self.known)
            if len(self.known) + len(new) > self.keep:
                self.known.clear()
                new = set(words)
            self.learn(new)
            return b"".join(map(self.known.__getitem__, words))


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_for(file: str) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    if file not in _tokenizers:
        _tokenizers[file] = WordTokenizer(file)
    return _tokenizers[file]


LINE = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])


def to_line(file: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """First pass over a partition: ids of each document and how many come before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer_for(file)
        end = np.array([end_id], tokens.width).tobytes()
        size, before = tokens.width.itemsize, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [tokens.ids(t.as_py()) + end for t in some.column("text")]
                counts = np.array([len(x) // size for x in ids], np.int64)
                starts = before + np.concatenate([[0], np.cumsum(counts)[:-1]])
                before += int(counts.sum())
                yield pa.RecordBatch.from_arrays([some.column("part"), some.column("doc_id"), pa.array(starts), pa.array(counts), pa.array([size] * len(ids), pa.int32()), pa.array(ids, pa.binary())], schema=LINE)

    return run


PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def cut(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Second pass: the pieces of each document between the cuts of the line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, at, n, width, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "n", "width")), batch.column("ids"), strict=True):
                wide = np.frombuffer(ids.as_py(), f"<u{width}").astype("<u4")
                start = 0
                while start < n:
                    window, offset = divmod(at + start, length)
                    stop = min(n, start + length - offset)
                    rows.append((doc_id, start, stop - start, zlib.crc32(wide[start:stop].tobytes()), n, window, offset))
                    start = stop
            columns = zip(*rows, strict=True) if rows else [[]] * len(PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=PIECES)

    return run


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 2) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row for each piece of a document."""
    spark = docs.sparkSession
    texts = doc_texts(docs, id_col, text_col).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    kept = "part int, doc_id long, before long, n long, width int, ids binary"
    line = spark.read.schema(kept).parquet(write_scratch(texts.mapInArrow(to_line(tokenizer_file, end_id), kept), "token-line"))
    totals = line.groupBy("part").agg(F.sum("n").alias("total"))
    # One row for each partition of the input: a running sum over their totals.
    bases = totals.select(F.col("part").alias("p"), (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = line.join(F.broadcast(bases), line["part"] == bases["p"]).select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "width", "ids")
    return placed.mapInArrow(cut(length), ", ".join(f"{f.name} long" for f in PIECES))
